"""Frequencies, cross-tabulations and co-occurrence over scored reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtally import dictionaries
from voxtally.functions import match
from voxtally.functions.literals import sql_array, sql_let, sql_string
from voxtally.functions.text import aliased, flag_label, share_pct
from voxtally.operators import dictionary
from voxtally.operators.themes import match_text, per_theme
from voxtally.rules import DEFAULT_RULES, RuleSet

UNKNOWN_AIRLINE = "Unknown airline"
TOP_TERMS = 40
DEFAULT_STOP_WORDS = (*dictionaries.ENGLISH_STOP_WORDS, *dictionaries.DOMAIN_STOP_WORDS)


def theme_frequency(coded: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Count and share of all reviews per theme."""
    return frequency_rows(per_theme(coded.select("themes"), {}, rules))


def frequency_rows(table: DataFrame) -> DataFrame:
    """:func:`theme_frequency` from a row per theme with ``reviews`` and ``total``."""
    return table.selectExpr(
        "theme", "description", "reviews AS count", f"{share_pct('reviews', 'total')} AS share_of_reviews_pct",
    ).orderBy(F.desc("count"), "theme")


def negative_reviews(scored: DataFrame) -> DataFrame:
    return scored.where("sentiment_label = 'negative'")


def seeded_phrases(scored: DataFrame, rules: RuleSet = DEFAULT_RULES, limit: int = TOP_TERMS, terms: DataFrame | None = None) -> DataFrame:
    """How many negative reviews mention each candidate term, the ``limit`` most frequent.

    ``terms``, a table with a normalized ``term``, takes the place of the rule set's candidates: for more of them than a
    plan should hold as literals.
    """
    reviews = negative_reviews(scored)
    if terms is not None:
        counts = dictionary.document_counts(reviews, terms, [])
        return phrase_rows(counts.unionByName(reviews.agg(F.expr("cast(NULL AS string)").alias("term"), F.expr("count(1)").alias("count"))), limit)
    if not match.matched_by(scored, rules):
        reviews = match_text(reviews, rules)
    found = f"array_intersect({sql_array(rules.candidate_terms())}, phrase_hits)"
    # the row without a term counts the review itself
    marked = reviews.selectExpr(f"explode(array_append({found}, cast(NULL AS string))) AS term")
    return phrase_rows(marked.groupBy("term").agg(F.expr("count(1)").alias("count")), limit)


def phrase_rows(grouped: DataFrame, limit: int = TOP_TERMS) -> DataFrame:
    """:func:`seeded_phrases` from a row per term with its ``count``, and one without a term for the negative reviews."""
    # no more rows than candidate terms
    grouped = grouped.withColumn("total", F.expr("max(IF(term IS NULL, count, NULL)) OVER ()"))
    return grouped.where("term IS NOT NULL").selectExpr(
        "term", "count", f"{share_pct('count', 'total')} AS share_of_negative_reviews_pct",
        "'seeded_phrase_count' AS source").orderBy(F.desc("count"), "term").limit(limit)


#: From so many reviews on, a term of the n-gram table occurs in so many of them.
LEAST_REVIEWS = ((500, 3), (100, 2))


#: Buckets that terms are dealt into by hash, and how many of the fullest are counted term by term to begin with.
TERM_BUCKETS, FIRST_BUCKETS = 1 << 16, 320


def kept_words(reviews: DataFrame, stop_words: Sequence[str] = DEFAULT_STOP_WORDS) -> DataFrame:
    """The words of each review in order, as ``kept``, without stop words and one-letter words."""
    # a list of literals is looked up by hash
    stops = f" AND token NOT IN ({', '.join(map(sql_string, stop_words))})" if stop_words else ""
    return reviews.selectExpr(f"filter(split(clean_text, ' '), token -> length(token) > 1{stops}) AS kept")


def _occurrences(terms: str) -> str:
    """SQL for the different strings of a sorted array with their number: equal neighbours are counted."""
    begins = f"filter(sequence(0, size({terms}) - 1), i -> i = 0 OR get({terms}, i) <> get({terms}, i - 1))"
    counted = sql_let({"begins": begins}, f"""transform(v.begins, (at, j) ->
        named_struct('term', get({terms}, at), 'n', coalesce(get(v.begins, j + 1), size({terms})) - at))""")
    return f"IF(size({terms}) = 0, cast(array() AS array<struct<term:string,n:int>>), {counted})"


def _bucket_map(buckets: DataFrame, n_buckets: int) -> Column:
    """For each bucket whether it is listed, as one array value."""
    every = buckets.sparkSession.range(n_buckets).selectExpr("id AS bucket")
    told = buckets.select("bucket").unionAll(every).groupBy("bucket").agg(F.expr("count(1) > 1").alias("listed"))
    in_order = "array_sort(collect_list(IF(bucket >= 0, struct(bucket, listed), NULL)))"
    return told.agg(F.expr(in_order).alias("told")).select("told.listed").scalar()


def ngram_frequency(reviews: DataFrame, stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
                    limit: int = TOP_TERMS, least_reviews: Sequence[tuple[int, int]] = LEAST_REVIEWS,
                    buckets: int = TERM_BUCKETS, first_buckets: int = FIRST_BUCKETS) -> DataFrame:
    """Most frequent words and word pairs, stop words and one-letter words removed first.

    A term has to occur in as many reviews as the first entry ``(reviews, least)`` of ``least_reviews`` says that the
    number of reviews reaches, or else in one.

    Nearly all different terms are rare, and none of them is shuffled.  Terms are dealt into ``buckets`` by hash and
    only the buckets' sums are shuffled; a term is no more frequent than its bucket.  The terms of the ``first_buckets``
    fullest are counted, and the last of the first ``limit`` that qualify there sets a threshold.  Buckets that reach it may
    hold a term of the result, and their terms are counted exactly.  With fewer terms than ``limit`` that is all of them.
    """
    rows = kept_words(reviews, stop_words)

    def place(*words: str) -> str:
        return f"pmod(xxhash64({', '.join(words)}), {buckets}L)"

    def pairs(what: str) -> str:
        return f"transform(slice(kept, 2, size(kept)), (word, i) -> {what})"

    # every review also stands in a bucket of its own kind, which counts the reviews
    # outer, here and below: else the optimizer asks in front how many there are, and makes them twice
    places = f"concat(transform(kept, word -> {place('word')}), {pairs(place('get(kept, i)', 'word'))}, array(-1L))"
    sums = rows.selectExpr(f"explode_outer({places}) AS bucket").groupBy("bucket").agg(F.expr("count(1)").alias("n"))
    steps = " ".join(f"WHEN n >= {int(n)} THEN {int(k)}" for n, k in (*least_reviews, (0, 1)))
    # not by a filter on the bucket, which would be put in front of the sums: all parts read the same ones
    least = sums.agg(F.expr("coalesce(max(IF(bucket < 0, n, 0L)), 0L)").alias("n")).selectExpr(f"CASE {steps} ELSE 1 END").scalar()
    sums = sums.selectExpr("bucket", "IF(bucket >= 0, n, -1L) AS n")

    def counted(chosen: Column) -> DataFrame:
        inside = lambda *words: f"get(chosen, int({place(*words)}))"
        found_words = f"filter(kept, word -> {inside('word')})"
        found_pairs = pairs(f"IF({inside('get(kept, i)', 'word')}, concat(get(kept, i), ' ', word), NULL)")
        found = rows.withColumn("chosen", chosen).selectExpr(
            f"array_sort(concat({found_words}, filter({found_pairs}, pair -> pair IS NOT NULL))) AS found")
        each = found.selectExpr(f"inline_outer({_occurrences('found')})").where("term IS NOT NULL")
        return each.groupBy("term").agg(*aliased({"count": "sum(n)", "documents": "count(1)"})).where(F.col("documents") >= least)

    fullest = sums.orderBy(F.desc("n"), "bucket").limit(first_buckets)
    first = counted(_bucket_map(fullest, buckets)).orderBy(F.desc("count")).limit(limit)
    threshold = first.agg(F.expr(f"IF(count(1) = {int(limit)}, min(count), 0L)")).scalar()
    return (counted(_bucket_map(sums.where(F.col("n") >= threshold), buckets)).select("term", "count")
            .orderBy(F.desc("count"), "term").limit(limit))


def negative_terms(scored: DataFrame, rules: RuleSet = DEFAULT_RULES, stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
                   limit: int = TOP_TERMS) -> DataFrame:
    """Seeded phrase counts, or the n-gram table when no candidate term occurs.

    Reads ``scored`` more than once: cheapest on a table that has been written.
    """
    seeded = seeded_phrases(scored, rules, limit)
    hits = seeded.agg(F.expr("count(1)")).scalar()
    fallback = ngram_frequency(negative_reviews(scored).where(hits == 0), stop_words, limit)
    return seeded.unionByName(fallback, allowMissingColumns=True)


def rating_distribution(scored: DataFrame) -> DataFrame:
    """Count and share of rated reviews per observed rating."""
    grouped = scored.where("rating IS NOT NULL").groupBy("rating", "rating_bucket").agg(
        F.expr("count(1)").alias("count"))
    return distribution_rows(grouped)


def distribution_rows(grouped: DataFrame) -> DataFrame:
    """:func:`rating_distribution` from a row per rating and bucket with its ``count``."""
    total = grouped.agg(F.expr("sum(count)")).scalar()  # shares the shuffle of the counts
    return (grouped.withColumn("total", total)
            .selectExpr("rating", "rating_bucket", "count", f"{share_pct('count', 'total')} AS share_of_rated_reviews_pct")
            .orderBy("rating"))


def theme_rows(scored: DataFrame) -> DataFrame:
    """One row per review and theme; reviews without a theme are left out."""
    return scored.selectExpr(
        "review_id", "explode(themes) AS theme", "sentiment_label", f"coalesce(airline, '{UNKNOWN_AIRLINE}') AS airline",
        f"{flag_label('recommended')} AS recommendation_label", "rating")


def crosstab(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Count per theme and value of ``column``, with its share within the theme.

    Totals come back by a join with one row per theme, not by a window: there
    are few themes, and a window would gather all values of one in one task.
    """
    return crosstab_rows(rows.groupBy("theme", F.col(column).alias(name)).agg(F.expr("count(1)").alias("count")), name)


def crosstab_rows(counts: DataFrame, name: str) -> DataFrame:
    """:func:`crosstab` from a row per theme and value in ``name`` with its ``count``."""
    totals = counts.groupBy("theme").agg(F.expr("sum(count)").alias("total"))
    return (counts.join(F.broadcast(totals), "theme")
            .selectExpr("theme", name, "count", f"{share_pct('count', 'total')} AS share_within_theme_pct")
            .orderBy("theme", F.desc("count"), name))


def theme_vs_sentiment(scored: DataFrame) -> DataFrame:
    return crosstab(theme_rows(scored), "sentiment_label", "sentiment")


def theme_vs_airline(scored: DataFrame) -> DataFrame:
    return crosstab(theme_rows(scored), "airline", "airline")


def theme_vs_recommendation(scored: DataFrame) -> DataFrame:
    return crosstab(theme_rows(scored), "recommendation_label", "recommendation")


def pairs_of(items: str) -> str:
    """SQL for all pairs of an array's elements, earlier element first."""
    return (f"flatten(transform({items}, (one, i) -> transform(slice({items}, i + 2, size({items})), "
            "two -> named_struct('theme_a', one, 'theme_b', two))))")


def pain_point_pairs(coded: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """How often two pain points meet in one review; focus pairs are listed even at zero.

    Reviews are first counted per combination of pain points, of which there
    are few, so pairs are formed from combinations and not from reviews.
    """
    pains = F.expr(f"array_intersect({sql_array(rules.ordered_pain_points())}, themes)")
    return pair_rows(coded.groupBy(pains.alias("pains")).agg(F.expr("count(1)").alias("n")), rules)


def pair_rows(sets: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """:func:`pain_point_pairs` from a row per combination of pain points, the empty one included, with its number ``n``."""
    review = "array(cast(NULL AS struct<theme_a:string,theme_b:string>))"
    found = sets.selectExpr(f"explode(concat({pairs_of('pains')}, {review})) AS pair", "n").selectExpr("pair.*", "n")
    if rules.focus_pairs:
        listed = ", ".join(f"({sql_string(a)}, {sql_string(b)}, 0L)" for a, b in rules.focus_pairs)
        found = found.unionByName(sets.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS t(theme_a, theme_b, n)"))
    grouped = found.groupBy("theme_a", "theme_b").agg(F.expr("sum(n)").alias("count"))
    # the row without a pair holds the number of reviews; at most one row per pair of themes
    total = "coalesce(max(IF(theme_a IS NULL, count, NULL)) OVER (), 0L)"
    focus = [f"{a} + {b}" for a, b in rules.focus_pairs]
    label = "concat(theme_a, ' + ', theme_b)"
    return (grouped.withColumn("total", F.expr(total)).where("theme_a IS NOT NULL")
            .selectExpr("theme_a", "theme_b", f"{label} AS combination_label", "count",
                        f"{share_pct('count', 'total')} AS share_of_reviews_pct",
                        f"array_contains({sql_array(focus)}, {label}) AS is_focus_combination")
            .orderBy(F.desc("is_focus_combination"), F.desc("count"), "combination_label"))
