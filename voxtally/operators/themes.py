"""Multi-label theme coding and what is reported about themes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.functions import match
from voxtally.functions.literals import sql_array, sql_arrays, sql_let, sql_string
from voxtally.functions.text import aliased, excerpt, normalize_words, share_pct, with_exprs
from voxtally.operators import dictionary
from voxtally.rules import DEFAULT_RULES, RuleSet

UNCLASSIFIED = "unclassified"
QUOTE_CHARS = 280
_QUOTE_LENGTH = 320
_SALTS = 64


def text_to_match(df: DataFrame) -> str:
    """Normalized text as SQL: ``clean_text``, or made from another text column where that is missing."""
    others = [normalize_words(c) for c in ("analysis_text", "feedback_text") if c in df.columns]
    return f"coalesce({', '.join(['clean_text', *others])}, '')"


def match_text(df: DataFrame, rules: RuleSet = DEFAULT_RULES, key: Sequence[str] | None = None, terms: DataFrame | None = None) -> DataFrame:
    """Look up all dictionaries at once.

    Adds ``known_words`` and ``phrase_hits``.  Themes, sentiment, disruption
    keywords and negative terms are all derived from these two small arrays,
    so the text is split and scanned once whatever is asked for.  The column
    carries which dictionaries made it, also through a written Parquet table.

    With ``key``, columns that identify a row, phrases are looked up as a table: ``terms`` with a normalized
    ``term``, or the rule set's own.  The plan then holds none of them, and the hits are joined back by ``key``.
    """
    words, phrases = text_to_match(df), rules.all_phrases()
    if key is None:
        df = df.withColumn("known_words", match.known_words(words, match.vocabulary(phrases, rules.anchor_words())))
        hits = match.phrase_hits(words, "known_words", phrases)
    else:
        terms = dictionary.phrase_table(df.sparkSession, rules) if terms is None else terms
        found = dictionary.phrase_hits_by_table(df.select(*key, F.expr(words).alias("_text")), terms, key, "_text")
        df = df.drop("phrase_hits").withColumn("known_words", match.known_words(words, rules.anchor_words())).join(found, list(key), "left")
        hits = F.expr(f"coalesce(phrase_hits, {sql_array([])})")
    return df.withColumn("phrase_hits", match.marked(hits, "phrase_hits", rules.fingerprint()))


def read_texts(df: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Everything that later steps want to know of the texts: matches of all kinds and the excerpt.

    What comes after, a join included, then needs no text; the steps that would look these things up find them.
    """
    if not match.matched_by(df, rules):
        df = match_text(df, rules)
    patterns = match.pattern_hits("clean_text", "known_words", rules.themes)
    words = match.word_hits(text_to_match(df), "known_words", rules.lexicon)
    df = df.withColumn("pattern_hits", match.marked(patterns, "pattern_hits", rules.pattern_fingerprint()))
    return add_quote_excerpt(df.withColumn("word_hits", match.marked(words, "word_hits", rules.word_fingerprint())))


def code_themes(df: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Adds ``themes`` (dictionary order), ``theme_count`` and ``primary_theme``.

    Matches made earlier by :func:`match_text` with the same dictionaries are
    reused, others are made again.
    """
    if not match.matched_by(df, rules):
        df = match_text(df, rules)
    wanted = sql_arrays(t.phrases for t in rules.themes)
    barred = sql_arrays(t.suppressed_by for t in rules.themes)
    detect = f"""filter({sql_array(rules.theme_labels)}, (label, i) -> NOT arrays_overlap(get({barred}, i), v.phrases)
        AND (arrays_overlap(get({wanted}, i), v.phrases) OR exists(v.patterns, hit -> hit.theme = label)))"""
    # most reviews match nothing and skip the comparison altogether; no clean text has null for patterns
    themes = F.expr(f"""CASE WHEN pattern_hits IS NULL OR (size(phrase_hits) = 0 AND size(pattern_hits) = 0)
        THEN {sql_array([])} ELSE {sql_let({'phrases': 'phrase_hits', 'patterns': 'pattern_hits'}, detect)} END""")
    if not match.made_by(df, "pattern_hits", rules.pattern_fingerprint()):
        found = match.pattern_hits("clean_text", "known_words", rules.themes)
        df = df.withColumn("pattern_hits", match.marked(found, "pattern_hits", rules.pattern_fingerprint()))
    return (df.withColumn("themes", themes)
            .withColumns({"theme_count": F.expr("size(themes)"),
                          "primary_theme": F.expr(f"coalesce(get(themes, 0), {sql_string(UNCLASSIFIED)})")}))


def add_evidence(coded: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Adds ``theme_matches`` (theme with its sorted matches) and the text form ``theme_evidence``."""
    own = f"""get({sql_arrays(t.phrases for t in rules.themes)},
        cast(array_position({sql_array(rules.theme_labels)}, label) - 1 AS int))"""
    matches = f"""transform(themes, label -> named_struct('theme', label, 'matches', array_sort(array_distinct(concat(
        array_intersect({own}, v.phrases),
        transform(filter(v.patterns, hit -> hit.theme = label), hit -> hit.match))))))"""
    sections = "transform(theme_matches, m -> concat(m.theme, ': ', array_join(m.matches, ', ')))"
    return (coded.withColumn("theme_matches", F.expr(sql_let({"phrases": "phrase_hits", "patterns": "pattern_hits"}, matches)))
            .withColumn("theme_evidence", F.expr(f"array_join({sections}, ' | ')")))


def add_indicators(coded: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """One 0/1 column per theme."""
    return with_exprs(coded, {
        theme.indicator: f"int(array_contains(themes, {sql_string(theme.label)}))" for theme in rules.themes})


def theme_table(df: DataFrame, rules: RuleSet) -> DataFrame:
    """The rule set's themes as a small table: position, label, description."""
    rows = ", ".join(f"({i}, {sql_string(t.label)}, {sql_string(t.description)})" for i, t in enumerate(rules.themes))
    return df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(theme_order, theme, description)")


def per_theme(df: DataFrame, aggregates: dict[str, str], rules: RuleSet) -> DataFrame:
    """Aggregate once per theme, with the ``total`` number of reviews, in a single pass.

    Each review is exploded into its themes and one row without a theme that
    stands for the review itself.  The result has a row for every theme of the
    rule set; for themes nobody mentioned ``reviews`` and ``total`` are 0 and
    the ``aggregates`` null.
    """
    marked = df.withColumn("theme", F.expr("explode(array_append(themes, cast(NULL AS string)))"))
    grouped = marked.groupBy("theme").agg(*aliased({"reviews": "count(1)", **aggregates}))
    # From here on there are as many rows as themes, whatever the data: one
    # task and a broadcast are in order.
    grouped = grouped.withColumn("total", F.expr("max(IF(theme IS NULL, reviews, NULL)) OVER ()"))
    return every_theme(grouped, rules)


def every_theme(grouped: DataFrame, rules: RuleSet) -> DataFrame:
    """A row for every theme of the rule set, from at most one row per theme with ``reviews`` and ``total``."""
    joined = theme_table(grouped, rules).join(F.broadcast(grouped), "theme", "left")
    return with_exprs(joined, {"reviews": "coalesce(reviews, 0L)", "total": "coalesce(total, 0L)"})


def theme_summary(coded: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Count, share of all reviews and mean rating per theme, unused themes included."""
    return summary_rows(per_theme(coded.select("themes", "rating"), {"mean": "avg(rating)"}, rules))


def summary_rows(table: DataFrame) -> DataFrame:
    """:func:`theme_summary` from a row per theme with ``reviews``, ``total`` and ``mean`` rating."""
    return table.selectExpr(
        "theme", "description", "reviews AS count", f"{share_pct('reviews', 'total')} AS share_of_reviews_pct",
        "bround(mean, 2) AS avg_rating").orderBy(F.desc("count"), "theme")


def theme_coverage(coded: DataFrame) -> DataFrame:
    """Reviews coded, with and without a theme."""
    return coded.agg(*aliased({
        "reviews_coded": "count(1)",
        "reviews_with_theme": "count_if(size(themes) > 0)",
        "reviews_without_theme": "count_if(size(themes) = 0)",
    }))


def first_rows(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows per key, for few and therefore large groups.

    Ranks inside salted parts of each group before ranking whole groups.  The
    salt comes from the input partition, so each task already reduces its rows
    to ``n`` per key before anything is shuffled, and no task receives a group.
    """
    part = df.withColumn("_salt", F.expr(f"spark_partition_id() % {_SALTS}"))
    for keys in (f"{key}, _salt", key):
        rank = F.expr(f"row_number() OVER (PARTITION BY {keys} ORDER BY {order})")
        part = part.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return part.drop("_salt")


# The last three only matter between equal identifiers.
_QUOTE_ORDER = "is_synthetic, distance, review_date DESC NULLS LAST, review_id, airline, source, rating"
# The same order as a value that has a minimum.
_QUOTE_RANK = ("struct(is_synthetic, distance, coalesce(-unix_date(date(review_date)), int(2147483647)) AS recency, review_id, "
               "airline, source, rating, review_date)")


def add_quote_excerpt(df: DataFrame) -> DataFrame:
    """Adds ``quote_excerpt``, so that quotes can be chosen without carrying whole texts along."""
    return with_exprs(df, {"quote_excerpt": excerpt("analysis_text", QUOTE_CHARS)})


def _quote_candidates(coded: DataFrame, max_chars: int) -> DataFrame:
    ready = max_chars == QUOTE_CHARS and "quote_excerpt" in coded.columns
    quote = "quote_excerpt" if ready else excerpt("analysis_text", max_chars)
    return coded.selectExpr(
        "explode(themes) AS theme", "review_id", "airline", "source", "review_date", "rating", "is_synthetic",
        f"abs(text_length - {_QUOTE_LENGTH}) AS distance", f"{quote} AS quote_excerpt")


def _ranked_quotes(quotes: DataFrame, rules: RuleSet) -> DataFrame:
    return quotes.selectExpr(
        "theme", f"row_number() OVER (PARTITION BY theme ORDER BY {_QUOTE_ORDER}) AS quote_rank", "review_id", "airline",
        "source", "review_date", "rating", "is_synthetic", "quote_excerpt",
    ).orderBy(F.expr(f"array_position({sql_array(rules.theme_labels)}, theme)"), "quote_rank")


def first_quotes(coded: DataFrame, rules: RuleSet = DEFAULT_RULES, max_chars: int = QUOTE_CHARS) -> DataFrame:
    """The best quote of each theme, in the order of :func:`theme_quotes`."""
    candidates = _quote_candidates(coded, max_chars)
    return _ranked_quotes(first_rows(candidates, "theme", _QUOTE_ORDER, 1), rules)


def theme_quotes(coded: DataFrame, per_theme_limit: int = 3, rules: RuleSet = DEFAULT_RULES,
                 max_chars: int = QUOTE_CHARS) -> DataFrame:
    """The best ``per_theme_limit`` quotes per theme, with distinct excerpts.

    Public reviews come first, then lengths near 320 characters, then recent
    dates.  Copies of an excerpt are reduced to the best before the shuffle,
    which carries excerpts but never whole texts.
    """
    best = _quote_candidates(coded, max_chars).groupBy("theme", "quote_excerpt").agg(F.expr(f"min({_QUOTE_RANK}) AS quote"))
    quotes = best.selectExpr("theme", "quote_excerpt", "quote.*")
    return _ranked_quotes(first_rows(quotes, "theme", _QUOTE_ORDER, per_theme_limit), rules)
