"""Standardizing, filtering and deduplicating reviews, and counting what was lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtally.functions import match, text
from voxtally.functions.literals import sql_array
from voxtally.functions.text import aliased, with_exprs
from voxtally.rules import DEFAULT_RULES, RuleSet
from voxtally.schema import INGEST_ORDER
from voxtally.sources.sinks import Landing, land

MIN_WORDS = 4
_MISSING_PROFILE = ("review_text", "rating", "traveler_type", "route", "seat_type")


def standardize_fields(df: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Structured columns to their types and vocabularies; keeps every row."""
    kind = {f.name: f.dataType for f in df.schema.fields}
    rating, date = "double(rating)", "review_date"
    if isinstance(kind["rating"], T.StringType):
        rating = text.parse_number("rating")
    elif isinstance(kind["rating"], (T.FloatType, T.DoubleType)):
        rating = "nullif(double(rating), double('NaN'))"
    if not isinstance(kind["review_date"], T.DateType):
        date = text.parse_date("review_date")

    def flag(name: str) -> str:
        return name if isinstance(kind[name], T.BooleanType) else text.parse_flag(name)

    return with_exprs(df, {
        "airline": text.airline_label("airline", rules),
        "review_date": date,
        "review_month": f"date_format({date}, 'yyyy-MM')",
        "rating": rating,
        "recommended": flag("recommended"),
        "is_synthetic": f"coalesce({flag('is_synthetic')}, false)",
        "disruption_type": text.disruption_label("disruption_type", rules),
        **{name: text.empty_to_null(text.collapse_space(name)) for name in ("traveler_type", "route", "seat_type")},
    })


def text_fields(df: DataFrame) -> DataFrame:
    """Analysis text, normalized words and their sizes."""
    df = with_exprs(df, {
        "review_title": text.collapse_space("review_title"),
        "review_text": text.collapse_space("review_text"),
        "clean_text": text.clean_words("review_title", "review_text"),
    })
    df = with_exprs(df, {
        "analysis_text": text.join_parts("review_title", "review_text"),
        "word_count": text.word_count("clean_text"),
    })
    return with_exprs(df, {"feedback_text": "analysis_text", "text_length": "length(analysis_text)"})


def usable(df: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Drop reviews that are empty or shorter than ``min_words``; works on raw text."""
    return df.where(text.has_words("review_title", "review_text", max(min_words, 1)))


def prepare(df: DataFrame, rules: RuleSet = DEFAULT_RULES, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row-level cleaning step: a narrow plan without a shuffle."""
    return text_fields(standardize_fields(usable(df, min_words), rules))


def prepare_distinct(df: DataFrame, rules: RuleSet = DEFAULT_RULES, min_words: int = MIN_WORDS,
                     order: Sequence[str] = INGEST_ORDER) -> DataFrame:
    """As :func:`prepare`, with duplicates dropped first and without moving texts.

    The right order when whole reviews are written.  Duplicates are found among digests, which is a job of its own when
    this is called, and then left out where the raw text is read; see :func:`without`.
    """
    usable_rows = usable(df, min_words)
    with Landing(df.sparkSession) as landing:
        copies = later_copies(landing.land(text_digests(usable_rows, min_words, order), "digests"), order)
        copies = land(copies, "copies")
    return text_fields(standardize_fields(without(usable_rows, copies, order), rules))


def text_key(words: str) -> str:
    """32-byte digest standing in for a text of any length in shuffles and sorts."""
    return f"unhex(sha2({words}, 256))"


def keep_first(df: DataFrame, order: Sequence[str] = INGEST_ORDER, words: str = "clean_text") -> DataFrame:
    """One row per normalized text (``words``): the first in ingestion order.

    The rank limit is applied on the map side as well, so a task forwards at
    most one row per text and a text that fills a third of the table does not
    gather in one place.  Columns the caller does not use afterwards, texts
    included, are pruned before the shuffle.
    """
    position = f"row_number() OVER (PARTITION BY _text_key ORDER BY {', '.join(f'{c} NULLS LAST' for c in order)})"
    if "_text_key" not in df.columns:
        df = df.withColumn("_text_key", F.expr(text_key(words)))
    return df.withColumn("_position", F.expr(position)).where("_position = 1").drop("_text_key", "_position")


def staged(df: DataFrame, rules: RuleSet = DEFAULT_RULES, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row-level cleaning step on every row, with the ``status`` and ``text_key`` of :func:`text_digests`.

    For a table that is written: texts are normalized once, counters and duplicates read its narrow columns, and the rows
    that stay are taken from it.
    """
    fields = text_fields(standardize_fields(df, rules))
    return fields.withColumn("status", F.expr(status_of("word_count", min_words))).withColumn(
        "text_key", F.expr(f"IF(word_count >= {max(min_words, 1)}, {text_key('clean_text')}, NULL)"))


def text_digests(df: DataFrame, min_words: int = MIN_WORDS, order: Sequence[str] = INGEST_ORDER) -> DataFrame:
    """A narrow row for each review of an unfiltered table: its place, its ``status`` and its ``text_key``.

    The status is ``empty``, ``short`` or ``usable``; only usable texts have a digest.
    """
    words = df.select(*order, F.expr(text.clean_words("review_title", "review_text")).alias("words"))
    sized = words.select(*order, "words", F.expr(text.word_count("words")).alias("size"))
    return sized.select(*order, *aliased({"status": status_of("size", min_words),
                                          "text_key": f"IF(size >= {max(min_words, 1)}, {text_key('words')}, NULL)"}))


def status_of(size: str, min_words: int) -> str:
    return f"CASE WHEN {size} = 0 THEN 'empty' WHEN {size} < {min_words} THEN 'short' ELSE 'usable' END"


def later_copies(digests: DataFrame, order: Sequence[str] = INGEST_ORDER) -> DataFrame:
    """Places of usable reviews whose text came before, from narrow rows as :func:`text_digests` gives them.

    The first place of each text is found with partial aggregation, so copies of one text are reduced in every
    task; only texts that occur again are then looked up, and a text that fills a third of the table is a skewed
    key, which the planner splits.  Places are compared with nulls last; rows that share a place are one row.
    """
    place = f"struct({', '.join(f'{c} IS NULL, {c}' for c in order)})"
    usable_rows = digests.where("text_key IS NOT NULL")
    first = usable_rows.groupBy("text_key").agg(F.expr(f"min({place})").alias("_first"), F.expr("count(1)").alias("_n"))
    return usable_rows.join(first.where("_n > 1"), "text_key").where(F.expr(f"{place} <> _first")).select(*order)


#: So many rows, of a few numbers each, may be sent to every task.
MOST_SENT = 1_000_000


def without(df: DataFrame, places: DataFrame, order: Sequence[str] = INGEST_ORDER, most_sent: int = MOST_SENT) -> DataFrame:
    """``df`` less the rows at ``places``; null places match null ones.

    The places are read twice and counted here: pass a table that has been written.  Up to ``most_sent`` of them are
    sent to all tasks, so that no row of ``df`` is moved; more of them are joined as large tables are.
    """
    listed = places.select(*[F.col(c).alias(f"_{c}") for c in order])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order]
    few = listed.count() <= most_sent
    return df.join(F.broadcast(listed) if few else listed, same, "left_anti")


def derived_fields(df: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Rating bucket, disruption keywords and the negative-experience flag."""
    hits, limits = "phrase_hits", rules.negative_experience
    if not match.matched_by(df, rules):
        hits, vocab = "_hits", match.vocabulary(rules.disruption_keywords)
        df = df.withColumn("_known", match.known_words("clean_text", vocab))
        df = df.withColumn(hits, match.phrase_hits("clean_text", "_known", rules.disruption_keywords))
    found = F.expr(f"array_intersect({sql_array(rules.disruption_keywords)}, {hits})")  # dictionary order
    return with_exprs(df.withColumn("disruption_keywords", found), {
        "rating_bucket": text.rating_bucket("rating"),
        "disruption_keywords_found": "array_join(disruption_keywords, '; ')",
        "likely_negative_experience": f"""coalesce(rating <= {limits.rating}, false) OR coalesce(NOT recommended, false) OR (
            size(disruption_keywords) >= {limits.keywords} AND array_contains({sql_array(limits.costly_types)}, disruption_type))""",
    }).drop("_known", "_hits")


def clean(df: DataFrame, rules: RuleSet = DEFAULT_RULES, min_words: int = MIN_WORDS,
          order: Sequence[str] = INGEST_ORDER, duplicates_first: bool = False) -> DataFrame:
    """Standardized reviews to cleaned, deduplicated reviews with derived fields.

    Duplicates are dropped last, so that columns nobody uses never reach the
    shuffle.  When the texts in their several forms are what is wanted, say
    ``duplicates_first=True``; the rows are the same, no text is shuffled, and
    a job finds the duplicates when this is called.
    """
    if duplicates_first:
        return derived_fields(prepare_distinct(df, rules, min_words, order), rules)
    return keep_first(derived_fields(prepare(df, rules, min_words), rules), order)


def canonical_order(df: DataFrame) -> DataFrame:
    """Presentation order.  A full sort: use it on what is shown or exported, not between steps."""
    return df.orderBy(F.asc_nulls_last("review_date"), F.asc_nulls_last("review_id"))


def per_text(digests: DataFrame) -> DataFrame:
    """Reviews per status and text.  Tables of several deliveries add up: see :func:`merge_texts`."""
    return digests.groupBy("status", "text_key").agg(F.expr("count(1)").alias("n"))


def merge_texts(*deliveries: DataFrame) -> DataFrame:
    """What :func:`per_text` would give for all deliveries together, from its result for each."""
    merged = deliveries[0]
    for more in deliveries[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy("status", "text_key").agg(F.expr("sum(n)").alias("n"))


def count_reductions(texts: DataFrame) -> DataFrame:
    """One row: reviews before, removed per reason, and after cleaning, from :func:`per_text`."""
    counts = texts.agg(*aliased({
        "rows_before": "coalesce(sum(n), 0L)",
        "empty_reviews_removed": "coalesce(sum(n) FILTER (WHERE status = 'empty'), 0L)",
        "short_reviews_removed": "coalesce(sum(n) FILTER (WHERE status = 'short'), 0L)",
        "duplicate_reviews_removed": "coalesce(sum(n - 1) FILTER (WHERE status = 'usable'), 0L)",
        "rows_after": "count_if(status = 'usable')",
    }))
    return counts.withColumn("retention_rate", F.expr("IF(rows_before = 0, 0D, rows_after / rows_before)"))


def quality_counts(df: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row: reviews before, removed per reason, and after cleaning.

    Works on the standardized, unfiltered table.  Only digests and partial
    counts are shuffled.
    """
    return count_reductions(per_text(text_digests(df, min_words, ())))


def missing_profile(cleaned: DataFrame) -> DataFrame:
    """Missing values per key column, in one pass."""
    gaps = {name: f"count_if({name} IS NULL)" for name in _MISSING_PROFILE}
    gaps["review_text"] = "count_if(coalesce(review_text, '') = '')"
    return cleaned.agg(*aliased(gaps)).unpivot([], list(_MISSING_PROFILE), "field", "missing_count")


def source_mix(cleaned: DataFrame) -> DataFrame:
    """Reviews from public and from synthetic sources."""
    origin = F.expr("IF(coalesce(is_synthetic, false), 'synthetic', 'public')").alias("origin")
    return cleaned.groupBy(origin).agg(F.expr("count(1)").alias("count"))
