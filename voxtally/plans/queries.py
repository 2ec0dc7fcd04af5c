"""Registered queries, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtally.functions import text
from voxtally.functions.literals import sql_array, sql_string
from voxtally.operators import clean, dictionary, kpis, quant, sentiment, themes
from voxtally.plans.review_view import raw_reviews, read_reviews, standardized_reviews
from voxtally.plans.stages import annotate
from voxtally.rules import DEFAULT_RULES, RuleSet
from voxtally.sources.dates import date_profile
from voxtally.sources.ingest import short_ids, standardize, union_sources
from voxtally.sources.registry import Dataset

Query = Callable[[SparkSession, str], DataFrame]

# The raw form of the view, as a dataset of its own for the standardizing queries.
DOCUMENT_REVIEWS = Dataset(
    key="document_reviews",
    source_label="Document reviews",
    column_map={
        "airline": "airline", "review_date": "review_date", "review_title": "review_title", "review_text": "review_text",
        "rating": "rating", "traveler_type": "traveler_type", "route": "route", "seat_type": "seat_type",
        "recommended": "recommended",
    },
)
_ROW = ["doc_id"]


def _cleaned(spark: SparkSession, sf_dir: str, duplicates_first: bool = False) -> DataFrame:
    if duplicates_first:
        cleaned = clean.clean(standardized_reviews(spark, sf_dir), duplicates_first=True)
    else:
        cleaned = clean.keep_first(clean.derived_fields(read_reviews(spark, sf_dir)))
    return cleaned.withColumnRenamed("source_row", "doc_id")


def _scored(spark: SparkSession, sf_dir: str, details: bool = False, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    scored = clean.keep_first(annotate(read_reviews(spark, sf_dir, rules), rules, details))
    return scored.withColumnRenamed("source_row", "doc_id")


def _on_cleaned(summary: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: summary(_cleaned(spark, sf_dir))


def _on_scored(summary: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: summary(_scored(spark, sf_dir))


def _columns(*names: str) -> Query:
    return lambda spark, sf_dir: _scored(spark, sf_dir, details=True).select(*_ROW, *names)


def standardize_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_reviews(spark, sf_dir).withColumn("source_row", F.col("doc_id"))
    return standardize(raw, DOCUMENT_REVIEWS).withColumnRenamed("source_row", "doc_id")


def review_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_reviews(spark, sf_dir).select("doc_id", "review_id")


def combined_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the public source, conversation turns as the synthetic one."""
    public = standardize(raw_reviews(spark, sf_dir).withColumn("source_row", F.col("doc_id")), DOCUMENT_REVIEWS)
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    synthetic = turns.select(
        F.concat_ws("_", F.lit("turn"), "conv_id", "turn").alias("review_id"), F.lit("Conversations").alias("source"),
        F.col("role").alias("review_title"), F.col("text").alias("review_text"), F.col("turn").alias("source_row"))
    return union_sources(public, synthetic, "combined").select(
        "source_rank", "review_id", "source", "airline", "review_date", "review_title", "review_text", "rating",
        "recommended", "disruption_type", "raw_text", "is_synthetic", "feedback_text")


def clean_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["review_id", "source", "airline", "review_date", "review_month", "review_title", "review_text", "rating",
             "traveler_type", "route", "seat_type", "recommended", "is_synthetic", "analysis_text", "feedback_text",
             "clean_text", "word_count", "text_length", "rating_bucket", "disruption_type",
             "disruption_keywords_found", "likely_negative_experience"]
    return _cleaned(spark, sf_dir, duplicates_first=True).select(*_ROW, *names)


def ordered_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.canonical_order(_cleaned(spark, sf_dir).select(*_ROW, "review_date", "review_id"))


def airline_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_reviews(spark, sf_dir)
    return raw.selectExpr("doc_id", f"{text.airline_label('airline', DEFAULT_RULES)} AS airline")


def disruption_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = standardized_reviews(spark, sf_dir).select(F.col("source_row").alias("doc_id"), "disruption_type")
    # labels arrive in all spellings
    spelled = r"concat(' ', upper(disruption_type), '\t')"
    return typed.selectExpr("doc_id", "disruption_type AS inferred_type",
                            f"{text.disruption_label(spelled, DEFAULT_RULES)} AS standardized_type")


def disruption_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select(*_ROW, "disruption_keywords_found",
                                          F.size("disruption_keywords").cast("long").alias("keyword_count"))


def theme_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).selectExpr(*_ROW, "array_join(themes, '; ') AS themes", "theme_count", "primary_theme")


def negative_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quant.ngram_frequency(quant.negative_reviews(_scored(spark, sf_dir)))


def negative_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quant.negative_terms(_scored(spark, sf_dir))


def negative_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chooser where no candidate term occurs, so the n-gram table takes their place."""
    rules = replace(DEFAULT_RULES, negative_terms=("zzyzx qwxyz",), pain_points=())
    return quant.negative_terms(_scored(spark, sf_dir, rules=rules), rules)


def text_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores where a third of the reviews lack the normalized text, which is then made from the analysis text."""
    prepared = clean.prepare(standardized_reviews(spark, sf_dir))
    kept = clean.keep_first(prepared)
    lacking = kept.withColumn("clean_text", F.expr("IF(source_row % 3 = 0, NULL, clean_text)"))
    scored = sentiment.score_sentiment(clean.derived_fields(themes.match_text(lacking)))
    return scored.selectExpr("source_row AS doc_id", "sentiment_score", "sentiment_label")


# --- raw text in many spellings ---------------------------------------------------------------------------

# Fixed values of the view: spellings of flags and numbers, blanks included, and forms of dates.
FLAG_SPELLINGS = ["yes", " Y ", "TRUE", "1", "1.0", "no", "N", "False", "0", "0.0", "Recommended", "NOT recommended", "maybe", ""]
NUMBER_SPELLINGS = ["7", " 8.5 ", "1e1", "nan", "seven", "-2", ""]
DATE_FORMS = ["yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy", "yyyyMMdd", "d MMMM yyyy", "MMMM d, yyyy", "yyyy-MM-dd'T10:20:30'", "'some time soon'",
              "dd.MM.yyyy", "' 'd MMM yyyy' '"]
RAW_DOCUMENTS = Dataset("raw_documents", "Raw documents", DOCUMENT_REVIEWS.column_map)


def spelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with its date, rating and flag as text in many spellings."""
    day = "date_add(date'2020-01-01', int(doc_id % 2500))"
    forms = " ".join(f"WHEN {i} THEN date_format({day}, {sql_string(form)})" for i, form in enumerate(DATE_FORMS))
    raw = raw_reviews(spark, sf_dir, labelled=False).withColumn("source_row", F.col("doc_id"))
    return text.with_exprs(raw, {
        "review_date": f"CASE doc_id % {len(DATE_FORMS)} {forms} END",
        "rating": f"get({sql_array(NUMBER_SPELLINGS)}, int(doc_id % {len(NUMBER_SPELLINGS)}))",
        "recommended": f"get({sql_array(FLAG_SPELLINGS)}, int(doc_id % {len(FLAG_SPELLINGS)}))",
    })


def spelled_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(spelled_reviews(spark, sf_dir), RAW_DOCUMENTS).selectExpr(
        "source_row AS doc_id", "review_id", "review_date", "rating", "recommended")


def spelled_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_profile(spelled_reviews(spark, sf_dir), "review_date")


def safe_review_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers cut to three digits, so that many collide and stay whole."""
    raw = raw_reviews(spark, sf_dir, labelled=False).withColumn("source_row", F.col("doc_id"))
    return short_ids(standardize(raw, DOCUMENT_REVIEWS, id_digits=32), 3).selectExpr("source_row AS doc_id", "review_id")


# --- dictionaries as tables -----------------------------------------------------------------------------------

#: Words in the longest term of the dictionaries made from the benchmark.
LONGEST_TERM = 8


def benchmark_terms(spark: SparkSession, sf_dir: str, shortest: int = 1, longest: int = LONGEST_TERM) -> DataFrame:
    """Every run of words of the benchmark's texts as ``term``, with the ``item_id`` it stands in: some ten thousand terms."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr("item_id", f"split({text.normalize_words('text')}, ' ') AS words")
    lengths = items.selectExpr("item_id", "words", f"explode(sequence({shortest}, {longest})) AS n").where("size(words) >= n")
    runs = lengths.selectExpr("item_id", "explode(transform(sequence(1, size(words) - n + 1), i -> array_join(slice(words, i, n), ' '))) AS term")
    return dictionary.terms_table(runs).distinct()


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.prepare(standardized_reviews(spark, sf_dir, labelled=False)).selectExpr("source_row AS doc_id", "clean_text")


def dictionary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.document_counts(_texts(spark, sf_dir), benchmark_terms(spark, sf_dir), _ROW)


def dictionary_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty themes of several thousand terms, every sixteenth of which bars its theme."""
    rules = benchmark_terms(spark, sf_dir, 2, 5).selectExpr(
        "concat('topic ', item_id % 40) AS theme", "int(item_id % 40) AS place", "IF(startswith(md5(term), '0'), 'barred', 'wanted') AS kind", "term")
    return dictionary.code_by_table(_texts(spark, sf_dir), rules, _ROW).selectExpr(*_ROW, "array_join(themes, '; ') AS themes")


def dictionary_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = benchmark_terms(spark, sf_dir).select("term").distinct().selectExpr("term", "instr('0123456789abcdef', left(md5(term), 1)) - 9 AS weight")
    return dictionary.points_by_table(_texts(spark, sf_dir), lexicon, _ROW)


def theme_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(*[t.indicator for t in DEFAULT_RULES.themes])(spark, sf_dir)


QUERIES: dict[str, Query] = {
    # sources and row-level cleaning
    "standardize_reviews": standardize_reviews,
    "review_ids": review_ids,
    "union_sources": combined_sources,
    "airline_names": airline_names,
    "disruption_types": disruption_types,
    "disruption_keywords": disruption_keywords,
    "clean_reviews": clean_reviews,
    "review_order": ordered_reviews,
    "spelled_fields": spelled_fields,
    "spelled_dates": spelled_dates,
    "safe_review_ids": safe_review_ids,
    "text_fallback": text_fallback,
    # quality
    "quality_counts": lambda spark, sf_dir: clean.quality_counts(standardized_reviews(spark, sf_dir)),
    "missing_profile": _on_cleaned(clean.missing_profile),
    "source_mix": _on_cleaned(clean.source_mix),
    # themes
    "theme_codes": theme_codes,
    "theme_evidence": _columns("theme_evidence"),
    "theme_indicators": theme_indicators,
    "theme_summary": _on_scored(themes.theme_summary),
    "theme_coverage": _on_scored(themes.theme_coverage),
    "theme_quotes": _on_scored(themes.theme_quotes),
    # sentiment
    "sentiment_scores": _columns("sentiment_score", "sentiment_label"),
    "sentiment_evidence": _columns("sentiment_evidence"),
    "sentiment_summary": _on_scored(sentiment.sentiment_summary),
    "sentiment_by_theme": _on_scored(sentiment.sentiment_by_theme),
    # quantitative tables
    "theme_frequency": _on_scored(quant.theme_frequency),
    "negative_phrases": _on_scored(quant.seeded_phrases),
    "negative_ngrams": negative_ngrams,
    "negative_terms": negative_terms,
    "negative_fallback": negative_fallback,
    "rating_distribution": _on_scored(quant.rating_distribution),
    "theme_rows": _on_scored(quant.theme_rows),
    "theme_vs_sentiment": _on_scored(quant.theme_vs_sentiment),
    "theme_vs_airline": _on_scored(quant.theme_vs_airline),
    "theme_vs_recommendation": _on_scored(quant.theme_vs_recommendation),
    "pain_point_pairs": _on_scored(quant.pain_point_pairs),
    # dictionaries as tables
    "dictionary_counts": dictionary_counts,
    "dictionary_themes": dictionary_themes,
    "dictionary_points": dictionary_points,
    # headline figures
    "disruption_counts": _on_cleaned(kpis.disruption_counts),
    "top_pain_points": _on_scored(kpis.top_pain_points),
    "most_negative_themes": _on_scored(kpis.most_negative_themes),
    "highlighted_pairs": _on_scored(kpis.highlighted_pairs),
    "corpus_kpis": _on_cleaned(kpis.corpus_kpis),
    "rating_buckets": _on_scored(kpis.rating_buckets),
    "recommendation_pivot": _on_scored(kpis.recommendation_pivot),
    "recovery_signals": _on_scored(kpis.recovery_signals),
    "lead_quotes": _on_scored(kpis.lead_quotes),
    "headline_lists": _on_scored(kpis.headline_lists),
}
