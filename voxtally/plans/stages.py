"""The chain from standardized to scored reviews, and a full run with all result tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from voxtally.functions import match
from voxtally.operators import clean, kpis, quant, sentiment, themes
from voxtally.operators.summaries import FROM_TALLY, tally
from voxtally.rules import DEFAULT_RULES, RuleSet
from voxtally.schema import INGEST_ORDER
from voxtally.sources.sinks import Landing, write_table


def annotate(prepared: DataFrame, rules: RuleSet = DEFAULT_RULES, details: bool = True) -> DataFrame:
    """Row-level results for prepared reviews: derived fields, themes and sentiment.

    With ``details`` also the evidence behind them and the 0/1 theme columns.
    Narrow throughout, so it also applies to a streaming DataFrame.
    """
    if not match.made_by(prepared, "phrase_hits", rules.fingerprint()):
        prepared = themes.match_text(prepared, rules)
    matched = clean.derived_fields(prepared, rules)
    scored = sentiment.score_sentiment(themes.code_themes(matched, rules), rules)
    if "quote_excerpt" not in scored.columns:
        scored = themes.add_quote_excerpt(scored)
    if not details:
        return scored
    return sentiment.add_sentiment_evidence(themes.add_indicators(themes.add_evidence(scored, rules), rules), rules)


def scored_reviews(standardized: DataFrame, rules: RuleSet = DEFAULT_RULES, min_words: int = clean.MIN_WORDS,
                   order: Sequence[str] = INGEST_ORDER, details: bool = True,
                   duplicates_first: bool = False) -> DataFrame:
    """Cleaned, coded and scored reviews.

    Annotation looks at one review at a time, so it may come before or after
    duplicates are dropped, with the same result.  It comes before: whatever a
    query does not ask for is then pruned ahead of the only shuffle, and a
    summary shuffles labels and numbers instead of texts.  To write whole
    reviews, say ``duplicates_first=True``: duplicates are found among digests
    when this is called, and texts are not shuffled at all.
    """
    if duplicates_first:
        return annotate(clean.prepare_distinct(standardized, rules, min_words, order), rules, details)
    return clean.keep_first(annotate(clean.prepare(standardized, rules, min_words), rules, details), order)


# Result tables by name: each is computed from the scored reviews alone.
SUMMARIES: dict[str, Callable[[DataFrame, RuleSet], DataFrame]] = {
    "missing_profile": lambda scored, rules: clean.missing_profile(scored),
    "source_mix": lambda scored, rules: clean.source_mix(scored),
    "theme_summary": themes.theme_summary,
    "theme_coverage": lambda scored, rules: themes.theme_coverage(scored),
    "theme_example_quotes": lambda scored, rules: themes.theme_quotes(scored, rules=rules),
    "sentiment_summary": lambda scored, rules: sentiment.sentiment_summary(scored),
    "sentiment_by_theme_summary": sentiment.sentiment_by_theme,
    "theme_frequency_summary": quant.theme_frequency,
    "negative_review_phrase_summary": lambda scored, rules: quant.negative_terms(scored, rules),
    "rating_distribution_summary": lambda scored, rules: quant.rating_distribution(scored),
    "theme_vs_sentiment_crosstab": lambda scored, rules: quant.theme_vs_sentiment(scored),
    "theme_vs_airline_crosstab": lambda scored, rules: quant.theme_vs_airline(scored),
    "theme_vs_recommendation_crosstab": lambda scored, rules: quant.theme_vs_recommendation(scored),
    "pain_point_combinations_summary": quant.pain_point_pairs,
    "disruption_counts": lambda scored, rules: kpis.disruption_counts(scored),
    "corpus_kpis": lambda scored, rules: kpis.corpus_kpis(scored),
    "rating_buckets": lambda scored, rules: kpis.rating_buckets(scored),
    "recommendation_pivot": lambda scored, rules: kpis.recommendation_pivot(scored, rules),
    "recovery_signals": kpis.recovery_signals,
    "lead_quotes": kpis.lead_quotes,
    "headline_lists": kpis.headline_lists,
}


def run(standardized: DataFrame, out_dir: str, rules: RuleSet = DEFAULT_RULES, min_words: int = clean.MIN_WORDS,
        order: Sequence[str] = INGEST_ORDER, summary_format: str = "parquet",
        summaries: Sequence[str] | None = None) -> DataFrame:
    """Write the scored reviews once and compute every result table from them.

    Returns the scored reviews as read back.  Raw text is normalized once, into a staged table; its digests give both the
    counters and the duplicates.  The small tables come from one aggregation over the scored reviews; quotes,
    terms and missing values scan the columns they need.  Nothing is left in the shared folder.
    """
    spark = standardized.sparkSession
    wanted = list(summaries if summaries is not None else SUMMARIES)
    with Landing(spark) as landing:
        staged = landing.land(clean.staged(standardized, rules, min_words), "staged")
        digests = staged.select(*order, "status", "text_key")
        write_table(clean.count_reductions(clean.per_text(digests)), f"{out_dir}/quality_counts", summary_format)
        copies = landing.land(clean.later_copies(digests, order), "copies")
        kept = clean.without(staged.where("status = 'usable'"), copies, order).drop("status", "text_key")
        write_table(annotate(kept, rules), f"{out_dir}/scored_reviews")
        scored = spark.read.parquet(f"{out_dir}/scored_reviews")
        if any(name in FROM_TALLY for name in wanted):
            tallied = landing.land(tally(scored, rules), "tally")
        for name in wanted:
            table = FROM_TALLY[name](tallied, rules) if name in FROM_TALLY else SUMMARIES[name](scored, rules)
            write_table(table, f"{out_dir}/{name}", summary_format)
    return scored
