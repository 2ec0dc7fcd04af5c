"""Headline figures and the tables behind charts and reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.functions import match
from voxtally.functions.literals import sql_array, sql_let
from voxtally.functions.text import aliased, excerpt, share_pct, strip, with_exprs
from voxtally.operators import quant
from voxtally.operators.sentiment import sentiment_by_theme
from voxtally.operators.themes import first_quotes, match_text, theme_table
from voxtally.rules import DEFAULT_RULES, RuleSet

REPORT_CHARS = 190


def disruption_counts(cleaned: DataFrame, limit: int = 8) -> DataFrame:
    """Most frequent disruption types."""
    kind = F.expr("coalesce(disruption_type, 'unknown')").alias("disruption_type")
    return disruption_rows(cleaned.groupBy(kind).agg(F.expr("count(1)").alias("count")), limit)


def disruption_rows(grouped: DataFrame, limit: int = 8) -> DataFrame:
    return (grouped.orderBy(F.desc("count"), "disruption_type").limit(limit))


def top_pain_points(coded: DataFrame, rules: RuleSet = DEFAULT_RULES, limit: int = 8) -> DataFrame:
    """Most frequent themes among the pain points."""
    return pain_point_rows(quant.theme_frequency(coded, rules), rules, limit)


def pain_point_rows(frequency: DataFrame, rules: RuleSet = DEFAULT_RULES, limit: int = 8) -> DataFrame:
    return (frequency.where(F.col("theme").isin(*rules.pain_points))
            .orderBy(F.desc("count"), "theme").limit(limit))


def most_negative_themes(scored: DataFrame, rules: RuleSet = DEFAULT_RULES, limit: int = 8) -> DataFrame:
    """Themes with the largest negative share, among those that occur."""
    return negative_theme_rows(sentiment_by_theme(scored, rules), limit)


def negative_theme_rows(by_theme: DataFrame, limit: int = 8) -> DataFrame:
    return by_theme.where("review_count > 0").orderBy(F.desc("negative_share_pct"), F.desc("review_count"), "theme").limit(limit)


def highlighted_pairs(coded: DataFrame, rules: RuleSet = DEFAULT_RULES, limit: int = 8) -> DataFrame:
    """Focus pairs first, then the most frequent others."""
    return quant.pain_point_pairs(coded, rules).limit(limit)


def corpus_kpis(cleaned: DataFrame) -> DataFrame:
    """One row of figures about the cleaned reviews.

    The median is exact: its memory grows with the number of different ratings,
    of which there are few, not with the number of reviews.
    """
    row = cleaned.agg(*aliased({
        "total_reviews": "count(1)",
        "airlines_covered": "count(DISTINCT airline)",
        "public_reviews": "count_if(NOT is_synthetic)",
        "synthetic_reviews": "count_if(is_synthetic)",
        "average_rating": "bround(avg(rating), 2)",
        "median_rating": "bround(median(rating), 2)",
        "recommended_share_pct": "bround(avg(int(recommended)) * 100, 2)",
    }))
    return kpi_rows(row)


def kpi_rows(row: DataFrame) -> DataFrame:
    return with_exprs(row, {
        "public_share_pct": share_pct("public_reviews", "total_reviews"),
        "synthetic_share_pct": share_pct("synthetic_reviews", "total_reviews"),
    })


def rating_buckets(scored: DataFrame) -> DataFrame:
    """One row: rated reviews per bucket and in total."""
    buckets = {f"{name}_rated": f"count_if(rating IS NOT NULL AND rating_bucket = '{name}')"
               for name in ("low", "medium", "high")}
    return scored.agg(*aliased({**buckets, "rated_total": "count(rating)"}))


def recommendation_pivot(scored: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Share of yes and no per theme, unused themes included, 0 where nobody said so."""
    return pivot_rows(quant.theme_vs_recommendation(scored), rules)


def pivot_rows(crosstab: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """:func:`recommendation_pivot` from the cross-tabulation of themes and answers."""
    def share(answer: str) -> str:
        return f"coalesce(max(share_within_theme_pct) FILTER (WHERE recommendation = '{answer}'), 0D)"

    answers = crosstab.groupBy("theme").agg(
        *aliased({"yes_share_pct": share("yes"), "no_share_pct": share("no")}))
    # no more rows than themes on either side
    return (theme_table(crosstab, rules).select("theme").join(answers, "theme", "left")
            .select("theme", *aliased({n: f"coalesce({n}, 0D)" for n in ("yes_share_pct", "no_share_pct")})).orderBy("theme"))


def recovery_signals(scored: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Share of positive reviews per theme that occurs."""
    return recovery_rows(sentiment_by_theme(scored, rules))


def recovery_rows(by_theme: DataFrame) -> DataFrame:
    table = by_theme.where("review_count > 0")
    share = f"{share_pct('positive_count', 'review_count')} AS positive_share_pct"
    return (table.selectExpr("theme", "review_count", "positive_count", share)
            .orderBy(F.desc("positive_share_pct"), "theme"))


def lead_quotes(coded: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """The first quote of each theme, shortened for a report."""
    short = f"{excerpt(strip('quote_excerpt'), REPORT_CHARS)} AS excerpt"
    return first_quotes(coded, rules).selectExpr("theme", "review_id", "airline", short)


#: Entries of each headline list.
LIST_LENGTHS = {"top_themes": 5, "top_negative_themes": 5, "top_negative_phrases": 10, "top_pairs": 5, "leading_pairs": 5}


def headline_lists(scored: DataFrame, rules: RuleSet = DEFAULT_RULES, lengths: Mapping[str, int] | None = None) -> DataFrame:
    """The short lists a report opens with, as ``(list_name, position, label, count, share_pct)``.

    ``lengths`` replaces single entries of :data:`LIST_LENGTHS`.
    All lists come from one pass over the reviews, see :func:`_tally`.
    """
    return list_rows(_tally(scored, rules), lengths)


def list_rows(tally: DataFrame, lengths: Mapping[str, int] | None = None) -> DataFrame:
    """:func:`headline_lists` from rows as :func:`_tally` gives them."""
    of_reviews, of_negative = share_pct("n", "reviews"), share_pct("n", "negative_reviews")
    negative_share = share_pct("negative", "n")
    # points are hundredths; a theme without reviews sorts last
    mean = "coalesce(bround(try_divide(points, n) / 100D, 2), double('Infinity'))"
    longest = {**LIST_LENGTHS, **(lengths or {})}
    lists = [  # name, kind of row, share shown; then descending, ascending, descending sort values
        ("top_themes", "theme", of_reviews, "n", "0", "0"),
        ("top_negative_themes", "theme", negative_share, negative_share, mean, "n"),
        ("top_negative_phrases", "term", of_negative, "n", "0", "0"),
        ("top_pairs", "pair", of_reviews, "n", "0", "0"),
        ("leading_pairs", "pair", of_reviews, "int(focus)", "0", "n"),
    ]
    entries = ", ".join(f"""CASE WHEN kind = '{kind}' THEN named_struct('list_name', '{name}', 'length', {int(longest[name])},
        'share_pct', {share}, 'by_1', double({first}), 'by_2', double({second}), 'by_3', double({third})) END"""
                        for name, kind, share, first, second, third in lists)
    listed = tally.selectExpr(
        f"inline(filter(array({entries}), entry -> entry IS NOT NULL))", "label", "n AS count")
    rank = F.expr("row_number() OVER (PARTITION BY list_name ORDER BY by_1 DESC, by_2, by_3 DESC, label)")
    return (listed.withColumn("position", rank).where("position <= length")
            .select("list_name", "position", "label", "count", "share_pct").orderBy("list_name", "position"))


def _tally(scored: DataFrame, rules: RuleSet) -> DataFrame:
    """Reviews, negative reviews and points per theme, negative term and pair of pain points.

    As many rows as the dictionaries have entries and pairs, whatever the data.
    """
    if not match.matched_by(scored, rules):
        scored = match_text(scored, rules)
    pains = f"array_intersect({sql_array(rules.ordered_pain_points())}, themes)"
    pair_labels = f"transform({quant.pairs_of('v.pains')}, p -> concat(p.theme_a, ' + ', p.theme_b))"
    terms = f"array_intersect({sql_array(rules.candidate_terms())}, phrase_hits)"

    def named(kind: str, labels: str) -> str:
        return f"transform({labels}, label -> named_struct('kind', '{kind}', 'label', label))"

    items = ", ".join([
        named("review", "array('all')"), named("theme", "themes"), named("pair", sql_let({"pains": pains}, pair_labels)),
        named("term", f"IF(sentiment_label = 'negative', {terms}, {sql_array([])})")])
    rows = scored.selectExpr(f"inline(concat({items}))", "int(sentiment_label = 'negative') AS negative",
                             "sentiment_points AS points", "1 AS n")
    return tally_rows(rows, rules)


def tally_rows(rows: DataFrame, rules: RuleSet) -> DataFrame:
    """Sums of ``n``, ``negative`` and ``points`` per ``kind`` and ``label``, with every theme and focus pair, and the totals."""
    def named(kind: str, labels: str) -> str:
        return f"transform({labels}, label -> named_struct('kind', '{kind}', 'label', label))"

    focus = sql_array([f"{a} + {b}" for a, b in rules.focus_pairs])
    always = f"concat({named('theme', sql_array(rules.theme_labels))}, {named('pair', focus)})"
    zeros = rows.sparkSession.range(1).selectExpr(f"inline({always})", "0 AS negative", "0 AS points", "0 AS n")
    counted = rows.unionByName(zeros).groupBy("kind", "label").agg(
        *aliased({name: f"sum({name})" for name in ("n", "negative", "points")}))
    return with_exprs(counted, {
        "reviews": "coalesce(max(IF(kind = 'review', n, NULL)) OVER (), 0L)",
        "negative_reviews": "coalesce(max(IF(kind = 'review', negative, NULL)) OVER (), 0L)",
        "focus": f"array_contains({focus}, label)",
    })
