"""Every small result table from one pass over the scored reviews.

A review gives one row for each thing it is counted under: itself, its themes with their sentiment, airline and answer,
its rating, its combination of pain points, and so on.  One aggregation adds them up.  What comes out has
as many rows as there are themes, airlines, ratings and combinations, however many reviews there are, and every table is
cut from it.  Write it before cutting more than one table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.functions import match
from voxtally.functions.literals import sql_array
from voxtally.functions.text import aliased, flag_label
from voxtally.operators import kpis, quant, sentiment, themes
from voxtally.rules import DEFAULT_RULES, RuleSet

_JOIN = "\x1f"  # between the pain points of a combination


def tally(scored: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """``kind``, ``a``, ``b`` and the sums over the reviews counted there: ``n``, ``negative``, ``points``, ``rated`` and ``rating``."""
    if not match.matched_by(scored, rules):
        scored = themes.match_text(scored, rules)
    pains = f"array_join(array_intersect({sql_array(rules.ordered_pain_points())}, themes), '{_JOIN}')"
    terms = f"array_intersect({sql_array(rules.candidate_terms())}, phrase_hits)"

    def one(kind: str, a: str = "NULL", b: str = "NULL", when: str = "true") -> str:
        entry = f"named_struct('kind', '{kind}', 'a', string({a}), 'b', string({b}))"
        return f"array({entry})" if when == "true" else f"IF({when}, array({entry}), cast(array() AS array<struct<kind:string,a:string,b:string>>))"

    def each(kind: str, items: str, b: str = "NULL") -> str:
        return f"transform({items}, item -> named_struct('kind', '{kind}', 'a', item, 'b', string({b})))"

    counted = ", ".join([
        one("review", "size(themes) > 0"), one("origin", "coalesce(is_synthetic, false)"), one("answer", flag_label("recommended")),
        one("sentiment", "sentiment_label"), one("rating", "rating", "rating_bucket", "rating IS NOT NULL"), one("airline", "airline"),
        one("pains", pains), one("disruption", "coalesce(disruption_type, 'unknown')"),
        each("theme", "themes", "sentiment_label"), each("theme_airline", "themes", f"coalesce(airline, '{quant.UNKNOWN_AIRLINE}')"),
        each("theme_answer", "themes", flag_label("recommended")),
        each("term", f"IF(sentiment_label = 'negative', {terms}, {sql_array([])})"),
    ])
    rows = scored.selectExpr(f"inline(concat({counted}))", "int(sentiment_label = 'negative') AS negative", "sentiment_points AS points",
                             "int(rating IS NOT NULL) AS rated", "rating")
    return rows.groupBy("kind", "a", "b").agg(*aliased({"n": "count(1)", **{c: f"sum({c})" for c in ("negative", "points", "rated", "rating")}}))


def _of(tallied: DataFrame, kind: str) -> DataFrame:
    return tallied.where(F.col("kind") == kind)


def _by_theme(tallied: DataFrame, rules: RuleSet) -> DataFrame:
    """A row per theme with reviews, all reviews, mean rating, mean score and the number of each label."""
    counts = {f"{label}_count": f"coalesce(sum(n) FILTER (WHERE kind = 'theme' AND b = '{label}'), 0L)" for label in sentiment.LABELS}
    # reviews stand under the theme that is null; no more rows than themes from here on
    grouped = tallied.where("kind IN ('theme', 'review')").groupBy(F.expr("IF(kind = 'theme', a, NULL)").alias("theme")).agg(*aliased({
        "reviews": "sum(n)", "rating_mean": "try_divide(sum(rating), sum(rated))", "score_mean": "sum(points) / sum(n) / 100D", **counts}))
    return themes.every_theme(grouped.withColumn("total", F.expr("max(IF(theme IS NULL, reviews, NULL)) OVER ()")), rules)


def theme_summary(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return themes.summary_rows(_by_theme(tallied, rules).withColumn("mean", F.col("rating_mean")))


def theme_coverage(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    reviews = _of(tallied, "review")
    return reviews.agg(*aliased({
        "reviews_coded": "coalesce(sum(n), 0L)",
        "reviews_with_theme": "coalesce(sum(n) FILTER (WHERE a = 'true'), 0L)",
        "reviews_without_theme": "coalesce(sum(n) FILTER (WHERE a = 'false'), 0L)",
    }))


def theme_frequency(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return quant.frequency_rows(_by_theme(tallied, rules))


def sentiment_summary(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return sentiment.label_rows(_of(tallied, "sentiment").selectExpr("a AS sentiment", "n AS count", "bround(points / n / 100D, 2) AS avg_sentiment_score"))


def sentiment_by_theme(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return sentiment.by_theme_rows(_by_theme(tallied, rules).withColumn("mean", F.col("score_mean")))


def source_mix(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return _of(tallied, "origin").selectExpr("IF(a = 'true', 'synthetic', 'public') AS origin", "n AS count")


def rating_distribution(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return quant.distribution_rows(_of(tallied, "rating").selectExpr("double(a) AS rating", "b AS rating_bucket", "n AS count"))


def _crosstab(tallied: DataFrame, kind: str, name: str) -> DataFrame:
    return quant.crosstab_rows(_of(tallied, kind).selectExpr("a AS theme", f"b AS {name}", "n AS count"), name)


def theme_vs_sentiment(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return _crosstab(tallied, "theme", "sentiment")


def theme_vs_airline(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return _crosstab(tallied, "theme_airline", "airline")


def theme_vs_recommendation(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return _crosstab(tallied, "theme_answer", "recommendation")


def _combinations(tallied: DataFrame) -> DataFrame:
    return _of(tallied, "pains").selectExpr(f"IF(a = '', {sql_array([])}, split(a, '{_JOIN}')) AS pains", "n")


def pain_point_pairs(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return quant.pair_rows(_combinations(tallied), rules)


def seeded_phrases(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES, limit: int = quant.TOP_TERMS) -> DataFrame:
    negative = tallied.where("kind = 'sentiment' AND a = 'negative'").selectExpr("cast(NULL AS string) AS term", "n AS count")
    return quant.phrase_rows(_of(tallied, "term").selectExpr("a AS term", "n AS count").unionByName(negative), limit)


def disruption_counts(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return kpis.disruption_rows(_of(tallied, "disruption").selectExpr("a AS disruption_type", "n AS count"))


def top_pain_points(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return kpis.pain_point_rows(theme_frequency(tallied, rules), rules)


def most_negative_themes(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return kpis.negative_theme_rows(sentiment_by_theme(tallied, rules))


def highlighted_pairs(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES, limit: int = 8) -> DataFrame:
    return pain_point_pairs(tallied, rules).limit(limit)


def corpus_kpis(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """The median is that of the ratings in their order, by how many reviews lie up to each."""
    def many(kind: str, a: str) -> str:
        return f"coalesce(sum(n) FILTER (WHERE kind = '{kind}' AND a = '{a}'), 0L)"

    row = tallied.agg(*aliased({
        "total_reviews": "coalesce(sum(n) FILTER (WHERE kind = 'review'), 0L)",
        "airlines_covered": "count_if(kind = 'airline' AND a IS NOT NULL)",
        "public_reviews": many("origin", "false"), "synthetic_reviews": many("origin", "true"),
        "average_rating": "bround(try_divide(sum(rating) FILTER (WHERE kind = 'review'), sum(rated) FILTER (WHERE kind = 'review')), 2)",
        "ratings": "array_sort(collect_list(struct(double(a) AS rating, n)) FILTER (WHERE kind = 'rating'))",
        "recommended_share_pct": f"bround(try_divide({many('answer', 'yes')}, {many('answer', 'yes')} + {many('answer', 'no')}) * 100, 2)",
    }))
    upto = "aggregate(slice(ratings, 1, i + 1), 0L, (sum, r) -> sum + r.n)"
    row = row.withColumn("ratings", F.expr(f"transform(ratings, (r, i) -> struct(r.rating, {upto} AS upto))")).withColumn(
        "rated", F.expr("coalesce(get(ratings, size(ratings) - 1).upto, 0L)"))
    at = [f"get(filter(ratings, r -> r.upto >= {place}), 0).rating" for place in ("(rated + 1) div 2", "rated div 2 + 1")]
    row = row.withColumn("median_rating", F.expr(f"bround(({at[0]} + {at[1]}) / 2D, 2)"))
    return kpis.kpi_rows(row.select("total_reviews", "airlines_covered", "public_reviews", "synthetic_reviews", "average_rating", "median_rating", "recommended_share_pct"))


def rating_buckets(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    rated = _of(tallied, "rating")
    buckets = {f"{name}_rated": f"coalesce(sum(n) FILTER (WHERE b = '{name}'), 0L)" for name in ("low", "medium", "high")}
    return rated.agg(*aliased({**buckets, "rated_total": "coalesce(sum(n), 0L)"}))


def recommendation_pivot(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return kpis.pivot_rows(theme_vs_recommendation(tallied), rules)


def recovery_signals(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return kpis.recovery_rows(sentiment_by_theme(tallied, rules))


def headline_lists(tallied: DataFrame, rules: RuleSet = DEFAULT_RULES, lengths: Mapping[str, int] | None = None) -> DataFrame:
    sums = ("negative", "points", "n")
    same = _of(tallied, "theme").unionAll(_of(tallied, "term")).selectExpr("kind", "a AS label", *sums)
    reviews = _of(tallied, "review").selectExpr("'review' AS kind", "'all' AS label", *sums)
    pairs = _of(tallied, "pains").selectExpr(
        f"explode({quant.pairs_of(f'''split(a, '{_JOIN}')''')}) AS pair", *sums).selectExpr("'pair' AS kind", "concat(pair.theme_a, ' + ', pair.theme_b) AS label", *sums)
    return kpis.list_rows(kpis.tally_rows(same.unionAll(reviews).unionAll(pairs), rules), lengths)


#: Result tables by name, cut from one tally.
FROM_TALLY: dict[str, Callable[[DataFrame, RuleSet], DataFrame]] = {
    "source_mix": source_mix,
    "theme_summary": theme_summary,
    "theme_coverage": theme_coverage,
    "sentiment_summary": sentiment_summary,
    "sentiment_by_theme_summary": sentiment_by_theme,
    "theme_frequency_summary": theme_frequency,
    "rating_distribution_summary": rating_distribution,
    "theme_vs_sentiment_crosstab": theme_vs_sentiment,
    "theme_vs_airline_crosstab": theme_vs_airline,
    "theme_vs_recommendation_crosstab": theme_vs_recommendation,
    "pain_point_combinations_summary": pain_point_pairs,
    "disruption_counts": disruption_counts,
    "top_pain_points": top_pain_points,
    "most_negative_themes": most_negative_themes,
    "highlighted_pairs": highlighted_pairs,
    "corpus_kpis": corpus_kpis,
    "rating_buckets": rating_buckets,
    "recommendation_pivot": recommendation_pivot,
    "recovery_signals": recovery_signals,
    "headline_lists": headline_lists,
}
