import pytest
from pyspark.sql import functions as F

from voxtally.operators import kpis, quant, sentiment, summaries, themes
from voxtally.plans.stages import SUMMARIES
from voxtally.rules import DEFAULT_RULES as RULES

DELAY, COMM, BAG = "delay frustration", "poor communication", "baggage problems"
CANCEL, REBOOK, REFUND, SUPPORT = ("cancellation stress", "rebooking friction", "refund difficulty",
                                   "customer support responsiveness")


@pytest.fixture(scope="module")
def scored(spark):
    """(id, themes, label, points, rating, airline, recommended, hits)"""
    rows = [
        ("a", [DELAY, BAG], "negative", -300, 1.0, "Delta", False, ["delay", "baggage"]),
        ("b", [DELAY], "negative", -150, 2.0, "Delta", True, ["delay", "long wait"]),
        ("c", [DELAY, BAG, COMM], "positive", 100, 5.0, None, None, ["delay", "baggage", "unclear"]),
        ("d", [BAG], "neutral", 0, None, "United", True, ["baggage"]),
        ("e", [], "positive", 250, 5.0, "United", True, ["kind"]),
        ("f", [CANCEL, COMM], "negative", -400, 3.0, "United", False, ["cancelled", "bag"]),
    ]
    df = spark.createDataFrame(rows, "review_id string, themes array<string>, sentiment_label string, "
                                     "sentiment_points int, rating double, airline string, recommended boolean, "
                                     "phrase_hits array<string>")
    return df.withColumns({
        "rating_bucket": F.expr("CASE WHEN rating IS NULL THEN 'unknown' WHEN rating <= 2 THEN 'low' "
                                "WHEN rating = 3 THEN 'medium' ELSE 'high' END"),
        "clean_text": F.lit("words only here"), "is_synthetic": F.expr("review_id = 'e'"),
        "disruption_type": F.expr("IF(review_id = 'd', NULL, 'delay')")}).repartition(3)


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_theme_summary(scored):
    got = rows(themes.theme_summary(scored), "theme", "count", "share_of_reviews_pct", "avg_rating")
    assert got[:4] == [(BAG, 3, 50.0, 3.0), (DELAY, 3, 50.0, 2.67), (COMM, 2, 33.33, 4.0), (CANCEL, 1, 16.67, 3.0)]
    assert len(got) == 12 and got[4:] == sorted((t, 0, 0.0, None) for t in RULES.theme_labels if t not in
                                                (BAG, DELAY, COMM, CANCEL))
    frequency = rows(quant.theme_frequency(scored), "theme", "count", "share_of_reviews_pct")
    assert frequency == [g[:3] for g in got]


def test_summaries_of_nothing(scored):
    nothing = scored.where("false")
    assert set(rows(themes.theme_summary(nothing), "count", "share_of_reviews_pct", "avg_rating")) == {(0, 0.0, None)}
    assert rows(quant.pain_point_pairs(nothing), "count", "share_of_reviews_pct") == [(0, 0.0)] * 3
    assert quant.seeded_phrases(nothing).count() == quant.ngram_frequency(nothing).count() == 0
    assert kpis.headline_lists(nothing).where("count > 0").count() == 0
    assert rows(kpis.corpus_kpis(nothing), "total_reviews", "average_rating") == [(0, None)]


def test_coverage(scored):
    assert rows(themes.theme_coverage(scored), "reviews_coded", "reviews_with_theme", "reviews_without_theme") == [(6, 5, 1)]


def test_sentiment_tables(scored):
    assert rows(sentiment.sentiment_summary(scored), "sentiment", "count", "avg_sentiment_score",
                "share_of_reviews_pct") == [
        ("negative", 3, -2.83, 50.0), ("neutral", 1, 0.0, 16.67), ("positive", 2, 1.75, 33.33)]
    got = rows(sentiment.sentiment_by_theme(scored), "theme", "review_count", "avg_sentiment_score", "negative_count",
               "neutral_count", "positive_count", "negative_share_pct", "most_common_sentiment")
    assert got[:4] == [
        (CANCEL, 1, -4.0, 1, 0, 0, 100.0, "negative"), (DELAY, 3, -1.17, 2, 0, 1, 66.67, "negative"),
        (COMM, 2, -1.5, 1, 0, 1, 50.0, "negative"), (BAG, 3, -0.67, 1, 1, 1, 33.33, "negative")]
    assert all(g[1:] == (0, None, 0, 0, 0, 0.0, None) for g in got[4:])


def test_negative_phrases(scored):
    got = rows(quant.seeded_phrases(scored), "term", "count", "share_of_negative_reviews_pct", "source")
    source = "seeded_phrase_count"
    # "bag" is too short to be a term
    assert got == [("delay", 2, 66.67, source), ("baggage", 1, 33.33, source), ("cancelled", 1, 33.33, source),
                   ("long wait", 1, 33.33, source)]
    assert quant.seeded_phrases(scored, limit=2).count() == 2
    assert rows(quant.negative_terms(scored), "term", "count") == [g[:2] for g in got]


def test_ngrams_and_fallback(spark, scored):
    texts = ["gate chaos gate chaos the flight", "gate a chaos", "calm gate"]
    df = spark.createDataFrame([(t, "negative", []) for t in texts] + [("gate zone", "positive", [])],
                               "clean_text string, sentiment_label string, phrase_hits array<string>")
    expected = [("gate", 4), ("chaos", 3), ("gate chaos", 3), ("calm", 1), ("calm gate", 1), ("chaos gate", 1)]
    assert rows(quant.ngram_frequency(quant.negative_reviews(df)), "term", "count") == expected
    assert rows(quant.negative_terms(df), "term", "count", "source") == [(t, n, None) for t, n in expected]


@pytest.mark.parametrize("reviews, least", [(99, 1), (100, 2), (499, 2), (500, 3)])
def test_ngram_minimum_follows_the_number_of_reviews(spark, reviews, least):
    texts = spark.range(reviews).selectExpr(
        "concat_ws(' ', 'filler', IF(id < 1, 'alpha', NULL), IF(id < 2, 'beta', NULL), IF(id < 3, 'gamma', NULL)) AS clean_text")
    found = {t for (t,) in rows(quant.ngram_frequency(texts), "term")}
    assert [w in found for w in ("alpha", "beta", "gamma")] == [least <= n for n in (1, 2, 3)]


@pytest.mark.parametrize("buckets, first_buckets, limit", [(64, 1, 40), (1 << 16, 320, 40), (128, 2, 5), (3, 3, 1)])
def test_ngrams_equal_a_whole_count(spark, buckets, first_buckets, limit):
    import collections
    import random
    pick = random.Random(6)
    words = [f"w{min(int(pick.paretovariate(0.7)), 60)}" for _ in range(6000)]
    texts = [" ".join(words[i : i + pick.randrange(0, 50)]) for i in range(0, 6000, 30)] + ["", "the", "a b c"]
    df = spark.createDataFrame([(t,) for t in texts], "clean_text string").repartition(5)
    count, documents = collections.Counter(), collections.Counter()
    for text in texts:
        kept = [w for w in text.split() if len(w) > 1 and w not in quant.DEFAULT_STOP_WORDS]
        terms = kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])]
        count.update(terms)
        documents.update(set(terms))
    want = sorted(((t, n) for t, n in count.items() if documents[t] >= 2), key=lambda x: (-x[1], x[0]))[:limit]
    assert rows(quant.ngram_frequency(df, limit=limit, buckets=buckets, first_buckets=first_buckets), "term", "count") == want


def test_rating_tables(scored):
    assert rows(quant.rating_distribution(scored), "rating", "rating_bucket", "count", "share_of_rated_reviews_pct") == [
        (1.0, "low", 1, 20.0), (2.0, "low", 1, 20.0), (3.0, "medium", 1, 20.0), (5.0, "high", 2, 40.0)]
    assert rows(kpis.rating_buckets(scored), "low_rated", "medium_rated", "high_rated", "rated_total") == [(2, 1, 2, 5)]


def test_crosstabs(scored):
    got = rows(quant.theme_vs_recommendation(scored), "theme", "recommendation", "count", "share_within_theme_pct")
    assert got[:3] == [(BAG, "no", 1, 33.33), (BAG, "unknown", 1, 33.33), (BAG, "yes", 1, 33.33)]
    assert (DELAY, "Unknown airline", 1, 33.33) in rows(
        quant.theme_vs_airline(scored), "theme", "airline", "count", "share_within_theme_pct")
    assert rows(quant.theme_vs_sentiment(scored).where(F.col("theme") == DELAY), "sentiment", "count") == [
        ("negative", 2), ("positive", 1)]
    assert quant.theme_rows(scored).count() == 9
    pivot = {r[0]: r[1:] for r in rows(kpis.recommendation_pivot(scored), "theme", "yes_share_pct", "no_share_pct")}
    assert pivot[CANCEL] == (0.0, 100.0) and pivot[BAG] == (33.33, 33.33)
    assert len(pivot) == 12 and (0.0, 0.0) in pivot.values()  # themes that no review has are there


def test_pairs_keep_focus_pairs_at_zero(scored):
    got = rows(quant.pain_point_pairs(scored), "combination_label", "count", "share_of_reviews_pct", "is_focus_combination")
    assert got == [
        (f"{CANCEL} + {COMM}", 1, 16.67, True), (f"{DELAY} + {REBOOK}", 0, 0.0, True), (f"{REFUND} + {SUPPORT}", 0, 0.0, True),
        (f"{DELAY} + {BAG}", 2, 33.33, False), (f"{DELAY} + {COMM}", 1, 16.67, False), (f"{COMM} + {BAG}", 1, 16.67, False),
    ][:4] + sorted([(f"{DELAY} + {COMM}", 1, 16.67, False), (f"{COMM} + {BAG}", 1, 16.67, False)])
    assert rows(kpis.highlighted_pairs(scored, limit=4), "combination_label") == [(g[0],) for g in got[:4]]


def test_headline_figures(scored):
    row = kpis.corpus_kpis(scored).first().asDict()
    assert row == dict(total_reviews=6, airlines_covered=2, public_reviews=5, synthetic_reviews=1, average_rating=3.2,
                       median_rating=3.0, recommended_share_pct=60.0, public_share_pct=83.33, synthetic_share_pct=16.67)
    assert rows(kpis.disruption_counts(scored), "disruption_type", "count") == [("delay", 5), ("unknown", 1)]
    assert rows(kpis.top_pain_points(scored, limit=2), "theme") == [(BAG,), (DELAY,)]
    assert rows(kpis.most_negative_themes(scored), "theme") == [(CANCEL,), (DELAY,), (COMM,), (BAG,)]
    assert rows(kpis.recovery_signals(scored), "theme", "positive_share_pct") == [
        (COMM, 50.0), (BAG, 33.33), (DELAY, 33.33), (CANCEL, 0.0)]


def test_headline_lists_agree_with_their_tables(scored):
    lists = {}
    for r in kpis.headline_lists(scored).collect():
        lists.setdefault(r.list_name, []).append((r.label, r["count"], r.share_pct))
    frequency = rows(quant.theme_frequency(scored), "theme", "count", "share_of_reviews_pct")
    pairs = rows(quant.pain_point_pairs(scored), "combination_label", "count", "share_of_reviews_pct")
    assert lists["top_themes"] == frequency[:5]
    assert lists["top_negative_themes"] == rows(
        sentiment.sentiment_by_theme(scored), "theme", "review_count", "negative_share_pct")[:5]
    assert lists["top_negative_phrases"] == rows(
        quant.seeded_phrases(scored), "term", "count", "share_of_negative_reviews_pct")
    assert lists["leading_pairs"] == pairs[:5]
    assert lists["top_pairs"] == sorted(pairs, key=lambda p: (-p[1], p[0]))[:5]


@pytest.mark.parametrize("which", ["all", "none"])
def test_every_table_from_one_tally(scored, which):
    scored = scored.where(F.lit(which == "all"))
    tallied = summaries.tally(scored)
    direct = {**SUMMARIES, "top_pain_points": kpis.top_pain_points, "most_negative_themes": kpis.most_negative_themes,
              "highlighted_pairs": kpis.highlighted_pairs}
    for name, cut in summaries.FROM_TALLY.items():
        got, want = cut(tallied, RULES), direct[name](scored, RULES)
        assert got.dtypes == want.dtypes, name
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), name


def quotes_frame(spark, rows):
    columns = "review_id string, is_synthetic boolean, text_length int, review_date date, analysis_text string"
    return spark.createDataFrame(rows, columns).selectExpr(
        "*", f"array('{DELAY}') AS themes", "'Delta' AS airline", "'s' AS source", "5D AS rating").repartition(4)


def test_quotes_order_and_distinct_excerpts(spark):
    from datetime import date
    df = quotes_frame(spark, [
        ("synthetic", True, 320, date(2024, 1, 1), "s"), ("old", False, 320, date(2023, 1, 1), "o"),
        ("undated", False, 320, None, "u"), ("new", False, 320, date(2024, 1, 1), "n"),
        ("copy", False, 320, date(2022, 1, 1), "n"), ("far", False, 10, date(2024, 1, 1), "f")])
    assert rows(themes.theme_quotes(df, 5), "quote_rank", "review_id") == [
        (1, "new"), (2, "old"), (3, "undated"), (4, "far"), (5, "synthetic")]
    assert rows(kpis.lead_quotes(df), "theme", "review_id") == [(DELAY, "new")]


def test_quotes_behind_many_copies_are_found(spark):
    """A third of all rows share one excerpt and fill the front."""
    copies = [(f"c{i:03d}", False, 320, None, "x" * 300) for i in range(200)]
    others = [(f"o{i:03d}", False, 400 + i, None, f"text {i}") for i in range(400)]
    found = rows(themes.theme_quotes(quotes_frame(spark, copies + others), 3), "quote_rank", "review_id")
    assert found == [(1, "c000"), (2, "o000"), (3, "o001")]


def test_ngrams_make_their_terms_once_for_each_use(spark):
    rows = [("the slow slow desk",), ("slow desk a queue",), ("a",), ("",), (None,), ("slow slow slow",)]
    df = spark.createDataFrame(rows, "clean_text string")
    counted = quant.ngram_frequency(df, stop_words=["the"], limit=10, least_reviews=(), buckets=7, first_buckets=2)
    assert [tuple(r) for r in counted.collect()] == [("slow", 6), ("slow slow", 3), ("desk", 2), ("slow desk", 2), ("desk queue", 1), ("queue", 1)]
    assert quant.ngram_frequency(df, stop_words=[], limit=1).collect()[0].term == "slow"
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    # neither the terms nor their buckets are asked for by a filter in front of the sums
    assert not [line for line in plan.splitlines() if "Filter" in line and ("lambda" in line or ("bucket#" in line and " n#" not in line))]
