"""Matches made with one set of dictionaries are not taken for those of another."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from voxtally.functions import match
from voxtally.operators import clean, kpis, quant, sentiment, themes
from voxtally.rules import DEFAULT_RULES, NegativeExperience, Signals

TERM = "seat recline"
OTHER = replace(
    DEFAULT_RULES,
    themes=(replace(DEFAULT_RULES.themes[0], phrases=(*DEFAULT_RULES.themes[0].phrases, TERM)), *DEFAULT_RULES.themes[1:]),
    lexicon=replace(DEFAULT_RULES.lexicon, negative_phrases={**DEFAULT_RULES.lexicon.negative_phrases, TERM: -5.0}),
    negative_terms=(*DEFAULT_RULES.negative_terms, TERM),
    disruption_keywords=(*DEFAULT_RULES.disruption_keywords, TERM),
)


@pytest.fixture(scope="module", params=["fresh", "written"])
def matched(request, spark, tmp_path_factory):
    df = spark.createDataFrame([("r0", "the seat recline was poor", 1.0, "delay")], "review_id string, clean_text string, rating double, disruption_type string")
    df = df.withColumns({"airline": F.lit("Delta"), "recommended": F.lit(False), "is_synthetic": F.lit(False)})
    df = themes.match_text(df)
    if request.param == "fresh":
        return df
    path = str(tmp_path_factory.mktemp("matched") / "table")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_fingerprint():
    assert DEFAULT_RULES.fingerprint() == replace(DEFAULT_RULES).fingerprint() != OTHER.fingerprint()


def test_same_rules_reuse_and_others_do_not(matched):
    assert match.matched_by(matched, DEFAULT_RULES) and not match.matched_by(matched, OTHER)
    assert match.matched_by(matched.withColumn("phrase_hits", F.array(F.lit("x"))), OTHER)  # the caller's own


def test_themes(matched):
    assert OTHER.themes[0].label not in themes.code_themes(matched).first().themes
    assert OTHER.themes[0].label in themes.code_themes(matched, OTHER).first().themes


def test_sentiment(matched):
    before, after = (sentiment.score_sentiment(matched, rules).first().sentiment_points for rules in (DEFAULT_RULES, OTHER))
    assert after == before - 500


def test_disruption_keywords(matched):
    assert TERM in clean.derived_fields(matched, OTHER).first().disruption_keywords
    assert TERM not in clean.derived_fields(matched).first().disruption_keywords


def test_negative_terms(matched):
    scored = matched.withColumn("sentiment_label", F.lit("negative"))
    assert {r.term: r["count"] for r in quant.seeded_phrases(scored, OTHER).collect()}[TERM] == 1
    scored = scored.withColumns({"themes": F.array().cast("array<string>"), "sentiment_points": F.lit(-500), "rating_bucket": F.lit("low")})
    listed = kpis.headline_lists(scored, OTHER).where(F.col("label") == TERM).collect()
    assert [r["count"] for r in listed] == [1]


def test_limits_and_signals_are_the_callers(matched):
    rules = replace(DEFAULT_RULES, signals=Signals(low_rating=0, high_rating=1, high_points=2.5), negative_experience=NegativeExperience(rating=0.5, costly_types=("delay",), keywords=0))
    praised = matched.withColumn("recommended", F.lit(None).cast("boolean"))
    assert clean.derived_fields(praised, rules).first().likely_negative_experience is True
    assert clean.derived_fields(praised.withColumn("disruption_type", F.lit("refund")), rules).first().likely_negative_experience is False
    row = sentiment.add_sentiment_evidence(sentiment.score_sentiment(praised, rules), rules).first()
    assert row.sentiment_evidence.endswith("rating>=1") and "rating<=" not in row.sentiment_evidence
    assert row.sentiment_points == sentiment.score_sentiment(praised.drop("rating"), rules).first().sentiment_points + 250
