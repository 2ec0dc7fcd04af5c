"""Dictionaries as tables against literal matching and regular expressions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from voxtally.operators import dictionary, quant
from voxtally.operators.clean import derived_fields
from voxtally.operators.sentiment import score_sentiment
from voxtally.operators.themes import code_themes, match_text
from voxtally.rules import DEFAULT_RULES as RULES
from voxtally.rules import RuleSet

from test_match import frame, random_texts


def test_table_hits_equal_literal_hits(spark):
    df = frame(spark, random_texts(400, 11))
    literal = match_text(df)
    table = match_text(df, key=["i"])
    want = {r.i: sorted(r.phrase_hits) for r in literal.collect()}
    assert {r.i: sorted(r.phrase_hits) for r in table.collect()} == want and any(want.values())
    assert literal.schema["phrase_hits"].metadata == table.schema["phrase_hits"].metadata
    fields = {"rating": F.expr("CASE i % 3 WHEN 0 THEN 1D WHEN 1 THEN 5D END"), "recommended": F.lit(True), "disruption_type": F.lit("refund")}

    def scored(made):
        made = score_sentiment(code_themes(derived_fields(made.withColumns(fields))))
        return made.select("i", "themes", "sentiment_points", "disruption_keywords").orderBy("i").collect()

    assert scored(literal) == scored(table)


@pytest.mark.parametrize("bits", [64, 1 << 12])
def test_counts_of_ten_thousand_terms(spark, bits):
    pick = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    terms = {" ".join(pick.choice(words) for _ in range(pick.randint(1, 4))) for _ in range(14_000)}
    assert len(terms) > 10_000
    texts = [" ".join(pick.choice(words) for _ in range(pick.randint(0, 60))) for _ in range(60)] + ["", None, "w1", "w1 w1 w1"]
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, clean_text string")
    want = {}
    for text in texts:
        ws = (text or "").split()
        for run in {" ".join(ws[a:b]) for a in range(len(ws)) for b in range(a + 1, a + 5) if b <= len(ws)} & terms:
            want[run] = want.get(run, 0) + 1
    assert {r.term: r["count"] for r in dictionary.document_counts(df, table, ["i"], bits=bits).collect()} == want
    hits = dictionary.phrase_hits_by_table(df, table, ["i"], bits=bits)
    assert sum(len(r.phrase_hits) for r in hits.collect()) == sum(want.values())


def test_themes_points_and_keywords_by_table(spark):
    texts = random_texts(300, 5)
    df = frame(spark, texts)
    bounded = {p: re.compile(r"\b" + p + r"\b") for p in RULES.all_phrases()}
    themes = {r.i: r.themes for r in dictionary.code_by_table(df, dictionary.theme_terms(spark, RULES), ["i"]).collect()}
    points = {r.i: r.points for r in dictionary.points_by_table(df, dictionary.lexicon_table(spark, RULES), ["i"]).collect()}
    keywords = {r.i: r.keywords for r in dictionary.keywords_by_table(df, dictionary.keyword_table(spark, RULES), ["i"]).collect()}
    for i, text in enumerate(texts):
        found = {p for p, test in bounded.items() if test.search(text)}
        assert themes.get(i, []) == [t.label for t in RULES.themes if found & set(t.phrases) and not found & set(t.suppressed_by)]
        assert points.get(i, 0) == sum(round(100 * w) for p, w in RULES.lexicon.phrase_weights.items() if p in found)
        assert keywords.get(i, []) == [k for k in RULES.disruption_keywords if k in found]


def test_terms_are_normalized_and_may_be_none(spark):
    given = spark.createDataFrame([(" Long  WAIT!", 1), ("...", 2), (None, 3)], "phrase string, weight int")
    terms = dictionary.terms_table(given, "phrase")
    assert [tuple(r) for r in terms.collect()] == [("long wait", 1)]
    df = frame(spark, ["a long wait", "", "waiting long"])
    assert [r.i for r in dictionary.term_hits(df, terms, ["i"]).collect()] == [0]
    nothing = terms.where("false")
    assert dictionary.term_hits(df, nothing, ["i"]).count() == 0 == dictionary.document_counts(df.where("false"), terms, ["i"]).count()


def test_seeded_phrases_from_a_table(spark):
    df = spark.createDataFrame([("delay at gate", "negative"), ("delay again", "negative"), ("delay", "positive")], "clean_text string, sentiment_label string")
    terms = spark.createDataFrame([("delay",), ("at gate",), ("none",)], "term string")
    got = quant.seeded_phrases(df, terms=terms).collect()
    assert [(r.term, r["count"], r.share_of_negative_reviews_pct) for r in got] == [("delay", 2, 100.0), ("at gate", 1, 50.0)]


def test_plan_holds_no_phrases(spark):
    phrases = [f"term{i} tail{i}" for i in range(300)]
    rules = RuleSet(themes=(), lexicon=RULES.lexicon, negative_terms=tuple(phrases))
    plan = match_text(frame(spark, ["x"]), rules, key=["i"])._jdf.queryExecution().optimizedPlan().toString()
    assert "term299" not in plan


def test_runs_grow_only_where_a_term_goes_on(spark):
    df = spark.createDataFrame([(1, "a b c d a b c"), (2, "b c d"), (3, "a b c d e"), (4, "a"), (5, ""), (6, None)], "i int, clean_text string")
    terms = spark.createDataFrame([("a b c d",), ("d",), ("c d e f",)], "term string")
    runs = dictionary.word_runs(df, terms, ["i"])
    assert sorted((r.i, r.term) for r in runs.collect()) == [(1, "a b c d"), (1, "d"), (2, "d"), (3, "a b c d"), (3, "d")]
    # found once for each text, and not a second time by a filter that asks whether there are any
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "lambda" in line]
