import random
import re

from pyspark.sql import functions as F

from voxtally.functions import match
from voxtally.functions.text import with_exprs
from voxtally.operators.sentiment import add_sentiment_evidence, score_sentiment
from voxtally.operators.themes import add_evidence, add_indicators, code_themes
from voxtally.rules import DEFAULT_RULES as RULES
from voxtally.rules import Lexicon, Pattern, RuleSet, Theme


def bounded(phrase):
    return re.compile(r"\b" + phrase.replace(" ", r"\s+") + r"\b")


def random_texts(n, seed):
    """Normalized texts made of dictionary fragments, so that matches and near misses are frequent."""
    rng = random.Random(seed)
    pieces = [*RULES.all_phrases(), *RULES.lexicon.word_weights, *RULES.lexicon.negations, "app", "kept", "refreshing",
              "12", "minutes", "in line", "waited", "agent", "rebooked", "staff", "failed", "hours late", "days later",
              "arrived", "flight was", "money back", "the", "delays", "gates", "never fly again", "won t book again"]
    return [" ".join(rng.choice(pieces) for _ in range(rng.randrange(0, 14))) for _ in range(n)]


def expected_themes(text):
    found = {}
    for theme in RULES.themes:
        if any(bounded(p).search(text) for p in theme.suppressed_by):
            continue
        hits = [p for p in theme.phrases if bounded(p).search(text)]
        hits += ["regex:" + p.regex for p in theme.patterns if re.search(p.regex, text)]
        if hits:
            found[theme.label] = sorted(set(hits))
    return found


def frame(spark, texts, **columns):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, clean_text string").repartition(8)
    return with_exprs(df, columns) if columns else df


def by_index(df):
    return sorted(df.collect(), key=lambda r: r.i)


def test_phrase_hits_equal_regular_expressions(spark):
    texts, phrases = random_texts(600, 1), RULES.all_phrases()
    df = frame(spark, texts).withColumn("known", match.known_words("clean_text", match.vocabulary(phrases)))
    for row in by_index(df.withColumn("hits", match.phrase_hits("clean_text", "known", phrases))):
        assert sorted(row.hits) == sorted(p for p in phrases if bounded(p).search(row.clean_text))


def test_pattern_anchors_never_hide_a_match(spark):
    texts = random_texts(1500, 2)
    bare = [Theme(t.label, patterns=tuple(Pattern(p.regex) for p in t.patterns)) for t in RULES.themes]
    df = frame(spark, texts).withColumn("known", match.known_words("clean_text", RULES.anchor_words()))
    df = df.select("i", match.pattern_hits("clean_text", "known", RULES.themes).alias("gated"),
                   match.pattern_hits("clean_text", "known", bare).alias("free"))
    rows = by_index(df)
    assert all(r.gated == r.free for r in rows)
    assert sum(len(r.free) for r in rows) > 100


def test_every_pattern_can_match_under_its_anchor():
    samples = {"late": "2 hours late", "gate": "waiting in the gate", "flight": "flight was cancelled",
               "steps": "no clear next steps", "money": "took 3 days to get the money back", "process": "refund process",
               "line": "waited 40 minutes in line", "removing": "app kept removing the seat",
               "itinerary": "app showed one itinerary", "script": "gate staff had no consistent script",
               "arrive": "bag did not arrive", "later": "arrived 2 days later", "agent": "agent kindly helped",
               "staff": "staff sorted", "hold": "5 minutes on hold", "twice": "disconnected me twice",
               "hotel": "paid for my own hotel", "policy": "voucher policy was confusing", "app": "app crashed",
               "kiosk": "kiosk could not", "within": "within 5 minutes the desk agent rebooked me",
               "recovery": "recovery was well handled"}
    for theme in RULES.themes:
        for p in theme.patterns:
            options = [samples.get(p.anchor), "app kept refreshing", "never fly again", "won t book again",
                       "gate team had no consistent script"]
            assert any(o and re.search(p.regex, o) and p.anchor in o.split() for o in options), p


def test_themes_and_evidence(spark):
    texts = random_texts(800, 3) + ["delays and vouchers", "clear updates", "not helpful but kind", ""]
    df = add_indicators(add_evidence(code_themes(frame(spark, texts))))
    for row in by_index(df):
        expected = expected_themes(row.clean_text)
        assert row.themes == list(expected)
        assert row.theme_count == len(expected)
        assert row.primary_theme == next(iter(expected), "unclassified")
        assert {m.theme: m.matches for m in row.theme_matches} == expected
        assert row.theme_evidence == " | ".join(f"{t}: {', '.join(m)}" for t, m in expected.items())
        assert [row[t.indicator] for t in RULES.themes] == [int(t.label in expected) for t in RULES.themes]


def test_suppression_and_exact_words(spark):
    texts = ["clear updates from the crew", "good communication but conflicting information", "delays and vouchers",
             "crew were not helpful yet kind"]
    rows = by_index(code_themes(frame(spark, texts)))
    assert [r.themes for r in rows] == [["successful recovery experience"], [], [], []]


def expected_score(row):
    lexicon, tokens, points, evidence = RULES.lexicon, row.clean_text.split(), 0, []
    for table in (lexicon.positive_phrases, lexicon.negative_phrases):
        for phrase, weight in table.items():
            if bounded(phrase).search(row.clean_text):
                points += round(weight * 100)
                evidence.append(phrase)
    for table in (lexicon.positive_words, lexicon.negative_words):
        for i, token in enumerate(tokens):
            if token in table:
                flipped = bool(set(tokens[max(0, i - 2):i]) & set(lexicon.negations))
                points += round(table[token] * 100) * (-1 if flipped else 1)
                evidence.append("negated:" * flipped + token)
    for test, value, name in (
            (row.rating is not None and row.rating <= 2, -120, "rating<=2"),
            (row.rating is not None and row.rating >= 4, 80, "rating>=4"),
            (row.recommended is True, 60, "recommended_true"), (row.recommended is False, -80, "recommended_false"),
            (row.likely_negative_experience is True, -60, "likely_negative_experience")):
        if test:
            points += value
            evidence.append(name)
    return points, list(dict.fromkeys(evidence))


def test_sentiment(spark):
    texts = random_texts(800, 4) + ["helpful", "not helpful", "no delay at all", "never a very long delay", ""]
    df = frame(spark, texts, rating="IF(i % 4 = 0, NULL, double(i % 5))",
               recommended="CASE i % 3 WHEN 0 THEN true WHEN 1 THEN false END",
               likely_negative_experience="i % 7 = 0")
    for row in by_index(add_sentiment_evidence(score_sentiment(df))):
        points, evidence = expected_score(row)
        assert row.sentiment_score == points / 100, row
        assert row.sentiment_label == ("positive" if points >= 100 else "negative" if points <= -100 else "neutral")
        assert row.sentiment_evidence == "; ".join(evidence)


def test_thresholds_are_inclusive(spark):
    rules = RuleSet(themes=(), lexicon=Lexicon(positive_words={"good": 0.1}, negative_words={"bad": -0.1}))
    texts = [" ".join(["good"] * 10), " ".join(["good"] * 9), " ".join(["bad"] * 10), " ".join(["bad"] * 9)]
    rows = by_index(score_sentiment(frame(spark, texts), rules))
    assert [(r.sentiment_score, r.sentiment_label) for r in rows] == [
        (1.0, "positive"), (0.9, "neutral"), (-1.0, "negative"), (-0.9, "neutral")]


def test_other_text_columns_stand_in_for_a_missing_one(spark):
    df = spark.createDataFrame([(0, None, "A Terrible-Delay", "x"), (1, None, None, "awful")],
                               "i int, clean_text string, analysis_text string, feedback_text string")
    rows = by_index(code_themes(score_sentiment(df)))
    assert [r.sentiment_score for r in rows] == [-4.0, -2.0]
    assert [r.themes for r in rows] == [[], []]


def test_caller_rules_with_awkward_characters(spark):
    rules = RuleSet(themes=(Theme("it's \\ odd", "d'esc", ("lost cat",), (Pattern(r"\bcat(?:'s)?\b"), Pattern(r"ca\w"))),),
                    lexicon=Lexicon())
    row = by_index(add_evidence(code_themes(frame(spark, ["the lost cat"]), rules), rules))[0]
    assert row.theme_evidence == r"it's \ odd: lost cat, regex:\bcat(?:'s)?\b, regex:ca\w"
    assert code_themes(frame(spark, ["x"]), rules).agg(F.sum("theme_count")).first()[0] == 0
