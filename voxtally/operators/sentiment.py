"""Lexicon sentiment with negation and structured signals.

Scores are whole hundredths until the last step: sums are then exact, do not
depend on their order, and meet the label thresholds exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.functions import match, text
from voxtally.functions.literals import sql_array, sql_string
from voxtally.functions.text import aliased, with_exprs
from voxtally.operators.themes import match_text, per_theme, text_to_match
from voxtally.rules import DEFAULT_RULES, RuleSet

POSITIVE_FROM, NEGATIVE_FROM = 100, -100
LABELS = ("negative", "neutral", "positive")


def _weight(table: dict[str, float], term: str) -> str:
    """SQL for the hundredths a term counts, 0 for terms outside the table."""
    if not table:
        return "0"
    entries = ", ".join(f"{sql_string(word)}, {round(weight * 100)}" for word, weight in table.items())
    return f"coalesce(try_element_at(map({entries}), {term}), 0)"


def _signals(df: DataFrame, rules: RuleSet) -> list[tuple[str, int, str]]:
    """Condition, points and evidence name for each signal outside the text."""
    s = rules.signals
    flag = {c: c if df.schema[c].dataType.typeName() == "boolean" else text.parse_flag(c)
            for c in ("recommended", "likely_negative_experience") if c in df.columns}
    recommended, negative = flag.get("recommended"), flag.get("likely_negative_experience")
    conditions = [
        ("rating", f"rating <= {s.low_rating}", s.low_points, f"rating<={s.low_rating:g}"),
        ("rating", f"rating >= {s.high_rating}", s.high_points, f"rating>={s.high_rating:g}"),
        ("recommended", f"({recommended})", s.recommended, "recommended_true"),
        ("recommended", f"NOT ({recommended})", s.not_recommended, "recommended_false"),
        ("likely_negative_experience", f"({negative})", s.likely_negative, "likely_negative_experience"),
    ]
    return [(condition, round(100 * points), name) for column, condition, points, name in conditions if column in df.columns]


def score_sentiment(df: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Adds ``sentiment_points`` (hundredths), ``sentiment_score`` and ``sentiment_label``.

    A phrase counts once per review, a word at every occurrence; a word's sign
    flips when one of the two words before it is a negation.
    """
    if not match.matched_by(df, rules):
        df = match_text(df, rules)
    phrase = _weight(rules.lexicon.phrase_weights, "phrase")
    word = _weight(rules.lexicon.word_weights, "hit.word")
    points = " + ".join([
        f"aggregate(phrase_hits, 0, (total, phrase) -> total + {phrase})",
        f"aggregate(word_hits, 0, (total, hit) -> total + IF(hit.negated, -1, 1) * {word})",
        *[f"CASE WHEN {condition} THEN {points} ELSE 0 END" for condition, points, _ in _signals(df, rules)],
    ])
    if not match.made_by(df, "word_hits", rules.word_fingerprint()):
        found = match.word_hits(text_to_match(df), "known_words", rules.lexicon)
        df = df.withColumn("word_hits", match.marked(found, "word_hits", rules.word_fingerprint()))
    return with_exprs(df.withColumn("sentiment_points", F.expr(points)), {
        "sentiment_score": "sentiment_points / 100D",
        "sentiment_label": f"""CASE WHEN sentiment_points >= {POSITIVE_FROM} THEN 'positive'
            WHEN sentiment_points <= {NEGATIVE_FROM} THEN 'negative' ELSE 'neutral' END""",
    })


def add_sentiment_evidence(scored: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Adds ``sentiment_evidence``: what moved the score, each once, in a fixed order of groups."""
    lexicon = rules.lexicon

    def phrases(table: dict[str, float]) -> str:
        return f"array_intersect({sql_array(list(table))}, phrase_hits)"

    def words(table: dict[str, float]) -> str:
        own = f"filter(word_hits, hit -> array_contains({sql_array(list(table))}, hit.word))"
        return f"transform({own}, hit -> concat(IF(hit.negated, 'negated:', ''), hit.word))"

    names = [f"CASE WHEN {condition} THEN {sql_string(name)} END" for condition, _, name in _signals(scored, rules)]
    signals = f"filter(cast(array({', '.join(names)}) AS array<string>), name -> name IS NOT NULL)"
    groups = [phrases(lexicon.positive_phrases), phrases(lexicon.negative_phrases), words(lexicon.positive_words),
              words(lexicon.negative_words), signals]
    return scored.withColumn("sentiment_evidence", F.expr(f"array_join(array_distinct(concat({', '.join(groups)})), '; ')"))


def sentiment_summary(scored: DataFrame) -> DataFrame:
    """Count, mean score and share of all reviews per label."""
    grouped = scored.groupBy(F.col("sentiment_label").alias("sentiment")).agg(*aliased({
        "count": "count(1)", "avg_sentiment_score": "bround(avg(sentiment_points) / 100D, 2)"}))
    return label_rows(grouped)


def label_rows(grouped: DataFrame) -> DataFrame:
    """:func:`sentiment_summary` from a row per label with ``count`` and ``avg_sentiment_score``."""
    # three rows at most
    share = F.expr(text.share_pct("count", "sum(count) OVER ()"))
    return grouped.withColumn("share_of_reviews_pct", share).orderBy("sentiment")


def sentiment_by_theme(scored: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Sentiment mix per theme, most negative first; unused themes come with zeros and nulls."""
    counts = {f"{label}_count": f"count_if(sentiment_label = '{label}')" for label in LABELS}
    return by_theme_rows(per_theme(scored.select("themes", "sentiment_label", "sentiment_points"),
                                   {"mean": "avg(sentiment_points) / 100D", **counts}, rules))


def by_theme_rows(table: DataFrame) -> DataFrame:
    """:func:`sentiment_by_theme` from a row per theme with ``reviews``, ``mean`` score and a count for each label."""
    counts = [f"{label}_count" for label in LABELS]
    table = with_exprs(table, {name: f"coalesce({name}, 0L)" for name in counts})
    # ties go to the label that comes first in the alphabet
    return table.selectExpr(
        "theme", "reviews AS review_count", "bround(mean, 2) AS avg_sentiment_score", *counts,
        f"{text.share_pct('negative_count', 'reviews')} AS negative_share_pct",
        """CASE WHEN reviews = 0 THEN NULL
                WHEN negative_count >= neutral_count AND negative_count >= positive_count THEN 'negative'
                WHEN neutral_count >= positive_count THEN 'neutral' ELSE 'positive' END AS most_common_sentiment""",
    ).orderBy(F.desc("negative_share_pct"), F.asc_nulls_last("avg_sentiment_score"), F.desc("review_count"), "theme")
