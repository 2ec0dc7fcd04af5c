"""Dictionary matching on normalized text.

Normalized text holds only ``a-z0-9`` words and single blanks, so "whole word"
is the same as "with a blank on either side".  A phrase is looked for only
where its longest word occurs at all: one hash set per text answers that for
the whole dictionary, and the text is scanned for very few phrases.

``text`` and ``known`` are SQL expressions, usually column names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtally.functions.literals import sql_array, sql_let, sql_string
from voxtally.rules import Lexicon, RuleSet, Theme

PATTERN_HITS = "array<struct<theme:string,match:string>>"
WORD_HITS = "array<struct<word:string,negated:boolean>>"
#: Column metadata: fingerprint of the dictionaries that made the matches.
MADE_BY = "made_by_rules"


def anchor_of(phrase: str) -> str:
    """The word of a phrase that is looked up first: its longest."""
    return max(phrase.split(), key=len)


def vocabulary(phrases: Sequence[str], words: Sequence[str] = ()) -> list[str]:
    """Words that have to be known about a text to match these phrases."""
    return list(dict.fromkeys([*map(anchor_of, phrases), *words]))


def made_by(df: DataFrame, column: str, fingerprint: str) -> bool:
    """Whether ``df`` has a column of matches that says it was made with these dictionaries."""
    return column in df.columns and df.schema[column].metadata.get(MADE_BY) == fingerprint


def marked(matches: Column, column: str, fingerprint: str) -> Column:
    """Matches that say what made them, also through a written Parquet table."""
    return matches.alias(column, metadata={MADE_BY: fingerprint})


def matched_by(df: DataFrame, rules: RuleSet) -> bool:
    """Whether ``df`` has phrase matches that ``rules`` can use: made with the same dictionaries, or the caller's own.

    Matches are the caller's own when the column does not say what made it.
    """
    return "phrase_hits" in df.columns and df.schema["phrase_hits"].metadata.get(MADE_BY) in (None, rules.fingerprint())


def known_words(text: str, vocab: Sequence[str]) -> Column:
    """The words of ``vocab`` that occur in normalized ``text``."""
    return F.expr(f"array_intersect(split({text}, ' '), {sql_array(vocab)})")


def phrase_hits(text: str, known: str, phrases: Sequence[str]) -> Column:
    """Phrases that occur in normalized ``text``, each once, in no particular order.

    Starts from the words found, so the work per text follows what it contains
    and hardly the size of the dictionary.
    """
    by_anchor: dict[str, list[str]] = {}
    for phrase in dict.fromkeys(phrases):
        by_anchor.setdefault(anchor_of(phrase), []).append(phrase)
    if not by_anchor:
        return F.expr(sql_array([]))
    entries = ", ".join(f"{sql_string(anchor)}, {sql_array(owned)}" for anchor, owned in by_anchor.items())
    candidates = f"transform(v.words, word -> coalesce(try_element_at(map({entries}), word), {sql_array([])}))"
    search = f"filter(flatten({candidates}), phrase -> contains(v.padded, concat(' ', phrase, ' ')))"
    # texts without any dictionary word skip the rest
    return F.expr(f"""CASE WHEN size({known}) = 0 THEN {sql_array([])}
        ELSE {sql_let({'words': known, 'padded': f"concat(' ', {text}, ' ')"}, search)} END""")


def pattern_hits(text: str, known: str, themes: Sequence[Theme]) -> Column:
    """``(theme, match)`` for each regular expression found in ``text``; null for a null text.

    The expressions are literals, so each is compiled once per task, and those
    with an anchor run only on texts in which the anchor occurs.
    """
    found = []
    for theme in themes:
        for pattern in theme.patterns:
            gate = f"array_contains({known}, {sql_string(pattern.anchor)}) AND " if pattern.anchor else ""
            found.append(f"CASE WHEN {gate}rlike({text}, {sql_string(pattern.regex)}) THEN named_struct("
                         f"'theme', {sql_string(theme.label)}, 'match', {sql_string('regex:' + pattern.regex)}) END")
    hits = f"filter(array({', '.join(found)}), hit -> hit IS NOT NULL)" if found else f"cast(array() as {PATTERN_HITS})"
    return F.expr(f"IF({text} IS NULL, NULL, {hits})")


def word_hits(text: str, known: str, lexicon: Lexicon) -> Column:
    """``(word, negated)`` for every occurrence of a lexicon word, in text order.

    A word is negated when one of the two words before it is a negation.
    """
    negations = sql_array(lexicon.negations)
    negated = " OR ".join(
        f"coalesce(array_contains({negations}, get(v.tokens, i - {step})), false)" for step in (1, 2))
    scan = f"""filter(transform(v.tokens, (token, i) -> CASE WHEN array_contains(v.present, token)
        THEN named_struct('word', token, 'negated', {negated}) END), hit -> hit IS NOT NULL)"""
    present = f"array_intersect({sql_array(list(lexicon.word_weights))}, {known})"
    # the text is split only when it holds a lexicon word
    return F.expr(f"""CASE WHEN arrays_overlap({sql_array(list(lexicon.word_weights))}, {known})
        THEN {sql_let({'present': present, 'tokens': f"split({text}, ' ')"}, scan)}
        ELSE cast(array() as {WORD_HITS}) END""")
