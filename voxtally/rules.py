"""Rule dictionaries as plain data, replaceable by the caller."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field

from voxtally import dictionaries as d

_NORMALIZED = re.compile(r"[a-z0-9]+( [a-z0-9]+)*")


@dataclass(frozen=True)
class Pattern:
    """A regular expression and, optionally, a word any match must contain.

    With an ``anchor`` the expression is tried only on texts holding that word,
    which spares almost every regex evaluation.  Without one it is always tried.
    """

    regex: str
    anchor: str | None = None


@dataclass(frozen=True)
class Theme:
    label: str
    description: str = ""
    phrases: tuple[str, ...] = ()
    patterns: tuple[Pattern, ...] = ()
    suppressed_by: tuple[str, ...] = ()

    @property
    def indicator(self) -> str:
        """Name of the 0/1 column for this theme."""
        return "theme__" + re.sub(r"[^a-z0-9]+", "_", self.label.lower()).strip("_")


@dataclass(frozen=True)
class Lexicon:
    """Signed weights, at most two decimals each so that scores are exact."""

    positive_phrases: dict[str, float] = field(default_factory=dict)
    negative_phrases: dict[str, float] = field(default_factory=dict)
    positive_words: dict[str, float] = field(default_factory=dict)
    negative_words: dict[str, float] = field(default_factory=dict)
    negations: tuple[str, ...] = ()

    def __post_init__(self):
        for weight in [*self.phrase_weights.values(), *self.word_weights.values()]:
            if abs(weight * 100 - round(weight * 100)) > 1e-9:
                raise ValueError(f"lexicon weights take at most two decimals: {weight}")
        for one, other in ((self.positive_phrases, self.negative_phrases), (self.positive_words, self.negative_words)):
            if one.keys() & other.keys():
                raise ValueError(f"terms with two weights: {sorted(one.keys() & other.keys())}")

    @property
    def phrase_weights(self) -> dict[str, float]:
        return {**self.positive_phrases, **self.negative_phrases}

    @property
    def word_weights(self) -> dict[str, float]:
        return {**self.positive_words, **self.negative_words}


@dataclass(frozen=True)
class Signals:
    """Points (at most two decimals) that a review gets for what is said outside its text, and from which ratings on."""

    low_rating: float = 2
    low_points: float = -1.2
    high_rating: float = 4
    high_points: float = 0.8
    recommended: float = 0.6
    not_recommended: float = -0.8
    likely_negative: float = -0.6


@dataclass(frozen=True)
class NegativeExperience:
    """When a review is likely to tell of a negative experience: its rating is low, it does not recommend, or it is of a
    costly disruption type and names so many disruption keywords."""

    rating: float = 2
    costly_types: tuple[str, ...] = ("cancellation", "refund", "customer_support")
    keywords: int = 2


@dataclass(frozen=True)
class RuleSet:
    themes: tuple[Theme, ...]
    lexicon: Lexicon
    pain_points: tuple[str, ...] = ()
    focus_pairs: tuple[tuple[str, str], ...] = ()
    negative_terms: tuple[str, ...] = ()
    disruption_rules: tuple[tuple[str, tuple[str, ...]], ...] = ()
    disruption_labels: dict[str, str] = field(default_factory=dict)
    disruption_keywords: tuple[str, ...] = ()
    airline_names: dict[str, str] = field(default_factory=dict)
    signals: Signals = Signals()
    negative_experience: NegativeExperience = NegativeExperience()

    def __post_init__(self):
        labels = self.theme_labels
        if len(set(labels)) != len(labels):
            raise ValueError("theme labels must be unique")
        unknown = [p for p in (*self.pain_points, *(t for pair in self.focus_pairs for t in pair)) if p not in labels]
        if unknown:
            raise ValueError(f"unknown themes: {unknown}")
        odd = [p for p in self.all_phrases() if not _NORMALIZED.fullmatch(p)]
        if odd:
            raise ValueError(f"phrases must be lower-case words separated by single spaces: {odd}")

    @property
    def theme_labels(self) -> list[str]:
        return [t.label for t in self.themes]

    def ordered_pain_points(self) -> list[str]:
        return [label for label in self.theme_labels if label in self.pain_points]

    def candidate_terms(self, min_length: int = 4) -> list[str]:
        """Phrases counted in negative reviews: the listed terms and every pain point's phrases."""
        terms = set(self.negative_terms)
        for theme in self.themes:
            if theme.label in self.pain_points:
                terms.update(theme.phrases)
        return sorted(t for t in terms if len(t) >= min_length)

    def theme_phrases(self) -> list[str]:
        return _distinct(p for t in self.themes for p in (*t.phrases, *t.suppressed_by))

    def all_phrases(self) -> list[str]:
        """Every phrase any operator looks for, each once."""
        return _distinct([*self.theme_phrases(), *self.lexicon.phrase_weights, *self.disruption_keywords,
                          *self.negative_terms])

    def anchor_words(self) -> list[str]:
        """Single words that gate patterns and word scores."""
        anchors = [p.anchor for t in self.themes for p in t.patterns if p.anchor]
        return _distinct([*anchors, *self.lexicon.word_weights])

    def fingerprint(self) -> str:
        """Equal for rule sets that look up the same words and phrases, in whatever order."""
        return _digest([sorted(self.all_phrases()), sorted(self.anchor_words())])

    def pattern_fingerprint(self) -> str:
        """Equal for rule sets that try the same regular expressions for the same themes."""
        return _digest([[t.label, [[p.regex, p.anchor] for p in t.patterns]] for t in self.themes])

    def word_fingerprint(self) -> str:
        """Equal for rule sets that score the same words and know the same negations."""
        return _digest([sorted(self.lexicon.word_weights), sorted(self.lexicon.negations)])


def _digest(value) -> str:
    return hashlib.sha256(json.dumps(value).encode()).hexdigest()


def _distinct(values) -> list[str]:
    return list(dict.fromkeys(values))


def default_rules() -> RuleSet:
    """The shipped airline dictionaries."""
    themes = tuple(
        Theme(label, spec["description"], tuple(spec["phrases"]),
              tuple(Pattern(regex, anchor) for regex, anchor in spec["patterns"]), tuple(spec["suppressed_by"]))
        for label, spec in d.THEMES.items()
    )
    return RuleSet(
        themes=themes,
        lexicon=Lexicon(d.POSITIVE_PHRASES, d.NEGATIVE_PHRASES, d.POSITIVE_WORDS, d.NEGATIVE_WORDS, tuple(d.NEGATIONS)),
        pain_points=tuple(d.PAIN_POINTS),
        focus_pairs=tuple(d.FOCUS_PAIRS),
        negative_terms=tuple(d.NEGATIVE_TERMS),
        disruption_rules=tuple((label, tuple(words)) for label, words in d.DISRUPTION_RULES),
        disruption_labels=d.DISRUPTION_LABELS,
        disruption_keywords=tuple(_distinct(w for words in d.DISRUPTION_KEYWORDS.values() for w in words)),
        airline_names=d.AIRLINE_NAMES,
    )


DEFAULT_RULES = default_rules()
