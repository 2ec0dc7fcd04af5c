"""Customer-feedback analytics as Spark jobs.

Standardize and clean reviews, code themes, score sentiment and summarize, all
as lazy ``DataFrame`` to ``DataFrame`` functions over built-in expressions.
"""

from voxtally.operators.clean import clean, keep_first, prepare, quality_counts
from voxtally.operators.sentiment import score_sentiment
from voxtally.operators.themes import code_themes
from voxtally.plans.stages import annotate, run, scored_reviews
from voxtally.rules import DEFAULT_RULES, Lexicon, Pattern, RuleSet, Theme

__all__ = ["DEFAULT_RULES", "Lexicon", "Pattern", "RuleSet", "Theme", "annotate", "clean", "code_themes", "keep_first",
           "prepare", "quality_counts", "run", "score_sentiment", "scored_reviews"]
