"""Row-level operators on a stream.

The engine has no streaming operators of its own.  Cleaning and annotation look
at one review at a time, so they apply to a streaming DataFrame as they are;
deduplication and summaries belong to the tables such a stream is written to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from voxtally.operators.clean import prepare
from voxtally.plans.stages import annotate
from voxtally.rules import DEFAULT_RULES, RuleSet


def annotate_stream(standardized: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Prepared and annotated reviews from a stream of standardized ones."""
    if not standardized.isStreaming:
        raise ValueError("annotate_stream takes a streaming DataFrame; use scored_reviews for tables")
    return annotate(prepare(standardized, rules), rules)
