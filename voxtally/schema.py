"""Column names and types shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Ingestion order decides which of several equal reviews is "the first":
# sources in the order given, then the position inside the source.
INGEST_ORDER = ("source_rank", "source_row")

REVIEW_SCHEMA = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("airline", T.StringType()),
    T.StructField("review_date", T.StringType()),
    T.StructField("review_title", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("traveler_type", T.StringType()),
    T.StructField("route", T.StringType()),
    T.StructField("seat_type", T.StringType()),
    T.StructField("recommended", T.BooleanType()),
    T.StructField("disruption_type", T.StringType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("is_synthetic", T.BooleanType()),
])
REVIEW_COLUMNS = REVIEW_SCHEMA.fieldNames()
# ``feedback_text`` repeats ``review_text`` until cleaning replaces it by the analysis text.
STANDARD_COLUMNS = [*REVIEW_COLUMNS, "feedback_text"]
