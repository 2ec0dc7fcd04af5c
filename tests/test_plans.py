"""What moves between tasks, with broadcasting off."""

import os
import re

import pytest

from voxtally.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TEXTS = ("text", "review_text", "clean_text", "analysis_text", "raw_text", "feedback_text", "review_title")


@pytest.fixture(scope="module")
def plan(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def formatted(name):
        return spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(QUERIES[name](spark, SF_DIR)._jdf.queryExecution(), "formatted")
    yield formatted
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(plan, key):
    """Columns that each exchange by ``key`` takes in."""
    found = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\((\w+)#", plan)
    return [set(re.findall(r"(\w+)#", columns)) for columns, by in found if by == key]


@pytest.mark.parametrize("name", ["sentiment_scores", "sentiment_by_theme", "negative_phrases", "corpus_kpis", "theme_vs_recommendation"])
def test_no_text_meets_the_labels(plan, name):
    moved = exchanges(plan(name), "doc_id")
    assert moved and all(not columns & set(TEXTS) for columns in moved), moved


@pytest.mark.parametrize("name", ["airline_names", "quality_counts", "review_ids", "disruption_types", "theme_codes", "theme_summary", "theme_quotes", "source_mix"])
def test_labels_are_not_read_for_nothing(plan, name):
    text = plan(name)
    assert "documents.parquet" in text and "labels.parquet" not in text and not exchanges(text, "doc_id")


@pytest.mark.parametrize("name", ["theme_summary", "sentiment_summary"])
def test_duplicates_are_found_without_texts(plan, name):
    moved = exchanges(plan(name), "_text_key")
    assert moved and all(not columns & set(TEXTS) for columns in moved)


def test_terms_are_shuffled_by_bucket_first(plan):
    text = plan("negative_ngrams")
    assert exchanges(text, "bucket") and all(columns <= {"bucket", "count"} for columns in exchanges(text, "bucket"))
