"""Every registered query against its SQL, and what must hold of the results."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from voxtally.operators import clean, kpis, quant, sentiment, themes
from voxtally.plans import duckdb_sql
from voxtally.plans.queries import QUERIES
from voxtally.plans.review_view import standardized_reviews
from voxtally.plans.stages import SUMMARIES, run, scored_reviews
from voxtally.rules import DEFAULT_RULES
from voxtally.streaming import annotate_stream

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scored"))
    scored_reviews(standardized_reviews(spark, SF_DIR)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_every_query_has_sql():
    assert QUERIES.keys() == duckdb_sql.build().keys()
    assert QUERIES.keys() <= contract.queries().keys() and contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    found = contract.queries()[name](spark, SF_DIR)
    result = sql.execute(contract.oracle_sql()[name])
    columns = {c[0]: str(c[1]) for c in result.description}
    assert {n: TYPES[t] for n, t in found.dtypes} == columns
    order = sorted(columns)
    expected = [tuple(dict(zip(columns, row))[c] for c in order) for row in result.fetchall()]
    assert sorted([tuple(r[c] for c in order) for r in found.collect()], key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    assert contract.entry(spark).count() == len(DEFAULT_RULES.themes)


def test_invariants(spark, scored):
    total = scored.count()
    counts = clean.quality_counts(standardized_reviews(spark, SF_DIR)).first()
    assert counts.rows_before == (counts.empty_reviews_removed + counts.short_reviews_removed
                                  + counts.duplicate_reviews_removed + counts.rows_after)
    assert counts.rows_after == total == scored.select("clean_text").distinct().count()
    indicators = sum((F.col(t.indicator) for t in DEFAULT_RULES.themes), F.lit(0))
    assert scored.where(indicators != F.size("themes")).count() == 0
    by_theme = {r.theme: r["count"] for r in themes.theme_summary(scored).collect()}
    assert sum(by_theme.values()) == scored.agg(F.sum("theme_count")).first()[0]
    for r in sentiment.sentiment_by_theme(scored).collect():
        assert r.negative_count + r.neutral_count + r.positive_count == r.review_count == by_theme[r.theme]
    for table in (quant.theme_vs_sentiment, quant.theme_vs_airline, quant.theme_vs_recommendation):
        sums = {r.theme: r.n for r in table(scored).groupBy("theme").agg(F.sum("count").alias("n")).collect()}
        assert sums == {t: n for t, n in by_theme.items() if n}
    pairs = quant.pain_point_pairs(scored).collect()
    assert all(p["count"] <= min(by_theme[p.theme_a], by_theme[p.theme_b]) for p in pairs)
    assert {(p.theme_a, p.theme_b) for p in pairs if p.is_focus_combination} == set(DEFAULT_RULES.focus_pairs)
    assert sum(r["count"] for r in quant.rating_distribution(scored).collect()) == scored.where("rating IS NOT NULL").count()
    assert sum(r["count"] for r in sentiment.sentiment_summary(scored).collect()) == total
    quotes = themes.theme_quotes(scored).collect()
    assert all(len(r.quote_excerpt) <= 280 and 1 <= r.quote_rank <= 3 for r in quotes)
    assert len({(r.theme, r.quote_excerpt) for r in quotes}) == len(quotes)
    assert all(len(r.excerpt) <= 190 for r in kpis.lead_quotes(scored).collect())


def test_results_do_not_depend_on_partitioning(spark, scored):
    mixed = standardized_reviews(spark, SF_DIR).repartition(13, F.rand(1))
    columns = [c for c in scored.columns if c not in ("known_words", "pattern_hits", "theme_matches", "word_hits")]
    again = scored_reviews(mixed).select(columns)
    assert again.exceptAll(scored.select(columns)).count() == scored.select(columns).exceptAll(again).count() == 0
    shuffled = scored.repartition(7, F.rand(2))
    for build in (themes.theme_quotes, kpis.headline_lists, quant.pain_point_pairs, sentiment.sentiment_by_theme):
        assert build(shuffled).collect() == build(scored).collect()


def test_full_run(spark, tmp_path):
    out = str(tmp_path)
    scored = run(standardized_reviews(spark, SF_DIR), out, summaries=["theme_summary", "theme_example_quotes", "lead_quotes"])
    assert spark.read.parquet(f"{out}/theme_summary").count() == 12
    assert spark.read.parquet(f"{out}/quality_counts").first().rows_after == scored.count()
    assert set(os.listdir(out)) == {"scored_reviews", "quality_counts", "theme_summary", "theme_example_quotes", "lead_quotes"}


@pytest.mark.parametrize("name", sorted(SUMMARIES))
def test_every_summary_can_be_written_as_csv(scored, tmp_path, name):
    SUMMARIES[name](scored, DEFAULT_RULES).write.csv(str(tmp_path / name), header=True)


def test_annotation_of_a_stream(spark, scored, tmp_path):
    path = str(tmp_path / "in")
    standardized = standardized_reviews(spark, SF_DIR)
    standardized.write.parquet(path)
    stream = spark.readStream.schema(standardized.schema).parquet(path)
    query = (annotate_stream(stream).select("source_row", "themes", "sentiment_points").writeStream.format("memory")
             .queryName("annotated").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    streamed = spark.table("annotated")
    kept = scored.select("source_row", "themes", "sentiment_points")
    assert kept.exceptAll(streamed).count() == 0 and streamed.count() >= kept.count()
    with pytest.raises(ValueError, match="streaming"):
        annotate_stream(standardized)
