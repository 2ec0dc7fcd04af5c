from datetime import date

import pytest
from pyspark.sql import functions as F

from voxtally.sources.dates import date_profile, settle_dates
from voxtally.sources.ingest import standardize
from voxtally.sources.registry import Dataset


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, `when said` string").repartition(3)


def settled(spark, values):
    return [r.d for r in settle_dates(frame(spark, values), "when said", "d").orderBy("i").collect()]


@pytest.mark.parametrize("text, want", [
    ("2024-03-05", date(2024, 3, 5)), (" 2024/3/5 ", date(2024, 3, 5)), ("2024.03.05", date(2024, 3, 5)), ("20240305", date(2024, 3, 5)),
    ("2024-03-05T10:11:12Z", date(2024, 3, 5)), ("2024-03-05 10:11", date(2024, 3, 5)), ("5 March 2024", date(2024, 3, 5)),
    ("5th Mar. 2024", date(2024, 3, 5)), ("March 5, 2024", date(2024, 3, 5)), ("sept 1st, 2023", date(2023, 9, 1)), ("1-May-2023", date(2023, 5, 1)),
    ("2nd of June 2020", date(2020, 6, 2)), ("2024-02-30", None), ("2024-13-01", None), ("March 2024", None), ("5", None), ("", None), (None, None), ("nan", None),
    ("yesterday", None), ("12345678", None), ("0000-01-01", None),
])
def test_forms(spark, text, want):
    assert settled(spark, [text]) == [want]


def test_day_and_month_are_settled_by_the_column(spark):
    assert settled(spark, ["03/04/2024", "25/12/2023", "n/a"]) == [date(2024, 4, 3), date(2023, 12, 25), None]
    assert settled(spark, ["03/04/2024", "12/25/2023"]) == [date(2024, 3, 4), date(2023, 12, 25)]
    # even votes: the month is first, and what cannot be read so is null
    assert settled(spark, ["03/04/2024", "12/25/2023", "25.12.2023"]) == [date(2024, 3, 4), date(2023, 12, 25), None]


def test_profile_counts_forms_and_unread_values(spark):
    values = ["2024-01-01", "01/02/2024", "13/02/2024", "02/13/2024", "14-02-2024", "someday", "", None, "May 1, 2020", "30/30/2020"]
    row = date_profile(frame(spark, values), "when said").first().asDict()
    assert row == dict(dated=8, year_first=1, compact=0, year_last=4, day_month_name=0, month_name_day=1, unread=2, day_votes=2, month_votes=1)
    by = date_profile(frame(spark, values).withColumn("g", F.expr("i % 2")), "when said", by=["g"])
    assert sum(r.dated for r in by.collect()) == 8
    assert date_profile(frame(spark, values).where("false"), "when said").first().dated == 0


def test_standardize_settles_dates_in_its_own_plan(spark):
    raw = spark.createDataFrame([("31/01/2024", "late bag"), ("02/01/2024", "late crew")], "said string, body string")
    out = standardize(raw, Dataset("k", "K", {"review_date": "said", "review_text": "body"}))
    assert sorted(r.review_date for r in out.collect()) == ["2024-01-02", "2024-01-31"]
