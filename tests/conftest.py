import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of a SQL expression over one text column ``x``, in input order."""
    def run(expression, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", F.expr(expression).alias("y"))
        return [r.y for r in sorted(df.collect(), key=lambda r: r.i)]
    return run


REVIEW = dict(
    review_id="r", source="s", airline="delta", review_date="2024-05-01", review_title=None, review_text="", rating=None,
    traveler_type=None, route=None, seat_type=None, recommended=None, disruption_type=None, raw_text=None,
    is_synthetic=False, feedback_text=None, source_rank=0, source_row=0)
REVIEW_DDL = ("review_id string, source string, airline string, review_date string, review_title string, "
              "review_text string, rating double, traveler_type string, route string, seat_type string, "
              "recommended string, disruption_type string, raw_text string, is_synthetic boolean, feedback_text string, "
              "source_rank int, source_row long")


@pytest.fixture(scope="session")
def reviews(spark):
    """Standardized reviews from the fields that matter to a test."""
    def make(*rows):
        full = [{**REVIEW, "review_id": f"r{i}", "source_row": i, **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[c.split()[0]] for c in REVIEW_DDL.split(", ")) for r in full], REVIEW_DDL)
    return make
