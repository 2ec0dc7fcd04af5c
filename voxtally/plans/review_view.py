"""A review table over the driver's documents, so that the dictionaries have something to find.

The documents are invented prose without feedback vocabulary.  Each is preceded
by one of 24 seeded sentences, which are NOT real reviews.  The sentence depends
on the length, so copies of a document stay copies; the structured columns
depend on the id, so copies differ there and keeping the wrong one is visible.
All documents are used, with their whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtally.functions import text
from voxtally.functions.literals import sql_array
from voxtally.functions.text import with_exprs
from voxtally.operators import clean, themes
from voxtally.rules import DEFAULT_RULES, RuleSet
from voxtally.sources.ingest import complete_columns

VIEW_KEY = "documents"

# Fixed values of the view: airline spellings (blanks are part of them) and sentences.
AIRLINES = ["delta", "british-airways", "jetblue", "el_al  israel", "o'hare-shuttle", "UNITED", "", " Air Canada"]
SENTENCES = [
    "Flight delayed 5 hours late and no updates at the gate",
    "My flight was cancelled and I was stranded overnight",
    "The refund request took 21 days and the voucher policy was confusing",
    "Rebooking was painful, waited 40 minutes in line at the kiosk",
    "Conflicting information and no explanation, staff not informed",
    "Lost luggage, my bag did not arrive, baggage carousel chaos",
    "The desk agent was helpful, kind and professional",
    "Customer support left me 45 minutes on hold and transferred me",
    "Paid for my own hotel, no compensation and no meal voucher",
    "The app kept refreshing and the website crashed at login",
    "Lost trust, will not return and never fly again",
    "Handled well, resolved quickly, they rebooked me with clear updates",
    "Crew were not helpful and the delay was frustrating",
    "Good communication despite the delay, smooth and easy",
    "Never resolved, although they made it right on paper",
    "Missed connection after a rolling delay, lost bag too",
    "Cancelled flight, unclear refund process and travel credit only",
    "Friendly crew, better than expected, no delay at all",
    "",
    "Seat was comfortable and the meal was fine",
    "Luggage delivered late, tracing number useless",
    "Cancelled with no clear next steps and conflicting information",
    "Delay then baggage delayed, poor communication",
    "Call center and chat agent slow, refund never came",
]


def _at(values: list[str], index: str) -> str:
    return f"get({sql_array(values)}, int({index}))"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per labelled document, with ``recommended`` as found.

    Being one row, it can neither repeat a review nor cost a scan where nothing is asked of it.
    """
    marks = spark.read.schema("doc_id long, quality int").parquet(f"{sf_dir}/labels.parquet")
    best = marks.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return best.selectExpr("doc_id", "CASE WHEN quality = 1 THEN 'yes' WHEN quality = 0 THEN '0' END AS recommended")


def raw_reviews(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """One review per document, before any standardization.

    How labels are joined is left to the planner: they may grow with the
    documents, so no broadcast is forced.  Without ``labelled``, they can be
    joined by ``doc_id`` when no text is needed any more.
    """
    documents = spark.read.schema("doc_id long, text string, source string, n_chars long").parquet(f"{sf_dir}/documents.parquet")
    # Empty reviews are rows of their own; no document's text is left out.
    rows = documents.selectExpr("*", "explode(IF(n_chars % 97 = 0, array(false, true), array(false))) AS blank").selectExpr(
        "IF(blank, doc_id + 1000000000, doc_id) AS doc_id", "text", "source", "n_chars", "blank")
    rows = rows.join(labels(spark, sf_dir), "doc_id", "left") if labelled else rows.withColumn("recommended", F.lit(None).cast("string"))
    return rows.selectExpr(
        "doc_id", "source",
        f"{_at(AIRLINES, 'doc_id % 8')} AS airline",
        "CASE WHEN n_chars % 5 = 0 THEN NULL ELSE 'Review' END AS review_title",
        f"CASE WHEN blank THEN '' ELSE concat({_at(SENTENCES, 'n_chars % 24')}, '. ', text) END AS review_text",
        "CASE WHEN doc_id % 11 = 10 THEN NULL ELSE double(1 + doc_id % 10) END AS rating",
        "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE date_add(date'2024-01-01', int(doc_id % 700)) END AS review_date",
        "doc_id % 50 = 0 AS is_synthetic",
        "CASE doc_id % 4 WHEN 0 THEN 'Business' WHEN 1 THEN ' Solo  Leisure ' WHEN 2 THEN '' END AS traveler_type",
        "CASE WHEN doc_id % 3 = 0 THEN 'PHX-ATL' END AS route",
        "CASE doc_id % 5 WHEN 0 THEN 'Economy' WHEN 1 THEN '' ELSE 'First Class' END AS seat_type",
        "recommended",
    )


def standardized_reviews(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """The view in the standard schema, ordered by document id."""
    raw = with_exprs(raw_reviews(spark, sf_dir, labelled), {
        "review_id": text.review_id(VIEW_KEY, "airline", "review_date", "review_title", "review_text"),
        "raw_text": text.combine_parts("review_title", "review_text"),
        "disruption_type": text.infer_disruption(text.combine_parts("review_title", "review_text"), DEFAULT_RULES),
        "source_row": "doc_id",
    })
    return complete_columns(raw).withColumn("source_rank", F.lit(0))


def read_reviews(spark: SparkSession, sf_dir: str, rules: RuleSet = DEFAULT_RULES, min_words: int = clean.MIN_WORDS) -> DataFrame:
    """Prepared reviews with all that is known of their texts, and only then labelled.

    Texts that nobody asks for are pruned before the labels are joined, so the join moves digests, matches and numbers.
    """
    read = themes.read_texts(clean.prepare(standardized_reviews(spark, sf_dir, labelled=False), rules, min_words), rules)
    keyed = read.withColumn("_text_key", F.expr(clean.text_key("clean_text"))).drop("recommended").withColumn("doc_id", F.col("source_row"))
    told = keyed.join(labels(spark, sf_dir), "doc_id", "left").drop("doc_id")
    return with_exprs(told, {"recommended": text.parse_flag("recommended")})
