"""From raw documents to token ids: language, near copies, benchmark leaks, secrets, encoding.

Every stage reads all that its predecessor kept, as a written table, and its decisions take effect there.  Of any stage an
empty table gives an empty one; all columns of the documents are kept as they are but for those a stage names, whatever
they are called; rows are decided by text, so repeated rows are treated alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxtally.llm import bpe, decontaminate, jaccard_join, language, secrets
from voxtally.llm.common import Scratch
from voxtally.llm.queries import table, vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the languages their labels teach; those without text or letters go.

    Null languages teach nothing.  Where nothing is taught, all documents with a letter stay.
    """
    return language.identified(docs, language.learn(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: 80 % of five-word shingles in common.

    Null and empty texts are near copies of nothing and stay.  Rows without an id, and rows that repeat the id of one that
    stays, stay.
    """
    return jaccard_join.one_of_each(docs, k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; ids may be null or repeated on either side."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by their kind; a null text stays null."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them; a null text has none."""
    return bpe.digests(docs, vocabulary(), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("encoding", encode),
]

#: The last stage's ids have no SQL; tests compare the run with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = before = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.land(stage(spark, before, sf_dir), name)
        if i:
            scratch.drop(before)
        before = docs
    return docs
