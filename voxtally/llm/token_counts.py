"""Token counts of documents in flat token files, found by their separators.

A flat file holds nothing but ids, each document's followed by the end-of-document id; there is no index.  Files
are cut into blocks of equal length, each block is searched for separators at once, and what a block cannot
know - where the document that it begins with started, and how many came before - is a prefix scan
over the blocks' summaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtally.llm.bpe import automaton
from voxtally.llm.common import Scratch, map_batches, new_file, opened, present, whole_documents

END_OF_DOCUMENT = "<|endoftext|>"
#: Tasks that search blocks, at most.
MOST_TASKS = 10_000
ORDER = "file string, place long, doc_id long, n_bytes long"
BLOCKS = "file string, block long, n_tokens long, n_ends long, first_end long, last_end long, inner array<long>"


def write_token_files(documents: DataFrame, vocabulary: str, folder: str) -> DataFrame:
    """Write one flat file for each task; the result says which document is at which place of which file, and has a
    row of place -1 with each file's length.  It must be landed before it is used.

    Ids have two bytes where the vocabulary allows, else four.  A null text is an empty document.  The separator's own
    string in a text is encoded as ordinary text.  A task that runs again writes a new file, and only the file of the
    attempt that counted is named in the result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = automaton(vocabulary)
        kind, end = id_type(vocabulary)
        stop = np.array([end], kind).tobytes()
        file, place, written = new_file(folder, ".bin"), 0, 0
        out = None
        for batch in batches:
            out = out or opened(file, write=True)
            for text in batch.column("text"):
                ids = np.frombuffer(coder.encode_ordinary(present(text.as_py())), "<u4").astype(kind).tobytes() + stop
                out.write(ids)
                written += len(ids)
            n = len(batch)
            yield _order(file, range(place, place + n), batch.column("doc_id"), [None] * n)
            place += n
        if out is not None:
            out.close()
            yield _order(file, [-1], pa.array([None], pa.int64()), [written])

    return map_batches(whole_documents(documents), work, ORDER)


def _order(file: str, places, ids: pa.Array, sizes: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * len(sizes)), pa.array(places, pa.int64()), ids, pa.array(sizes, pa.int64())], ["file", "place", "doc_id", "n_bytes"]
    )


def id_type(vocabulary: str) -> tuple[str, int]:
    """Type of the ids and the separator's id."""
    coder = automaton(vocabulary)
    return ("<u2" if max(coder.labels) < 1 << 16 else "<u4"), coder.special[END_OF_DOCUMENT]


def separators(ids: np.ndarray, end: int) -> np.ndarray:
    """Where the separators of a block are."""
    return np.flatnonzero(ids == end)


def count_tokens(files: DataFrame, kind: str, end: int, block_tokens: int = 1 << 20) -> DataFrame:
    """``file``, ``place`` (from 0), ``first_token`` and ``n_tokens`` of every document of the given ``file``s of ``n_bytes``.

    Tokens after a file's last separator are a last document; an empty file has none.  Nothing is known of a file but
    its length, and no task holds more than a block.
    """
    width = np.dtype(kind).itemsize

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, size in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "size")), strict=True):
                with opened(file) as source:
                    source.seek(block * block_tokens * width)
                    ids = np.frombuffer(source.read(size), kind)
                ends = separators(ids, end)
                first, last = (int(ends[0]), int(ends[-1])) if len(ends) else (None, None)
                yield pa.RecordBatch.from_arrays([
                    pa.array([file]), pa.array([block]), pa.array([len(ids)]), pa.array([len(ends)]), pa.array([first], pa.int64()),
                    pa.array([last], pa.int64()), pa.array([np.diff(ends) - 1], pa.list_(pa.int64())),
                ], ["file", "block", "n_tokens", "n_ends", "first_end", "last_end", "inner"])

    bytes_a_block = block_tokens * width
    blocks = (
        files.where("n_bytes > 0")
        .select("file", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_bytes - 1) div {bytes_a_block}"))).alias("block"))
        .select("file", "block", F.least(F.lit(bytes_a_block), F.col("n_bytes") - F.col("block") * bytes_a_block).alias("size"))
    )
    # A number of tasks that is given is not merged again; each has a few blocks.
    many = files.where("n_bytes > 0").agg(F.coalesce(F.sum(F.expr(f"(n_bytes - 1) div {bytes_a_block} + 1")), F.lit(1))).first()[0]
    blocks = blocks.repartition(min(many, MOST_TASKS))
    found = map_batches(blocks, work, BLOCKS)
    # The scan over blocks: documents, tokens and the last separator before each.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("block") * block_tokens
    scanned = found.select(
        "file", "block", "n_tokens", "n_ends", "inner", start.alias("start"), "first_end",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("done"),
        F.coalesce(F.max(start + F.col("last_end")).over(before), F.lit(-1)).alias("since"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("is_last"),
        (start + F.col("last_end")).alias("last_here"),
    )
    first_length = F.col("start") + F.col("first_end") - F.col("since") - 1
    tail = F.col("start") + F.col("n_tokens") - F.coalesce("last_here", "since") - 1
    lengths = F.concat(
        F.when(F.col("n_ends") > 0, F.concat(F.array(first_length), "inner")).otherwise(F.array().cast("array<long>")),
        F.when(F.col("is_last") & (tail > 0), F.array(tail)).otherwise(F.array().cast("array<long>")),
    )
    each = scanned.select("file", "done", "since", F.posexplode(lengths).alias("at", "n_tokens"))
    inside = Window.partitionBy("file", "done").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return each.select(
        "file", (F.col("done") + F.col("at")).alias("place"),
        (F.col("since") + 1 + F.coalesce(F.sum(F.col("n_tokens") + 1).over(inside), F.lit(0))).alias("first_token"), "n_tokens",
    )


def document_token_counts(documents: DataFrame, vocabulary: str, block_tokens: int = 1 << 20) -> DataFrame:
    """``doc_id``, ``n_tokens``, and ``place`` in its file, for every row, by way of flat token files.

    The files live in the shared folder while they are scanned and are deleted then; the counts are a landed table.
    A document is a place in a file, so null and repeated ids stay as they are; a null text has no token.
    """
    scratch = Scratch(documents.sparkSession, "token_counts")
    order = scratch.land(write_token_files(documents, vocabulary, scratch.folder("tokens")), "order")
    # Landed, so the planner knows how large the counts are, and they are as many as the documents.
    counts = scratch.land(count_tokens(order.where("place = -1").select("file", "n_bytes"), *id_type(vocabulary), block_tokens), "lengths")
    named = order.where("place >= 0").select("file", "place", "doc_id")
    result = scratch.land(named.join(counts, ["file", "place"]).select("doc_id", "n_tokens", "place", "first_token"), "counts")
    scratch.delete(scratch.folder("tokens"))
    scratch.drop(order, counts)
    return result
