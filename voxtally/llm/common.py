"""What the corpus operators share: scratch tables, Arrow maps, and hashed words of whole texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text hashed at once; arrays of eight bytes an entry stay small, and a longer text goes alone.
SLICE_BYTES = 1 << 20


#: Spark's own settings while a job of an operator runs: shuffle files go when their query ends, not when the driver
#: happens to collect garbage, and batches for Python are bounded in bytes, so that long texts do not fill a worker.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


@contextmanager
def modest(spark: SparkSession) -> Iterator[None]:
    """Settings for a job that runs inside the block; what is still lazy afterwards runs with the session's own."""
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# --- scratch tables -----------------------------------------------------------------------------------------------


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only where Spark runs inside this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="voxtally-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Tables and files of one run, in a folder of its own below the shared one."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def land(self, df: DataFrame, name: str) -> DataFrame:
        """Write and read back: lineage ends here, and lost executors cost no more than their tasks."""
        path = self.folder(f"{name}-{uuid.uuid4().hex[:8]}")
        with modest(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Delete landed tables that nothing reads any more."""
        for table in tables:
            for file in {f.rpartition("/")[0] for f in table.inputFiles()}:
                self.delete(file)

    def delete(self, path: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow``.  A worker goes on to other tasks, also of other stages: Arrow's unused memory is given back before."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(task, schema)


def present(value: str | None) -> str:
    return value if value is not None else ""


# --- hashed words ---------------------------------------------------------------------------------------------------

_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = np.where(_IS_WORD, mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER)), 0).astype(np.uint64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        made = []
        for base in (_MULTIPLIER, _INVERSE):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        if n > 2 * SLICE_BYTES:
            return made[0], made[1]
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes as numbers, and the starts and ends of the runs other than ASCII white space."""
    codes = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = _IS_WORD[codes]
    edges = np.diff(inside)
    return codes, np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of ``data``, with the words' starts and ends."""
    codes, starts, ends = word_spans(data)
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[codes] * up[: len(codes)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64)), starts, ends


def slices(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE_BYTES`` together."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE_BYTES:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def hashed_texts(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    for first, last in slices(texts):
        data = b"\n".join(texts[first:last])
        hashes, starts, _ = word_hashes(data)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[first:last]])
        bounds = np.searchsorted(starts, begins)
        for i in range(last - first):
            yield hashes[bounds[i] : bounds[i + 1]]


def shingled_texts(texts: Sequence[bytes], k: int) -> Iterator[np.ndarray]:
    """The hashes of each text's runs of ``k`` words, in order; a shorter text is one run, an empty one none."""
    for first, last in slices(texts):
        hashes, starts, _ = word_hashes(b"\n".join(texts[first:last]))
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[first:last]])
        bounds = np.searchsorted(starts, begins).tolist()
        runs = shingle_hashes(hashes, k, whole_if_short=False)
        for begin, end in zip(bounds, bounds[1:]):
            yield runs[begin : end - k + 1] if end - begin >= k else shingle_hashes(hashes[begin:end], k)


def different(values: np.ndarray) -> np.ndarray:
    """The different values, sorted."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def shingle_hashes(words: np.ndarray, k: int, whole_if_short: bool = True) -> np.ndarray:
    """Hashes of all runs of ``k`` words, repeats included; a shorter text is one run, an empty one none."""
    n = len(words)
    if n == 0 or (n < k and not whole_if_short):
        return np.empty(0, np.uint64)
    length = min(n, k)
    total = np.full(n - length + 1, length, np.uint64)
    for j in range(length):
        total += words[j : n - length + 1 + j] * np.uint64((_MULTIPLIER * (2 * j + 3) + 2 * j) & _MASK | 1)
    return mix(total)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def whole_documents(df: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, whatever else the table has."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def crc_remainder(column: str, divisor: int) -> F.Column:
    """``crc32`` of a number's decimal text, modulo ``divisor``; null ids count as the text ``null``."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")), F.lit(divisor))


# --- files in the shared folder -------------------------------------------------------------------------------------


def opened(uri: str, write: bool = False):
    """A binary file of the shared folder: streamed when written, and with random access when read."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)
    if not write:
        return store.open_input_file(path)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def new_file(folder: str, suffix: str) -> str:
    """A name no other task and no other attempt uses; only names in a landed manifest are ever read."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"
