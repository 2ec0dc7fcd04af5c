"""Hard negatives by segment summaries.

A vector is cut into segments, and every segment keeps its mean and its deviation.  For two vectors and one segment of
``m`` components the inner product lies within ``m * (mean * mean -+ deviation * deviation)``, so sums over segments
bound a score from both sides.  Pairs are tested with few long segments first and with shorter ones as long as the
bounds leave them open; only what is still open is multiplied out.  The bounds decide nothing but what is skipped.

Anchors are dealt out to blocks of bounded size.  A block travels to the tasks, and the vectors stay where they are and
pass by it in batches, so neither table is ever shuffled against the other.  A task sends on a few rows for each
anchor, which are merged by anchor.  How much is skipped depends on the vectors: where neighbouring components
have nothing to do with each other, only the shortest segments rule anything out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtally.llm.common import Scratch, map_batches

#: Components of the shortest segments, and how many of them make one at each step of the refinement.
SEGMENT, GROUPS = 4, (16, 4, 1)
#: Bytes of one block of anchors, on the driver and in every task.
ANCHOR_BYTES = 32 << 20
#: Scores up to here are exact sums of doubles in whatever order.
MOST_SQUARE = float(1 << 53)
#: Entries of one matrix of bounds or scores.
CELLS = 1 << 21
#: Share of open pairs up to which they are looked at one by one; beyond, a matrix product over all is cheaper.
SPARSE = 1 / 16
#: Summaries are single precision; bounds are widened by this share of the product of lengths.
SLACK = 2e-5

_NOTHING = -(1 << 62)
VECTORS = "vec_id long, label long, dim int, vector array<int>, mean array<float>, deviation array<float>"


# --- vectors and summaries ------------------------------------------------------------------------------------------


def vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """Whole-number vectors with the summaries of their shortest segments.

    No part take rows with a null id, label or vector, with a null or non-finite component, and with a vector whose
    squared length after scaling reaches 2^53, since sums over it would no longer be exact.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, int)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                matrix = flat[starts[rows, None] + np.arange(dim)]
                rows, matrix = rows[np.isfinite(matrix).all(axis=1)], matrix[np.isfinite(matrix).all(axis=1)]
                with np.errstate(over="ignore"):
                    matrix = np.floor(scale * matrix)
                    fits = (matrix * matrix).sum(axis=1) < MOST_SQUARE
                rows, matrix = rows[fits], matrix[fits]
                if len(rows):
                    yield _batch(ids[rows], labels[rows], matrix)

    given = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).dropna()
    return map_batches(given, work, VECTORS)


def _batch(ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    mean, deviation = summaries(matrix)

    def rows(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        offsets = np.arange(len(values) + 1, dtype=np.int32) * np.int32(values.shape[1])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))

    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(labels), pa.array(np.full(len(ids), matrix.shape[1], np.int32)), rows(matrix.astype(np.int32), pa.int32()),
         rows(mean.astype(np.float32), pa.float32()), rows(deviation.astype(np.float32), pa.float32())],
        ["vec_id", "label", "dim", "vector", "mean", "deviation"],
    )


def summaries(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment; the last one is filled up with zeros, which add nothing to any product."""
    cut = _filled(matrix, SEGMENT).reshape(len(matrix), -1, SEGMENT)
    return cut.mean(axis=2), cut.std(axis=2)


def _filled(values: np.ndarray, multiple: int) -> np.ndarray:
    lacking = -values.shape[1] % multiple if values.shape[1] else multiple
    return np.pad(values, ((0, 0), (0, lacking))) if lacking else values


def factors(mean: np.ndarray, deviation: np.ndarray, group: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors whose products summed over ``group`` joined segments each are the bounds' middle and half width."""
    means = _filled(mean, group).reshape(len(mean), -1, group)
    squares = _filled(deviation, group).reshape(len(mean), -1, group) ** 2
    joint = means.mean(axis=2, keepdims=True)
    spread = np.sqrt(squares.mean(axis=2) + ((means - joint) ** 2).mean(axis=2))
    root = np.float32(np.sqrt(group * SEGMENT))
    return root * joint[:, :, 0], root * spread


@dataclass
class Side:
    """Vectors of one dimension with their summaries, ready for bounds."""

    ids: np.ndarray
    labels: np.ndarray
    exact: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    lengths: np.ndarray = field(init=False)
    levels: list[tuple[np.ndarray, np.ndarray]] = field(init=False)

    def __post_init__(self) -> None:
        self.lengths = np.sqrt((self.exact * self.exact).sum(axis=1))
        self.levels = [factors(self.mean, self.deviation, g) for g in GROUPS]

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, rows: np.ndarray | slice) -> Side:
        return Side(self.ids[rows], self.labels[rows], self.exact[rows], self.mean[rows], self.deviation[rows])


def sides(batch: pa.RecordBatch | pa.Table) -> dict[int, tuple[np.ndarray, Side]]:
    """The rows of each dimension, by their places in the batch."""
    dims = batch.column("dim").to_numpy()
    ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
    out = {}
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        of = batch.take(pa.array(rows))
        matrix = {}
        segments = max(1, -(-int(dim) // SEGMENT))
        for name, wide in (("vector", int(dim)), ("mean", segments), ("deviation", segments)):
            column = of.column(name)
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            matrix[name] = column.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), wide)
        out[int(dim)] = (rows, Side(ids[rows], labels[rows], matrix["vector"].astype(np.float64), matrix["mean"], matrix["deviation"]))
    return out


def open_pairs(rows: Side, anchors: Side, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, anchor and exact score of the pairs whose bounds never ruled out a score from ``least`` to ``most`` of the anchor."""
    slack = SLACK * (rows.lengths.max() if len(rows) else 0) * anchors.lengths + 1
    low, high = (least - slack).astype(np.float32), (most + slack).astype(np.float32)
    low, high = np.nextafter(low, np.float32(-np.inf)), np.nextafter(high, np.float32(np.inf))
    at: tuple[np.ndarray, np.ndarray] | None = None  # the open pairs once they are few
    total = len(rows) * len(anchors)
    for (row_mean, row_spread), (mean, spread) in zip(rows.levels, anchors.levels, strict=True):
        if at is None:
            middle, width = row_mean @ mean.T, row_spread @ spread.T
            is_open = (middle + width >= low) & (middle - width <= high)
            if np.count_nonzero(is_open) <= SPARSE * total:
                at = np.nonzero(is_open)
        else:
            r, a = at
            middle = np.einsum("ij,ij->i", row_mean[r], mean[a])
            width = np.einsum("ij,ij->i", row_spread[r], spread[a])
            stay = (middle + width >= low[a]) & (middle - width <= high[a])
            at = r[stay], a[stay]
    if at is None:
        scores = rows.exact @ anchors.exact.T
        r, a = np.nonzero((scores >= least) & (scores <= most))
        return r, a, scores[r, a].astype(np.int64)
    r, a = at
    scores = np.concatenate([np.einsum("ij,ij->i", rows.exact[r[i : i + 65536]], anchors.exact[a[i : i + 65536]]) for i in range(0, len(r), 65536)] or [np.zeros(0)])
    stay = (scores >= least[a]) & (scores <= most[a])
    return r[stay], a[stay], scores[stay].astype(np.int64)


class Best:
    """The first ``k`` different (score, id) of each of ``n`` keys: higher scores, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.n, self.k = n, k
        self.key, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.last = np.full(n, _NOTHING, np.int64)  # score of the k-th

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.last[key]
        if not keep.any():
            return
        key, score, ids = (np.concatenate(x) for x in ((self.key, key[keep]), (self.score, score[keep]), (self.id, ids[keep])))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        key, score, ids = key[new], score[new], ids[new]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        first = place < self.k
        self.key, self.score, self.id = key[first], score[first], ids[first]
        full = place == self.k - 1
        self.last[key[full]] = score[full]


# --- the two searches -----------------------------------------------------------------------------------------------


@dataclass
class Block:
    """A bounded number of anchors, by dimension, with their keys."""

    keys: dict[int, np.ndarray]
    sides: dict[int, Side]

    @staticmethod
    def of(table: pa.Table) -> Block:
        keys, parts = table.column("anchor").to_numpy(), sides(table)
        return Block({d: keys[rows] for d, (rows, _) in parts.items()}, {d: side for d, (_, side) in parts.items()})


def _label_pairs(rows: Side, anchors: Side, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows and anchors to compare, in pieces of at most ``CELLS`` pairs."""
    for label in np.unique(anchors.labels):
        mine = np.flatnonzero(anchors.labels == label)
        theirs = np.flatnonzero((rows.labels == label) == same)
        wide = min(len(mine), 2048)
        tall = max(1, CELLS // wide)
        for i in range(0, len(theirs), tall):
            for j in range(0, len(mine), wide):
                yield theirs[i : i + tall], mine[j : j + wide]


def positives(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """The task's first ``k`` rows of an anchor's own label, the anchor itself left out: anchor, score, vec_id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: Best(len(side), k) for dim, side in block.sides.items()}
        for batch in batches:
            for dim, (_, side) in sides(batch).items():
                if dim not in block.sides:
                    continue
                anchors, found = block.sides[dim], best[dim]
                for theirs, mine in _label_pairs(side, anchors, same=True):
                    r, a, score = open_pairs(side.take(theirs), anchors.take(mine), found.last[mine].astype(np.float64), np.full(len(mine), np.inf))
                    r, a = theirs[r], mine[a]
                    other = side.ids[r] != anchors.ids[a]
                    found.add(a[other], score[other], side.ids[r[other]])
        for dim, found in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(block.keys[dim][found.key]), pa.array(found.score), pa.array(found.id)], ["anchor", "score", "vec_id"])

    return map_batches(rows, work, "anchor long, score long, vec_id long")


@dataclass
class Bands:
    """For each anchor of a side and each of ``wide`` positives, the scores a negative may have."""

    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, wide: int, anchor: np.ndarray, place: np.ndarray, score: np.ndarray, low: int, high: int) -> Bands:
        """Whole scores from ``low`` to ``high`` per cent of a positive's; none where there is no positive."""
        at = np.argsort(keys)
        row = at[np.searchsorted(keys[at], anchor)]
        lows, highs = np.full((len(keys), wide), -_NOTHING), np.full((len(keys), wide), _NOTHING)
        lows[row, place], highs[row, place] = -(-low * score // 100), high * score // 100
        return Bands(lows, highs)


def negatives(rows: DataFrame, block: Block, bands: dict[int, Bands], k: int) -> DataFrame:
    """The task's first ``k`` rows of other labels in each band: anchor, place of the positive, score, vec_id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = {dim: b.low.shape[1] for dim, b in bands.items()}
        best = {dim: Best(len(b.low) * wide[dim], k) for dim, b in bands.items()}
        for batch in batches:
            for dim, (_, side) in sides(batch).items():
                if dim not in bands:
                    continue
                anchors, found, band, n = block.sides[dim], best[dim], bands[dim], wide[dim]
                for theirs, mine in _label_pairs(side, anchors, same=False):
                    need = np.maximum(band.low[mine], found.last.reshape(-1, n)[mine])
                    shut = band.low[mine] > band.high[mine]
                    need[shut] = -_NOTHING
                    least, most = need.min(axis=1), band.high[mine].max(axis=1)
                    some = least <= most
                    mine, least, most = mine[some], least[some].astype(np.float64), most[some].astype(np.float64)
                    if not len(mine):
                        continue
                    r, a, score = open_pairs(side.take(theirs), anchors.take(mine), least, most)
                    r, a = theirs[r], mine[a]
                    for place in range(n):
                        inside = (score >= band.low[a, place]) & (score <= band.high[a, place])
                        found.add(a[inside] * n + place, score[inside], side.ids[r[inside]])
        for dim, found in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.keys[dim][found.key // wide[dim]]), pa.array((found.key % wide[dim]).astype(np.int32)), pa.array(found.score), pa.array(found.id)],
                ["anchor", "place", "score", "vec_id"],
            )

    return map_batches(rows, work, "anchor long, place int, score long, vec_id long")


def _merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` of each key over all tasks, with ``rank`` from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(embeddings: DataFrame, anchor_every: int = 50, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
         relabel_every: int = 7, labels: int = 10, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """Hard negatives of every anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    Anchors are the rows whose id ``anchor_every`` divides.  An anchor's positives are the ``n_positives`` other rows of its
    label with the highest scores, and a positive's negatives the first ``n_negatives`` rows of other labels with ``low`` to
    ``high`` per cent of its score; a positive below zero has none.  Ties go to the smaller id.  An id that ``relabel_every``
    divides has the label after its own, of ``labels`` ones.

    An id names a row: rows of equal id are no positives of each other, and rows repeated in all columns count once.
    Rows of one id that differ are rows of their own, and so are anchors.  Only vectors of equal dimension are compared;
    vectors without components score 0.  What takes no part is said at :func:`vectors`.  An empty table has no result.
    """
    scratch = Scratch(embeddings.sparkSession, "hard_negatives")
    moved = F.when(F.col("vec_id").cast("long") % relabel_every == 0, (F.col("label").cast("long") + 1) % labels).otherwise(F.col("label").cast("long"))
    rows = scratch.land(vectors(embeddings.select("vec_id", moved.alias("label"), "embedding")), "vectors")
    chosen = rows.where(F.col("vec_id") % anchor_every == 0).distinct()
    anchors = scratch.land(chosen.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).first()
    # exact components, summaries at all levels and room for what is found
    blocks = max(1, -(-size.n * (16 * (size.dim or 0) + 64 * n_positives * n_negatives) // anchor_bytes))
    done: list[DataFrame] = []
    for number in range(blocks if size.n else 0):
        mine_now = anchors.where(F.pmod(F.xxhash64("anchor"), F.lit(blocks)) == number)
        block = Block.of(mine_now.toArrow())
        near = scratch.land(_merged(positives(rows, block, n_positives), ["anchor"], n_positives), "positives")
        table = near.toArrow()
        anchor, rank, score = (table.column(c).to_numpy() for c in ("anchor", "rank", "score"))
        bands = {}
        for dim, keys in block.keys.items():
            own = np.isin(anchor, keys)
            bands[dim] = Bands.of(keys, n_positives, anchor[own], rank[own] - 1, score[own], low, high)
        far = _merged(negatives(rows, block, bands, n_negatives), ["anchor", "place"], n_negatives)
        pairs = near.select("anchor", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        done.append(scratch.land(
            far.join(pairs, ["anchor", "place"]).join(mine_now.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")),
            "mined"))
        scratch.drop(near)
    scratch.drop(rows, anchors)
    result = done[0] if done else embeddings.sparkSession.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for more in done[1:]:
        result = result.unionAll(more)
    return result
