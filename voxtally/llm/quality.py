"""Quality rules: fixed limits, then gradient-boosted trees over document statistics.

The trees are fitted in numpy on a bounded sample of labelled rows, with histograms of binned statistics, and stored
flat: arrays of feature, threshold, children and value for all nodes.  Scoring walks all rows of a batch down
each tree at once.  Statistics that can only speak against a document are held monotonic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.common import Scratch, map_batches, shingle_hashes, slices, text_bytes, whole_documents, word_hashes

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_digits", "n_capitals",
    "n_stops", "n_chars",
)
STATISTICS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)

#: Fixed limits of the base rules.
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

#: Features and the direction in which each may move the verdict: -1 only down, 0 either way.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "duplicate_line_share": -1, "repeat_share": -1, "distinct_share": 0,
    "digit_share": -1, "capital_share": 0, "stop_share": 0, "words_a_line": 0,
}


def _flags(letters: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(letters)] = 1
    return table


_SYMBOL, _DIGIT = _flags(b"#*$%&|<>"), _flags(b"0123456789")
_CAPITAL, _STOP = _flags(bytes(range(65, 91))), _flags(b".!?")
_START = (np.arange(256) & 0xC0 != 0x80).astype(np.int64)  # first byte of a code point


def text_statistics(texts: list[bytes]) -> np.ndarray:
    """A row of ``COUNTS`` for each text."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    for first, last in slices(texts):
        data = b"\n".join(texts[first:last])
        hashes, starts, ends = word_hashes(data)
        codes = np.frombuffer(data, np.uint8)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[first:last]])
        stops = begins[1:] - 1
        bounds = np.searchsorted(starts, begins)
        of_prefix = {k: np.concatenate([[0], np.cumsum(t[codes])]) for k, t in (("s", _SYMBOL), ("d", _DIGIT), ("c", _CAPITAL), ("e", _STOP), ("p", _START))}
        in_words = np.concatenate([[0], np.cumsum(of_prefix["p"][ends] - of_prefix["p"][starts])])
        total = {k: v[stops] - v[begins[:-1]] for k, v in of_prefix.items()}
        for i in range(last - first):
            words = hashes[bounds[i] : bounds[i + 1]]
            lines = texts[first + i].split(b"\n")
            full = [x for x in lines if x.strip(b" \t\n\r\x0b\x0c")]
            out[first + i] = (
                len(words), in_words[bounds[i + 1]] - in_words[bounds[i]], total["s"][i], len(full) - len(set(full)), _repeated(words),
                len(full), len(np.unique(words)), total["d"][i], total["c"][i], total["e"][i], total["p"][i],
            )
    return out


def _repeated(words: np.ndarray, width: int = 5) -> int:
    """Words inside windows that occur twice or more."""
    windows = shingle_hashes(words, width, whole_if_short=False)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def statistics(documents: DataFrame) -> DataFrame:
    """``COUNTS`` of every whole text; a null text has none of anything.  Rows are treated alone; null ids stay null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = text_statistics(text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, counts.T)], ["doc_id", *COUNTS])

    return map_batches(whole_documents(documents), work, STATISTICS)


def features(counts: np.ndarray) -> np.ndarray:
    """``FEATURES`` of rows of ``COUNTS``."""
    c = dict(zip(COUNTS, counts.T.astype(np.float64), strict=True))
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_chars"], 1), np.maximum(c["n_lines"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        c["n_distinct_words"] / words, c["n_digits"] / chars, c["n_capitals"] / chars, c["n_stops"] / words, c["n_words"] / lines,
    ])


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees; a leaf's children are itself, so every row may take ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, directions: tuple[int, ...] = tuple(FEATURES.values()), trees: int = 60, depth: int = 3,
        rate: float = 0.15, bins: int = 64, smoothing: float = 5.0) -> Trees:
    """Boosted trees for the logistic loss; rows all of one label give their rate and no tree."""
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)])
        total = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            roots.append(_grow(nodes, binned, cuts, p - y, p * (1 - p), np.arange(len(y)), depth, directions, rate, smoothing, -np.inf, np.inf, total))
    table = np.array(nodes or [[0, 0, 0, 0, 0]], np.float64)
    return Trees(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4], np.array(roots, int), depth, base)


def _grow(nodes, binned, cuts, gradient, curvature, rows, depth, directions, rate, smoothing, low, high, total) -> int:
    """Add the best tree below a node; ``low`` and ``high`` bound its leaves, which keeps monotonic splits so."""
    me = len(nodes)
    g, h = gradient[rows].sum(), curvature[rows].sum()
    value = float(np.clip(-g / (h + smoothing), low, high))
    nodes.append([0, 0.0, me, me, rate * value])
    best = (1e-6, -1, -1, 0.0, 0.0)
    if depth and len(rows) >= 20:
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            gs = np.cumsum(np.bincount(binned[rows, f], gradient[rows], len(cut) + 1))[:-1]
            hs = np.cumsum(np.bincount(binned[rows, f], curvature[rows], len(cut) + 1))[:-1]
            counts = np.cumsum(np.bincount(binned[rows, f], minlength=len(cut) + 1))[:-1]
            a, b = np.clip(-gs / (hs + smoothing), low, high), np.clip(-(g - gs) / (h - hs + smoothing), low, high)
            gain = _gain(gs, hs + smoothing, a) + _gain(g - gs, h - hs + smoothing, b) - _gain(g, h + smoothing, value)
            gain[(counts < 5) | (len(rows) - counts < 5) | (directions[f] * (b - a) < 0)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k, float(a[k]), float(b[k]))
    _, f, k, a, b = best
    if f < 0:
        total[rows] += rate * value
        return me
    middle = (a + b) / 2
    bounds = ((low, high), (low, high)) if not directions[f] else ((middle, high), (low, middle)) if directions[f] < 0 else ((low, middle), (middle, high))
    goes_left = binned[rows, f] <= k
    left = _grow(nodes, binned, cuts, gradient, curvature, rows[goes_left], depth - 1, directions, rate, smoothing, *bounds[0], total)
    right = _grow(nodes, binned, cuts, gradient, curvature, rows[~goes_left], depth - 1, directions, rate, smoothing, *bounds[1], total)
    nodes[me] = [f, float(cuts[f][k]), left, right, 0.0]
    return me


def _gain(g, h, value):
    return -(g * value + 0.5 * h * value * value)


def learn(counted: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> Trees:
    """Fit on labelled rows: at most ``most_rows`` of them, those whose id hashes lowest, so the same ones each time.

    The labelled rows are counted first, and only those with a hash low enough for a few more than are wanted are sorted.

    Rows without a quality label teach nothing; a document labelled more than once counts once, as its lowest label.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = counted.join(marks, "doc_id")
    many, scale = labelled.count(), 1 << 40
    share = min(1.0, (most_rows + 6 * most_rows**0.5) / max(many, 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(scale))
    rows = labelled.where(place <= int(share * scale)).orderBy(place, "doc_id", *COUNTS).limit(most_rows).toPandas()
    return fit(features(rows[list(COUNTS)].to_numpy(np.int64)), (rows["quality"].to_numpy() > 0).astype(float))


def judge(counted: DataFrame, trees: Trees, least_score: float = 0.5) -> DataFrame:
    """``counted`` with ``base_failed``, ``score`` and ``kept``: false where the base rules fail, else what the trees say."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS]).astype(np.int64).reshape(-1, len(COUNTS))
            words, repeated = counts[:, 0], counts[:, COUNTS.index("n_repeat_words")]
            failed = (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * words)
            score = trees.score(features(counts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(failed), pa.array(score), pa.array(~failed & (score >= least_score))],
                [*batch.schema.names, "base_failed", "score", "kept"],
            )

    return map_batches(counted.select("doc_id", *COUNTS), work, STATISTICS + ", base_failed boolean, score double, kept boolean")


def landed_statistics(documents: DataFrame) -> DataFrame:
    """``statistics`` as a table in the shared folder: whole texts are read once, for learning and judging."""
    return Scratch(documents.sparkSession, "quality").land(statistics(documents), "counts")
