"""A small suffix tree in memory, spelled by table-driven steps: what the written table is compared with."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.suffix_tree import BITS, END, GRAM, PAD, SYMBOLS, stream

_SPACE = 32
_LANES = 4096


@dataclass(frozen=True)
class Automaton:
    """Flat tables with a row for each state and a column for each symbol class."""

    depth: int
    classes: np.ndarray
    width: int
    target: np.ndarray
    log10: np.ndarray
    kept: int

    def spell(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of spelling each token, ends included, of each normal text.

        The stream of all texts is cut into lanes that advance together; a lane first reads the ``depth`` symbols before
        it, after which its state is the right one.
        """
        symbols, _ = stream(texts, self.depth)
        classes = self.classes[symbols]
        lanes = max(1, min(_LANES, len(classes) // 64))
        length = -(-len(classes) // lanes)
        padded = np.full(self.depth + lanes * length, self.classes[PAD], np.int64)
        padded[self.depth : self.depth + len(classes)] = classes
        columns = padded[np.arange(self.depth + length)[:, None] + np.arange(lanes) * length]
        found = np.empty((length, lanes), np.float32)
        state = np.zeros(lanes, np.int64)
        for step, column in enumerate(columns):
            cell = state * self.width + column
            if step >= self.depth:
                found[step - self.depth] = self.log10[cell]
            state = self.target[cell].astype(np.int64)
        sums = np.cumsum(found.T.ravel()[: len(classes)].astype(np.float64))
        return np.diff(sums[(symbols == _SPACE) | (symbols == END)], prepend=0.0)


def tree(counted: DataFrame, depth: int, least_share: float, strength: float) -> Automaton:
    """A small tree as an automaton in memory, of contexts with at least ``least_share`` of all symbols."""
    grams = counted.where(f"kind = {GRAM}").select("key", "n")
    whole = grams.agg(F.sum("n")).first()[0] or 0
    levels = None
    for k in range(depth + 1):
        arcs = grams.groupBy(F.col("key").bitwiseAND((1 << BITS * (k + 1)) - 1).alias("key")).agg(F.sum("n").alias("n"))
        context = F.shiftright("key", BITS).alias("context")
        frequent = arcs.groupBy(context).agg(F.sum("n").alias("of")).where(F.col("of") >= max(1.0, least_share * whole)).select("context")
        level = arcs.join(frequent, F.shiftright("key", BITS) == F.col("context"), "left_semi").select(F.lit(k).alias("k"), "key", "n")
        levels = level if levels is None else levels.unionAll(level)
    found = levels.toArrow()
    return _automaton(found["k"].to_numpy(), found["key"].to_numpy(), found["n"].to_numpy(), depth, strength)


def _automaton(ks: np.ndarray, keys: np.ndarray, ns: np.ndarray, depth: int, strength: float) -> Automaton:
    root_keys, root_counts = keys[ks == 0], ns[ks == 0]
    seen = np.unique(root_keys)
    # Classes: seen symbols, then one for all unseen, then the pad.
    classes = np.full(PAD + 1, len(seen), np.int64)
    classes[seen] = np.arange(len(seen))
    classes[PAD] = len(seen) + 1
    width = len(seen) + 2
    unseen = SYMBOLS - len(seen)
    root = np.zeros(width)
    root[classes[root_keys]] = root_counts
    root[: len(seen)] += 1
    root[len(seen)] = 1  # of each unseen symbol
    root /= root_counts.sum() + len(seen) + unseen
    kept: dict[tuple[int, int], np.ndarray] = {(0, 0): root}  # (length, context) to smoothed distribution
    wanted: dict[int, set[int]] = {k: set() for k in range(depth + 1)}
    tables: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
    for k in range(1, depth + 1):
        mine = ks == k
        order = np.argsort(keys[mine])
        arc, n = keys[mine][order], ns[mine][order]
        contexts, first = np.unique(arc >> BITS, return_index=True)
        tables[k] = {}
        for c, a, b in zip(contexts.tolist(), first, np.append(first, len(arc))[1:], strict=True):
            tables[k][c] = classes[arc[a:b] & (1 << BITS) - 1], n[a:b].astype(float)
    for k in range(1, depth + 1):
        below = tables.get(k - 1, {})
        for c, (symbols, n) in tables[k].items():
            suffix = c & (1 << BITS * (k - 1)) - 1
            if k == 1:
                parent = root[symbols]
            else:
                parent_symbols, parent_n = below[suffix]
                full = np.zeros(width)
                full[parent_symbols] = parent_n / parent_n.sum()
                parent = full[symbols]
            total = n.sum()
            divergence = float((n * np.log(n / total / parent)).sum())
            if divergence > strength * len(n) * math.log(total + 1) / 2:
                wanted[k].add(c)
    for k in range(depth, 1, -1):  # a context needs its suffixes
        wanted[k - 1] |= {c & (1 << BITS * (k - 1)) - 1 for c in wanted[k]}
    for k in range(1, depth + 1):
        for c in wanted[k]:
            symbols, n = tables[k][c]
            parent = kept[k - 1, c & (1 << BITS * (k - 1)) - 1]
            weight = float(len(n))  # as much faith in the suffix as there are different symbols
            own = parent * weight
            own[symbols] += n
            kept[k, c] = own / (n.sum() + weight)
    # States: kept contexts and their prefixes, by length.
    names: list[set[int]] = [set(wanted[k]) if k else {0} for k in range(depth + 1)]
    for k in range(depth, 1, -1):
        names[k - 1] |= {c >> BITS for c in names[k]}
    state: dict[tuple[int, int], int] = {}
    for k in range(depth + 1):
        for c in sorted(names[k]):
            state[k, c] = len(state)
    target = np.zeros((len(state), width), np.int32)
    log10 = np.zeros((len(state), width), np.float32)
    for (k, c), s in state.items():
        if k:
            shorter = state[k - 1, c & (1 << BITS * (k - 1)) - 1]
            target[s], log10[s] = target[shorter], log10[shorter]
        if (k, c) in kept:
            log10[s] = np.log10(np.maximum(kept[k, c], 1e-300))
            log10[s, classes[PAD]] = 0
        # An arc to every state that is this one and a symbol more.
        if k < depth:
            for symbol in (*seen.tolist(), PAD):
                longer = state.get((k + 1, c << BITS | symbol))
                if longer is not None:
                    target[s, classes[symbol]] = longer
    return Automaton(depth, classes, width, target.ravel(), log10.ravel(), len(kept))
