"""Language-model scores from a probabilistic suffix tree.

The tree spells texts byte by byte: each word and a space, then an end.  A context of up to ``depth`` symbols is
kept when it occurs ``least`` times, however large the corpus, and its next-symbol counts diverge from those of its
suffix by more than they cost to describe.  A kept context's distribution is smoothed with that of its longest kept
suffix.  The tree is a written table with a row for each kept context, and grows with the corpus.  Tasks hold its most
frequent part, of bounded size.  Runs of symbols that may go on into the rest are collected first, each once for a task,
looked up there by joins, and answered in a file for each task.

A token's probability is ``(c + a t) / (N + a)``: ``c`` of ``N`` training tokens are this one, ``t`` is the tree's
probability of spelling it where it stands, and ``a`` is the number of tokens seen once, which
is how often new ones are to be expected.  The tree so decides for rare and new words, and all words'
probabilities add up to one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.common import Scratch, crc_remainder, hashed_texts, map_batches, mix, modest, slices, text_bytes, whole_documents

END, PAD, SYMBOLS, BITS = 256, 257, 257, 9
#: Token that ends every text, beside the hashes of words.
END_TOKEN = np.uint64(0x5EED_0F_7E97_E4D5)
GRAM, WORD = 0, 1
_SPACE = 32
_MERGE_AT = 1 << 20

HELD_OUT_DIVISOR, HELD_OUT_REMAINDER = 7, 2


def held_out(documents: DataFrame) -> F.Column:
    return crc_remainder("doc_id", HELD_OUT_DIVISOR) == HELD_OUT_REMAINDER


def normal(text: bytes) -> bytes:
    """A-Z in lower case, one space after every word."""
    words = text.lower().split()
    return b" ".join([*words, b""]) if words else b""


def stream(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of normal texts one after another, each behind ``depth`` pads and before its end, and where each begins."""
    lengths = np.array([len(t) for t in texts]) + depth + 1
    begins = np.concatenate([[0], np.cumsum(lengths)])
    out = np.full(begins[-1], PAD, np.uint16)
    inside = np.ones(begins[-1], bool)
    for j in range(depth):
        inside[begins[:-1] + j] = False
    inside[begins[1:] - 1] = False
    out[inside] = np.frombuffer(b"".join(texts), np.uint8)
    out[begins[1:] - 1] = END
    return out, begins


def runs(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol of normal texts with the ``depth`` before it, packed, and the symbol alone."""
    symbols, _ = stream(texts, depth)
    packed = np.zeros(len(symbols) - depth, np.uint64)
    for j in range(depth + 1):
        packed |= symbols[j : len(symbols) - depth + j].astype(np.uint64) << np.uint64(BITS * (depth - j))
    own = symbols[depth:] != PAD
    return packed[own], symbols[depth:][own]


# --- counting -------------------------------------------------------------------------------------------------------


class _Counts:
    """Keys and their counts, merged whenever many have come together."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size >= 2 * _MERGE_AT:
            self.merge()

    def merge(self) -> None:
        keys, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        self.parts = [(keys, np.bincount(at, np.concatenate([n for _, n in self.parts]), len(keys)).astype(np.int64))]
        self.size = len(keys)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            self.merge()
        out = self.parts[0] if self.parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
        self.parts, self.size = [], 0
        return out


def counts(documents: DataFrame, depth: int) -> DataFrame:
    """``kind``, ``key``, ``n``: how often each run of ``depth`` symbols and a next one (``GRAM``) and each token (``WORD``,
    by a 64-bit hash) occurs in all texts.  Tasks add up what they have before anything is shuffled."""

    def rows(kind: int, found: _Counts) -> Iterator[pa.RecordBatch]:
        keys, n = found.take()
        for i in range(0, len(keys), 1 << 16):
            part = keys[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part.view(np.int64)), pa.array(n[i : i + (1 << 16)])], ["kind", "key", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words = _Counts(), _Counts()
        for batch in batches:
            raw = text_bytes(batch.column("text"))
            for first, last in slices(raw):
                texts = [normal(t) for t in raw[first:last]]
                grams.add(runs(texts, depth)[0])
                words.add(np.concatenate([*hashed_texts(texts), np.full(len(texts), END_TOKEN)]))
                for kind, found in ((GRAM, grams), (WORD, words)):
                    if found.size > _MERGE_AT:
                        found.merge()
                        if found.size > _MERGE_AT:
                            yield from rows(kind, found)
        yield from rows(GRAM, grams)
        yield from rows(WORD, words)

    found = map_batches(whole_documents(documents), work, "kind int, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


# --- the tree -------------------------------------------------------------------------------------------------------

#: Stands in a symbol's place for the context itself.
_ITSELF = np.uint64((1 << BITS) - 1)
#: Symbols and contexts of the tree's most frequent part that every task holds.
MOST_HELD = 1 << 21
#: Bits that tell which contexts the rest of the tree may have.
_REST_BITS = 26
_NO_KEY = np.uint64((1 << 64) - 1)
#: Runs that a task remembers; the number only saves time.
_REMEMBERED_BITS = 20

CONTEXT = "k int, context long, of long, symbols array<int>, logs array<double>, weight double"


def _suffix(key: np.ndarray, symbols: int) -> np.ndarray:
    return key & np.uint64((1 << BITS * symbols) - 1)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The entries of a column of lists, and the row of each."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), sizes)


def _with_parent(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each context's symbols, the row of each, and its place in the flat lists of the parent, which has them all."""
    symbols, row = _flat(batch.column("symbols"))
    theirs, their_row = _flat(batch.column("parent_symbols"))
    return _flat(batch.column("ns"))[0].astype(float), row, np.searchsorted(their_row << BITS | theirs, row << BITS | symbols)


def contexts(counted: DataFrame, scratch: Scratch, depth: int, least: int, strength: float) -> tuple[np.ndarray, DataFrame]:
    """log10 probability of each symbol without a context, and the table of all kept contexts.

    A row has the context, how often it occurs, the symbols seen behind it with their log10 probabilities, and ``weight``,
    log10 of what any other symbol's probability with the next shorter context is multiplied by.
    """
    grams = counted.where(f"kind = {GRAM}").select("key", "n")
    levels = None
    for k in range(depth + 1):
        arcs = grams.groupBy(F.col("key").bitwiseAND((1 << BITS * (k + 1)) - 1).alias("key")).agg(F.sum("n").alias("n"))
        arc = F.struct(F.col("key").bitwiseAND((1 << BITS) - 1).cast("int").alias("symbol"), "n")
        level = arcs.groupBy(F.shiftright("key", BITS).alias("context")).agg(F.sum("n").alias("of"), F.array_sort(F.collect_list(arc)).alias("arcs"))
        level = level.where((F.col("of") >= least) | F.lit(k == 0)).select(F.lit(k).alias("k"), "context", "of", "arcs.symbol", "arcs.n")
        levels = level if levels is None else levels.unionAll(level)
    frequent = scratch.land(levels.toDF("k", "context", "of", "symbols", "ns"), "frequent")
    root = np.ones(SYMBOLS)
    for r in frequent.where("k = 0").collect():
        root[r.symbols] += r.ns
    root = np.log10(root / root.sum())

    def above(child: DataFrame, parent: DataFrame, *more: str) -> DataFrame:
        """Contexts with columns of the one that is a symbol shorter."""
        suffix = F.expr(f"context & (shiftleft(1L, {BITS} * (k - 1)) - 1)")
        named = parent.select((F.col("k") + 1).alias("k"), F.col("context").alias("suffix"), *(F.col(c).alias(f"parent_{c}") for c in more))
        return child.where("k > 0").withColumn("suffix", suffix).join(named, ["k", "suffix"])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, row, place = _with_parent(batch)
            k, of, parent_of = (batch.column(c).to_numpy() for c in ("k", "of", "parent_of"))
            parent = _flat(batch.column("parent_ns"))[0][place] / parent_of[row]
            symbols = _flat(batch.column("symbols"))[0]
            parent = np.where(k[row] == 1, 10 ** root[symbols], parent)
            divergence = np.bincount(row, n * np.log(n / of[row] / parent), len(batch))
            kinds = np.bincount(row, minlength=len(batch))
            yield batch.select(["k", "context"]).filter(pa.array(divergence > strength * kinds * np.log(of + 1) / 2))

    told = map_batches(above(frequent, frequent, "of", "symbols", "ns"), tell, "k int, context long")
    # A context needs its suffixes.
    wanted = told.select(F.explode(F.expr(f"transform(sequence(1, k), j -> struct(j as k, context & (shiftleft(1L, {BITS} * j) - 1) as context))")).alias("c"))
    kept = scratch.land(frequent.join(wanted.select("c.*").distinct(), ["k", "context"], "left_semi"), "kept")
    scratch.drop(frequent)

    def smooth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, row, place = _with_parent(batch)
            of, kinds = batch.column("of").to_numpy(), np.bincount(row, minlength=len(batch))
            # As much faith in the suffix as there are different symbols.
            parent = 10 ** _flat(batch.column("parent_logs"))[0][place]
            logs = np.log10((parent * kinds[row] + n) / (of + kinds)[row])
            column = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kinds)]), pa.int32()), pa.array(logs, pa.float64()))
            weight = pa.array(np.log10(kinds / (of + kinds)), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k", "context", "of", "symbols")), column, weight], ["k", "context", "of", "symbols", "logs", "weight"])

    first = counted.sparkSession.createDataFrame([(0, 0, 0, list(range(SYMBOLS)), root.tolist(), 0.0)], CONTEXT)
    out, parents = None, first
    for k in range(1, depth + 1):
        parents = scratch.land(map_batches(above(kept.where(f"k = {k}"), parents, "symbols", "logs"), smooth, CONTEXT), f"contexts{k}")
        out = parents if out is None else out.unionAll(parents)
    scratch.drop(kept)
    return root, out


class _Table:
    """Values by key, in open slots."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, (len(keys) * 5 // 4).bit_length())
        self.keys = np.full(1 << self.bits, _NO_KEY)
        self.values = np.zeros(1 << self.bits, np.float32)
        at, todo = self._first(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] == _NO_KEY]
            slot, which = np.unique(at[free], return_index=True)
            self.keys[slot], self.values[slot] = keys[free[which]], values[free[which]]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = at[todo] + 1 & (1 << self.bits) - 1

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and their values."""
        found, values = np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
        at, todo = self._first(keys), np.arange(len(keys))
        while len(todo):
            there = self.keys[at]
            hit = there == keys[todo]
            found[todo[hit]], values[todo[hit]] = True, self.values[at[hit]]
            on = ~hit & (there != _NO_KEY)
            todo, at = todo[on], at[on] + 1 & (1 << self.bits) - 1
        return found, values


def _rest_slots(k: int | np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(8) + np.asarray(k, np.uint64)) >> np.uint64(64 - _REST_BITS)


@dataclass(frozen=True)
class Held:
    """The most frequent part of the tree, and bits that tell of which contexts there may be more."""

    depth: int
    root: np.ndarray
    tables: list[_Table]
    rest: np.ndarray | None

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each run's last symbol by the longest held context, the length of that one, and whether a longer
        one may be in the rest."""
        symbol = _suffix(grams, 1)
        logs, length = self.root[symbol.astype(np.int64)].copy(), np.zeros(len(grams), np.int64)
        going = np.arange(len(grams))
        for k, table in enumerate(self.tables, 1):
            key = _suffix(grams[going], k + 1)
            found, weight = table.find(key | _ITSELF)
            going, key, weight = going[found], key[found], weight[found]
            seen, own = table.find(key)
            logs[going] = np.where(seen, own, logs[going] + weight)
            length[going] = k
        more = np.zeros(len(grams), bool)
        if self.rest is not None:
            open_ = np.flatnonzero(length < self.depth)
            bits = (length[open_] + 1).astype(np.uint64) * np.uint64(BITS)
            context = grams[open_] >> np.uint64(BITS) & (_ONE << bits) - _ONE
            slot = _rest_slots(length[open_] + 1, context)
            more[open_] = self.rest[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & _ONE
        return logs, length, more


_ONE = np.uint64(1)


def held(model: DataFrame, root: np.ndarray, depth: int, most: int) -> tuple[Held, DataFrame | None]:
    """What tasks hold, at most ``most`` symbols and contexts, and the rest of the tree if there is any.

    A suffix is at least as frequent as what it ends, so the held part has the suffixes of all its contexts.
    """
    by_size = model.groupBy(F.floor(8 * F.log2("of")).cast("int").alias("size")).agg(F.sum(F.size("symbols") + 1).alias("n")).collect()
    limit, many = 0, 0
    for r in sorted(by_size, reverse=True):
        many += r.n
        if many > most:
            limit = r.size + 1
            break
    frequent = F.floor(8 * F.log2("of")) >= limit
    found = model.where(frequent).select("k", "context", "weight", "symbols", "logs").toArrow().combine_chunks()
    ks, context, weight = (found[c].to_numpy() for c in ("k", "context", "weight"))
    context = context.astype(np.uint64) << np.uint64(BITS)
    lists = [found[c].combine_chunks() for c in ("symbols", "logs")]
    (symbols, row), (logs, _) = ((_flat(c.chunk(0) if isinstance(c, pa.ChunkedArray) else c)) for c in lists)
    tables = []
    for k in range(1, depth + 1):
        mine, arcs = ks == k, ks[row] == k
        keys = np.concatenate([context[mine] | _ITSELF, context[row[arcs]] | symbols[arcs].astype(np.uint64)])
        tables.append(_Table(keys, np.concatenate([weight[mine], logs[arcs]])))
    if not limit:
        return Held(depth, root, tables, None), None
    rest = model.where(~frequent)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.unique(_rest_slots(batch.column("k").to_numpy(), batch.column("context").to_numpy().astype(np.uint64)))
            places, first = np.unique(slot >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(_ONE << (slot & np.uint64(63)), first) if len(slot) else slot
            yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int64)), pa.array(bits.view(np.int64))], ["place", "bits"])

    marks = map_batches(rest.select("k", "context"), mark, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << _REST_BITS - 6, np.uint64)
    bits[marks["place"].to_numpy()] = marks["bits"].to_numpy().view(np.uint64)
    return Held(depth, root, tables, bits), rest


def resolved(grams: DataFrame, rest: DataFrame, scratch: Scratch, depth: int) -> DataFrame:
    """``gram`` and ``log`` of runs given with what the held part tells: ``gram``, ``length`` and ``log``."""
    for k in range(1, depth + 1):
        level = rest.where(f"k = {k}").select("context", "symbols", "logs", "weight")
        grams = grams.withColumn("context", F.expr(f"shiftright(gram, {BITS}) & {(1 << BITS * k) - 1}L"))
        own = F.expr(f"get(logs, cast(array_position(symbols, cast(gram & {(1 << BITS) - 1} as int)) as int) - 1)")
        longer = F.col("weight").isNotNull() & (F.col("length") == k - 1)
        grams = grams.join(level, "context", "left").select(
            "gram", F.when(longer, k).otherwise(F.col("length")).alias("length"), F.when(longer, F.coalesce(own, F.col("log") + F.col("weight"))).otherwise(F.col("log")).alias("log"),
        )
    return scratch.land(grams.select("gram", "log"), "resolved")


# --- scoring --------------------------------------------------------------------------------------------------------

_TOLD = pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
SCORED = "row long, token long, spelled double, told struct<doc_id:long,held_out:boolean,n_tokens:long,n_known:long,base:double,score:double>"


class _Memo:
    """Values of the runs seen last; a run has one place, which another one may take."""

    def __init__(self) -> None:
        self.keys = np.full(1 << _REMEMBERED_BITS, _NO_KEY)
        self.values = np.zeros(1 << _REMEMBERED_BITS)

    def values_of(self, runs: np.ndarray, find: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The value of every run; ``find`` is asked for each different one that is not remembered."""
        at = (mix(runs) >> np.uint64(64 - _REMEMBERED_BITS)).astype(np.int64)
        values, new = self.values[at], np.flatnonzero(self.keys[at] != runs)
        if len(new):
            each, first, where = np.unique(runs[new], return_index=True, return_inverse=True)
            found = find(each)
            values[new] = found[where]
            self.keys[at[new[first]]], self.values[at[new[first]]] = each, found
        return values


def _answers(folder: str, task: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs a task asked for, sorted, and their log10 probabilities."""
    store, path = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
    files = store.get_file_info(fs.FileSelector(f"{path}/task={task}", allow_not_found=True))
    grams, logs = [np.empty(0, np.uint64)], [np.empty(0)]
    for file in files:
        if file.path.endswith(".parquet"):
            with store.open_input_file(file.path) as source:
                found = pq.ParquetFile(source).read(["gram", "log"])
            grams.append(found["gram"].to_numpy().view(np.uint64))
            logs.append(found["log"].to_numpy())
    grams, logs = np.concatenate(grams), np.concatenate(logs)
    order = np.argsort(grams)
    return grams[order], logs[order]


def score(documents: DataFrame, teaching: F.Column | None = None, depth: int = 6, least: int = 50, strength: float = 1.0,
          common_words: int = 1 << 19, most_held: int = MOST_HELD) -> DataFrame:
    """Every row's unigram ``base_score`` and model's ``score``, both log10, with ``n_tokens``, ``n_known`` and ``train_tokens``.

    Rows where ``teaching`` holds are learned from (default: those not held out); repeated rows teach as often as they
    occur.  A null or empty text is its end alone.  With nothing to learn from all symbols are equally likely.

    Counts of words with more than a ``common_words``-th of all tokens, of which there are fewer than ``common_words``,
    go to all tasks; the counts of all others meet the texts in a join by word, so the vocabulary may be of any size.
    So do the tree's ``most_held`` most frequent symbols and contexts and its rest.  Neither number changes a score.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "suffix_tree")
    out = held_out(documents)
    counted = scratch.land(counts(documents.where(~out if teaching is None else teaching), depth), "counts")
    root, model = contexts(counted, scratch, depth, least, strength)
    words = scratch.land(counted.where(f"kind = {WORD}").select(F.col("key").alias("token"), "n"), "words")
    scratch.drop(counted)
    near, rest = held(model, root, depth, most_held)
    total, different, once = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") == 1)).first()
    common = words.where(F.col("n") > total / common_words).toArrow()
    keys = common["token"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((near, keys[order], common["n"].to_numpy().astype(float)[order]))
    novel = float(max(1, once))
    base_divisor, divisor = math.log10(total + different + 1), math.log10(total + novel)

    answers = scratch.folder("answers")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, task, memo, asked = shared.value[0], TaskContext.get().partitionId(), _Memo(), _Counts()

        def rows() -> Iterator[pa.RecordBatch]:
            grams, _ = asked.take()
            for i in range(0, len(grams), 1 << 16):
                part = grams[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), task, np.int32)), pa.array(part.view(np.int64))], ["task", "gram"])

        def note(each: np.ndarray) -> np.ndarray:
            asked.add(each[near.find(each)[2]])
            return np.zeros(len(each))

        for batch in batches:
            raw = text_bytes(batch.column("text"))
            for first, last in slices(raw):
                memo.values_of(runs([normal(t) for t in raw[first:last]], depth)[0], note)
                if asked.size > _MERGE_AT:
                    asked.merge()
                    if asked.size > _MERGE_AT:
                        yield from rows()
        yield from rows()

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, length, _ = shared.value[0].find(batch.column("gram").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column("gram"), pa.array(length.astype(np.int32)), pa.array(logs)], ["gram", "length", "log"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, known, n_known = shared.value
        task, memo = TaskContext.get().partitionId(), _Memo()
        row = task << 36
        grams_asked, answered = _answers(answers, task) if near.rest is not None else (None, None)

        def find(each: np.ndarray) -> np.ndarray:
            logs, _, more = near.find(each)
            if more.any():
                at = np.searchsorted(grams_asked, each[more])
                if not len(grams_asked) or (grams_asked[np.minimum(at, len(grams_asked) - 1)] != each[more]).any():
                    raise RuntimeError("a task got other texts than when it asked for their runs; write the documents first")
                logs[more] = answered[at]
            return logs

        for batch in batches:
            ids, outs, raw = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), text_bytes(batch.column("text"))
            for first, last in slices(raw):
                texts = [normal(t) for t in raw[first:last]]
                many = len(texts)
                grams, symbols = runs(texts, depth)
                logs = memo.values_of(grams, find)
                ends = (symbols == _SPACE) | (symbols == END)
                spelled = np.diff(np.cumsum(logs)[ends], prepend=0.0)
                hashed = [np.append(words, END_TOKEN) for words in hashed_texts(texts)]
                sizes = np.array([len(words) for words in hashed])
                words, text = np.concatenate(hashed), np.repeat(np.arange(many), sizes)
                at = np.minimum(np.searchsorted(known, words), max(len(known) - 1, 0))
                found = known[at] == words if len(known) else np.zeros(len(words), bool)
                c = n_known[at[found]] if len(known) else np.empty(0)
                left = np.flatnonzero(~found)
                added = lambda x: np.bincount(text[found], x, many)  # noqa: E731, B023
                base = added(np.log10(c + 1)) - sizes * base_divisor
                score = added(np.log10(c + novel * 10 ** spelled[found])) - sizes * divisor
                here = np.bincount(text[found], minlength=many)
                told = [
                    {"doc_id": ids[first + i], "held_out": outs[first + i], "n_tokens": int(sizes[i]), "n_known": int(here[i]), "base": float(base[i]), "score": float(score[i])}
                    for i in range(many)
                ]
                rows = np.arange(row, row + many)
                row += many
                yield pa.RecordBatch.from_arrays([
                    # A row's own line is no word: it has no spelling, and goes by its row.
                    pa.array(np.concatenate([rows, rows[text[left]]])), pa.array(np.concatenate([rows, words[left].view(np.int64)])),
                    pa.array(np.concatenate([np.full(many, np.nan), spelled[left]]), from_pandas=True), pa.array(told + [None] * len(left), _TOLD),
                ], ["row", "token", "spelled", "told"])

    texts = whole_documents(documents, out.alias("held_out"))
    lines = map_batches(texts, work, SCORED)
    if rest is not None:
        asked = scratch.land(map_batches(texts, ask, "task int, gram long").distinct(), "asked")
        told = resolved(map_batches(asked.select("gram").distinct(), nearest, "gram long, length int, log double"), rest, scratch, depth)
        with modest(spark):
            asked.join(told, "gram").repartition("task").write.partitionBy("task").parquet(answers)
        scratch.drop(asked, told, model)
        lines = scratch.land(lines, "lines")
        scratch.delete(answers)
    rare = words.where(F.col("n") <= total / common_words)
    met = lines.join(rare, "token", "left").select(
        "row", "told", F.when(F.col("spelled").isNotNull(), F.coalesce("n", F.lit(0))).alias("n"), "spelled"
    ).select(
        "row", "told", (F.col("n") > 0).cast("long").alias("known"), F.log10(F.col("n") + 1).alias("base"),
        F.when(F.col("n") == 0, math.log10(novel) + F.col("spelled")).otherwise(F.log10(F.col("n") + novel * F.pow(F.lit(10.0), "spelled"))).alias("score"),
    )
    # One of a row's lines has what is told; the aggregate keeps that one.
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("known", "base", "score")]
    each = met.groupBy("row").agg(F.max("told").alias("told"), *sums)
    return each.select(
        "told.doc_id", "told.held_out", "told.n_tokens", (F.col("told.n_known") + F.col("known")).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("told.base") + F.col("base")).alias("base_score"),
        (F.col("told.score") + F.col("score")).alias("score"),
    )
