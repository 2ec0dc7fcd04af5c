"""Which sources of a language use words differently: kept terms by iceberg prefix refinement, then shares by source.

Most different terms of a corpus are rare, and none of them counts.  They are discarded by their beginnings: level by
level, the documents that hold a byte prefix are counted for the prefixes whose own prefix was still in enough
documents, and a prefix in too few is not extended any further.  A term that ends inside a level's length is complete
there, and its own count decides.  Each level reads the terms of every document from one written table; what it knows of
the level before is a map of fixed size with a bit for each hash, so a discarded prefix may rarely be followed further,
and a kept one never is lost.  Complete terms that are left are grouped by themselves and counted exactly.

All arithmetic is in whole numbers.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtally.llm.common import Scratch, map_batches, mix, modest

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Bits of the map of prefixes that are still followed; a power of two.
MAP_BITS = 1 << 27
#: Length of the first prefixes in bytes; each level doubles it.
FIRST_LEVEL = 4
#: Bytes of terms that are looked at together, and entries a task gathers before it sends on what it has added up.
PIECE, GATHERED = 1 << 21, 1 << 19
#: Entries of one matrix of shares.
CELLS = 1 << 19
#: Shares are counted in parts of so many.
PARTS = 1_000_000_000

_SEED = np.uint64(0x9E3779B97F4A7C15)


# --- the terms of each document ------------------------------------------------------------------------------------


def _named(documents: DataFrame) -> list[F.Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source") if c in documents.columns]


TERMS = "lang string, source string, terms binary, counts binary"


def document_terms(documents: DataFrame) -> DataFrame:
    """``lang``, ``source`` and the different ``terms`` of each whole text in byte order, each ended by a zero byte, with their
    occurrences in ``counts`` (64 bits each); texts without terms are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            terms: list[bytes] = []
            counts: list[bytes] = []
            for i, text in enumerate(batch.column("text")):
                found = Counter(TERM.findall((text.as_py() or "").encode().lower()))
                if found:
                    names = sorted(found)
                    at.append(i)
                    terms.append(b"\0".join(names) + b"\0")
                    counts.append(np.array([found[t] for t in names], "<i8").tobytes())
            of = batch.select(["lang", "source"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], ["lang", "source", "terms", "counts"])

    texts = documents.select(*_named(documents), F.col("text").cast("string").alias("text")).where("text <> ''")
    return map_batches(texts, work, TERMS)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of documents in pieces of about ``PIECE`` bytes of terms; a longer document goes alone."""
    for batch in batches:
        ends = np.cumsum([len(x) for x in _spans(batch.column("terms"))])
        first = 0
        while first < len(batch):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PIECE, side="right")))
            yield batch.slice(first, last - first)
            first = last


def _spans(column: pa.BinaryArray) -> list[range]:
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].tolist() if len(column) else [0]
    return [range(a, b) for a, b in zip(ends, ends[1:])]


class Terms:
    """All terms of a piece: their bytes, places, lengths, documents, and a seed for each language."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        column = batch.column("terms")
        spans = _spans(column)
        first, end = spans[0].start, spans[-1].stop
        self.raw = column.buffers()[2].slice(first, end - first).to_pybytes() + bytes(8)
        self.words = np.ndarray((len(self.raw) - 7,), "<u8", self.raw, strides=(1,))  # the eight bytes from each place on
        ends = np.flatnonzero(np.frombuffer(self.raw, np.uint8, end - first) == 0)
        self.starts = np.concatenate([[0], ends[:-1] + 1])
        self.lengths = ends - self.starts
        self.doc = np.searchsorted([s.stop - first for s in spans], self.starts, side="right")
        langs = batch.column("lang").to_pylist()
        seeds = {lang: int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little") for lang in set(langs)}
        self.seed = np.array([seeds[x] for x in langs], np.uint64)

    def named(self) -> pa.BinaryArray:
        """The terms with their end marks."""
        offsets = np.append(self.starts, len(self.raw) - 8).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(self.raw)])

    def keys(self, rows: np.ndarray, upto: int | None = None) -> np.ndarray:
        """Hash of each term's first ``upto`` bytes, the end mark counted as one; the last bit is set where the end is among them."""
        key, length, start = self.seed[self.doc[rows]], self.lengths[rows], self.starts[rows]
        marked = length + 1 if upto is None else np.minimum(length + 1, upto)
        at, place = None, 0
        while True:
            here = np.minimum(marked if at is None else marked[at] - place, 8)
            word = self.words[(start if at is None else start[at]) + place] & _LOW_BYTES[here]
            word += _SEED * here.astype(np.uint64)
            if at is None:
                key = mix(key ^ mix(word))
                at = np.flatnonzero(marked > 8)
            else:
                key[at] = mix(key[at] ^ mix(word))
                at = at[marked[at] > place + 8]
            place += 8
            if not len(at):
                return key & ~np.uint64(1) | (marked > length).astype(np.uint64)


_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys >> np.uint64(1)) & np.uint64(64 * len(bits) - 1)
    return bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1


# --- the levels -----------------------------------------------------------------------------------------------------


def prefix_documents(terms: DataFrame, before: int, length: int, alive: np.ndarray | None) -> DataFrame:
    """``key`` and ``docs`` of prefixes of ``length`` bytes: how many documents hold one, as far as a task has added them up.

    ``alive`` maps the prefixes of ``before`` bytes that are followed; terms that were complete there are not counted again.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in _pieces(batches):
            of = Terms(batch)
            rows = np.flatnonzero(of.lengths >= before)
            if alive is not None and len(rows):
                rows = rows[_in_map(alive, of.keys(rows, before))]
            if not len(rows):
                continue
            keys, doc = of.keys(rows, length), of.doc[rows]
            new = np.ones(len(rows), bool)  # terms are in byte order, so equal prefixes of a document stand together
            new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
            held.append(np.unique(keys[new], return_counts=True))
            size += len(held[-1][0])
            if size > GATHERED:
                held = [_added(held)]
                size = len(held[0][0])
                if size > GATHERED // 2:
                    yield _key_batch(held[0])
                    held, size = [], 0
        if held:
            yield _key_batch(_added(held))

    return map_batches(terms.select("lang", "terms"), work, "key long, docs long")


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in held])).astype(np.int64)


def _key_batch(added: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(added[0].view(np.int64)), pa.array(added[1].astype(np.int64))], ["key", "docs"])


def kept_map(terms: DataFrame, least: int, map_bits: int = MAP_BITS, first_level: int = FIRST_LEVEL) -> np.ndarray:
    """A bit for the hash of each complete term in ``least`` documents of its language, found prefix by prefix."""
    kept = np.zeros(map_bits // 64, np.uint64)
    alive, before, length = None, 0, first_level
    while True:
        counted = prefix_documents(terms, before, length, alive).groupBy("key").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
        place = F.pmod(F.shiftrightunsigned("key", 1), F.lit(map_bits))
        bit = F.expr("shiftleft(1L, int(place % 64))")
        with modest(terms.sparkSession):
            words = (counted.select((F.col("key") % 2 != 0).alias("complete"), place.alias("place"))
                     .groupBy("complete", F.expr("place div 64").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow())
        complete, word, bits = (words.column(c).to_numpy() for c in ("complete", "word", "bits"))
        kept[word[complete]] |= bits[complete].view(np.uint64)
        if complete.all():
            return kept
        alive = np.zeros(map_bits // 64, np.uint64)
        alive[word[~complete]] = bits[~complete].view(np.uint64)
        before, length = length, 2 * length


def kept_counts(terms: DataFrame, kept: np.ndarray, least: int) -> DataFrame:
    """``lang``, ``source``, ``term``, its occurrences ``n`` there and ``total`` in the language, for terms in ``least`` documents of the language.

    Each term and language has one row with ``leads``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in _pieces(batches):
            of = Terms(batch)
            rows = np.flatnonzero(_in_map(kept, of.keys(np.arange(len(of.lengths)))))
            doc = pa.array(of.doc[rows])
            counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<i8")
            held.append(_grouped([pa.table({
                "lang": batch.column("lang").take(doc), "source": batch.column("source").take(doc), "term": of.named().take(pa.array(rows)),
                "docs": pa.array(np.ones(len(rows), np.int64)), "n": pa.array(counts[rows])})]))
            size += len(held[-1])
            if size > GATHERED:
                held = [_grouped(held)]
                size = len(held[0])
                if size > GATHERED // 2:
                    yield from _text_batches(held)
                    held, size = [], 0
        if held:
            yield from _text_batches([_grouped(held)])

    found = map_batches(terms, work, "lang string, source string, term string, docs long, n long")
    # One shuffle: counts by source and by language need a term's rows of a language in one place.
    by_source = found.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    whole = Window.partitionBy("lang", "term")
    return by_source.select(
        "lang", "source", "term", "n", F.sum("n").over(whole).alias("total"), F.sum("docs").over(whole).alias("docs"),
        (F.min("source").over(whole) == F.col("source")).alias("leads"),
    ).where(F.col("docs") >= least).drop("docs")


def _grouped(tables: list[pa.Table]) -> pa.Table:
    names = ["lang", "source", "term"]
    table = pa.concat_tables(tables).group_by(names, use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
    return table.rename_columns({"docs_sum": "docs", "n_sum": "n"}).select([*names, "docs", "n"])


def _text_batches(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    for table in tables:
        place = table.schema.get_field_index("term")
        names = pc.binary_slice(table.column("term"), 0, -1).cast(pa.string())
        yield from table.set_column(place, "term", names).to_batches(max_chunksize=1 << 16)


# --- shares and how they differ ---------------------------------------------------------------------------------------


def share(count: str, whole: str) -> str:
    """``1 + floor(PARTS * (count + 1) / whole)``, by long division in two steps so that no product leaves 64 bits."""
    high, low = 31_250, PARTS // 31_250
    top = f"(({count} + 1) * {low}L)"
    return f"(1L + ({top} div {whole}) * {high}L + ((({top} % {whole}) * {high}L) div {whole}))"


def differing(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def source_groups(documents: DataFrame, counts: DataFrame) -> DataFrame:
    """Every occurring language and source, numbered in ``place`` within the language, with its ``whole``, the language's
    ``lang_whole`` and the share ``base`` of a kept term that it lacks; the three are null without kept terms."""
    groups = documents.select(*_named(documents)).distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if("leads").alias("terms"))
    joined = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return joined.select("lang", "source", place.alias("place"), (F.coalesce("own", F.lit(0)) + F.col("terms")).alias("whole"),
                         (F.col("lang_n") + F.col("terms")).alias("lang_whole")).withColumn("base", F.expr(share("0L", "whole")))


def pair_sums(shares: DataFrame, groups: DataFrame, parts: int) -> DataFrame:
    """``lang``, ``p_place``, ``q_place`` and the ``value`` of a pair of sources: the difference summed over all kept terms.

    Terms are dealt out to ``parts``; each gets the shares of absent terms too, ahead of the terms.  A task then works on
    matrices of terms by sources of bounded size, and adds up pairs before they are sent on.
    """
    dealt = shares.select(F.pmod(F.xxhash64("lang", "term"), F.lit(parts)).alias("part"), "lang", "term", "place", F.col("p").alias("value"))
    bases = groups.where("whole IS NOT NULL").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "lang", F.lit(None).cast("string").alias("term"), "place", F.col("base").alias("value"))
    rows = bases.unionByName(dealt).repartition(parts, "part").sortWithinPartitions("part", "lang", F.asc_nulls_first("term"), "place")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            yield from block.feed(batch)
        yield from block.end()

    return map_batches(rows, work, "lang string, p_place int, q_place int, value long").groupBy("lang", "p_place", "q_place").agg(F.sum("value").alias("value"))


class _Block:
    """Rows sorted by part, language and term to sums of differences between sources."""

    def __init__(self) -> None:
        self.group: tuple[int, str] | None = None
        self.base: list[int] = []
        self.term: str | None = None
        self.rows = 0  # terms in the matrix
        self.filled: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.sums: np.ndarray | None = None

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        part = batch.column("part").to_numpy()
        lang = batch.column("lang").dictionary_encode()
        term = batch.column("term").dictionary_encode()
        langs, codes = lang.indices.to_numpy(), term.indices.fill_null(-1).to_numpy()
        place, value = batch.column("place").to_numpy(), batch.column("value").to_numpy()
        edges = np.flatnonzero((np.diff(part) != 0) | (np.diff(langs) != 0)) + 1
        for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(part)]):
            if begin == end:
                continue
            group = int(part[begin]), lang.dictionary[int(langs[begin])].as_py()
            if group != self.group:
                yield from self.end()
                self.group = group
            own = codes[begin:end]
            n_base = int((own < 0).sum())
            self.base += value[begin : begin + n_base].tolist()
            begin += n_base
            while begin < end:  # as many terms as a matrix has room for
                own = codes[begin:end]
                new = np.concatenate([[term.dictionary[int(own[0])].as_py() != self.term], own[1:] != own[:-1]])
                number = self.rows - 1 + np.cumsum(new)
                room = max(1, CELLS // max(1, len(self.base)))
                fits = int(np.searchsorted(number, room))
                if not fits:
                    yield from self.add()
                    continue
                self.filled.append((number[:fits], place[begin : begin + fits], value[begin : begin + fits]))
                self.rows = int(number[fits - 1]) + 1
                begin += fits
                self.term = term.dictionary[int(codes[begin - 1])].as_py()

    def add(self) -> Iterator[pa.RecordBatch]:
        """Differences of the terms held; a term goes on in the next matrix only if it ends with this one."""
        wide = len(self.base)
        if self.rows:
            shares = np.tile(np.array(self.base, np.int64), (self.rows, 1))
            for number, place, value in self.filled:
                shares[number, place] = value
            small = wide * wide <= CELLS
            if small and self.sums is None:
                self.sums = np.zeros((wide, wide), np.int64)
            for q in range(wide):
                by = shares[:, q : q + 1]
                away = shares - by
                away *= away
                away //= by
                sums = away.sum(axis=0)
                if small:
                    self.sums[q] += sums
                else:
                    yield self.told(np.full(wide, q), np.arange(wide), sums)
        self.rows, self.filled, self.term = 0, [], None

    def told(self, q: np.ndarray, p: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([self.group[1]] * len(q)), pa.array(p.astype(np.int32)), pa.array(q.astype(np.int32)), pa.array(sums)], ["lang", "p_place", "q_place", "value"])

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.add()
        if self.sums is not None:
            q, p = np.nonzero(self.sums)
            yield self.told(q, p, self.sums[q, p])
        self.base, self.sums, self.group = [], None, None


def audit(documents: DataFrame, least_documents: int = 3, most_terms: int = 200, map_bits: int = MAP_BITS, first_level: int = FIRST_LEVEL) -> DataFrame:
    """How the sources of each language differ: ``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Kept are the terms in ``least_documents`` documents of a language; every row is a document of its own, so
    repeated rows count, and ids are not looked at.  ``pair`` rows name each other source of the language with the difference
    summed over all kept terms; ``term`` rows the first ``most_terms`` terms that a source uses more than its language does.
    Null text, lang and source are empty ones; a group without terms has its ``pair`` rows, and an empty table no row.
    """
    scratch = Scratch(documents.sparkSession, "divergence")
    terms = scratch.land(document_terms(documents), "terms")
    kept = kept_map(terms, least_documents, map_bits, first_level)
    counts = scratch.land(kept_counts(terms, kept, least_documents), "counts")
    scratch.drop(terms)
    groups = scratch.land(source_groups(documents, counts), "groups")
    shares = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "place", F.expr(share("n", "whole")).alias("p"), F.expr(share("total", "lang_whole")).alias("q"))
    group = Window.partitionBy("lang", "source")
    more = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(differing("p", "q")).alias("value"))
    leading = more.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item"))).where(F.col("rank") <= most_terms)

    parts = max(documents.sparkSession.sparkContext.defaultParallelism, -(-counts.count() // 500_000))
    sums = pair_sums(shares, groups, parts)
    one = groups.select("lang", "source", F.col("place").alias("p_place"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("q_place"))
    pairs = one.join(other, "lang").where("p_place <> q_place").join(sums, ["lang", "p_place", "q_place"], "left")
    ranked = pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")).withColumn(
        "rank", F.row_number().over(group.orderBy(F.desc("value"), "item")))

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    result = scratch.land(part(ranked, "pair").unionByName(part(leading, "term")), "audit")
    scratch.drop(counts, groups)
    return result
