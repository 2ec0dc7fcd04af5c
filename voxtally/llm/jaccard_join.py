"""Exact Jaccard join of documents on word n-grams, for their connected groups.

Documents with equal sets are one class; a representative stands for it.  Tokens (n-grams) have one order everywhere, rare
ones first.  Two sets that are similar enough share a token among the first few of each (a prefix), and two tokens
if the prefixes are one token longer.  So

* light sets, those below a size boundary, enumerate the two-token subsets of their longer prefix, and meet where a
  whole subset is equal;
* heavy sets scan the inverted lists of their prefix tokens, which also hold the light sets near the boundary.

The boundary is the one of least estimated cost, from the sizes of all sets and the length of their lists.

Groups of near copies would give a number of pairs that grows with the square of the group.  Only groups are asked for, so
pairs are tried in rounds: first each set with its neighbour in size and with the smallest of each list, which connects
most of a group; then the nearest of other groups in each list, one pair for two groups; at last all pairs of each list
that are not connected yet, so no link between different groups is lost.  Size, parity bitmaps and shared
prefixes of the sets rule out pairs without looking at texts, and never a similar one.  What remains is compared token by token.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtally.llm.common import Scratch, different, map_batches, mix, shingled_texts, text_bytes, whole_documents
from voxtally.llm.components import components

#: Counters that find frequent tokens.  They only order tokens, so any number gives the same groups.
SLOT_BITS = 20
_BLOCK = 1 << 12
_ONE = np.uint64(1)
#: Cost of comparing a candidate, in written keys.
CANDIDATE_COST = 20
#: A set that meets another in fewer lists than this part of its size is not tried with it first.
FEW_MEETINGS = 60
#: Rounds that join groups by their nearest members before all pairs of different groups are tried.
JOINING_ROUNDS = 1
#: Size from which the narrow bitmaps rule out little, and the wider ones go into the last round's join.
WIDE_FROM = 300
#: Partners of a set whose wider bitmaps are looked at in a joining round.
LOOKED_AT = 8
#: Lists before a list that tell whether two sets have met there.
LISTS_BEFORE = 2
#: Words of 64 bits of the wider bitmaps, which are looked at once for each pair.
WIDE = 32
#: Largest size of a light set.
MOST_LIGHT = 64

PROFILE = "doc_id long, n long, digest binary, least long, block int, counts binary"
SIGNATURE = "doc_id long, n int, bits array<long>, wide array<long>, keys array<long>"


def _sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """The different n-grams of each text, as sorted hashes."""
    for shingles in shingled_texts([t.lower() for t in texts], k):
        yield different(shingles)


def prefix_length(n: int, percent: int) -> int:
    """Tokens of which one is shared with any similar set."""
    return n - -(-percent * n // 100) + 1


def _parities(values: np.ndarray, words: int) -> np.ndarray:
    """A bitmap of ``words`` 64-bit words in which every value flips one bit."""
    at = (values & np.uint64(64 * words - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=64 * words) & 1).astype(np.uint8)).view(np.int64)


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def profile(documents: DataFrame, k: int) -> DataFrame:
    """A row for each document - size, digest and least token of its set - and rows of partial token counters."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SLOT_BITS, np.int32)
        waiting: list[np.ndarray] = []

        def count() -> None:
            if waiting:
                np.add(slots, np.bincount(np.concatenate(waiting), minlength=1 << SLOT_BITS), out=slots, casting="unsafe")
                waiting.clear()

        for batch in batches:
            sizes, digests, least, many = [], [], [], 0
            for tokens in _sets(text_bytes(batch.column("text")), k):
                sizes.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                least.append(int(tokens[:1].view(np.int64)[0]) if len(tokens) else None)
                waiting.append(_slots(tokens))
                many += len(tokens)
                if many > 1 << SLOT_BITS:
                    count()
                    many = 0
            count()
            n = len(batch)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(least, pa.int64()), pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.binary()),
            ], _PROFILE_NAMES)
        for block, part in enumerate(slots.reshape(-1, _BLOCK)):
            if part.any():
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([block], pa.int32()),
                    pa.array([part.tobytes()], pa.binary()),
                ], _PROFILE_NAMES)

    return map_batches(whole_documents(documents), work, PROFILE)


_PROFILE_NAMES = ["doc_id", "n", "digest", "least", "block", "counts"]


def frequent_slots(profiled: DataFrame, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Counters that stand out, and their counts: at most as many as there are counters."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(counts, np.int32).astype(np.int64)
                sums[block] = sums[block] + part if block in sums else part
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(_BLOCK) + block * _BLOCK), pa.array(total)], ["slot", "n"])

    blocks = profiled.where("block is not null").select("block", "counts").repartition("block")
    totals = scratch.land(map_batches(blocks, add, "slot long, n long"), "slots")
    mean = totals.agg(F.avg("n")).first()[0] or 0.0
    standing_out = totals.where(F.col("n") > mean + 8 * mean**0.5 + 8).toArrow()
    scratch.drop(totals)
    return standing_out["slot"].to_numpy(), standing_out["n"].to_numpy()


def light_boundary(sizes: dict[int, int], list_length: float, percent: int) -> int:
    """The size from which sets are heavy, at least cost."""
    candidates = max(0.0, list_length - 1)

    def cost(boundary: int) -> float:
        total = 0.0
        for n, many in sizes.items():
            p = prefix_length(n, percent)
            if n < boundary:
                total += many * (p + 1) * p / 2
            if 100 * n >= percent * boundary:
                total += many * p * (1 + CANDIDATE_COST * candidates)
        return total

    return min(range(2, MOST_LIGHT + 2), key=cost)


def signatures(documents: DataFrame, k: int, percent: int, boundary: int, slots: np.ndarray, counts: np.ndarray) -> DataFrame:
    """Size, parity bitmaps and the keys of the lists a set is in: prefix tokens (of heavy sets and of light ones that may meet
    them), whose last bit is 0, and subsets (of light sets), whose last bit is 1.  Keys that fall together by chance only let
    more sets meet."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((slots, counts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << SLOT_BITS, np.int64)
        weights[shared.value[0]] = shared.value[1]
        for batch in batches:
            sizes, bits, wide, keys = [], [], [], []
            for tokens in _sets(text_bytes(batch.column("text")), k):
                n = len(tokens)
                p = prefix_length(n, percent)
                sizes.append(n)
                bits.append(_parities(tokens, 4))
                wide.append(_parities(tokens >> np.uint64(8), WIDE))
                weight = weights[_slots(tokens)]
                if weight.any():
                    tokens = tokens[np.argsort(weight, kind="stable")]
                own = [tokens[:p] >> _ONE << _ONE] if 100 * n >= percent * boundary else []
                if 2 <= n < boundary:
                    head = tokens[: p + 1]
                    i, j = np.triu_indices(len(head), 1)
                    low, high = np.minimum(head[i], head[j]), np.maximum(head[i], head[j])
                    own.append(mix(mix(low) * np.uint64(3) + high) | _ONE)
                keys.append(np.concatenate(own).view(np.int64) if own else [])
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int32()), *(pa.array(c, longs) for c in (bits, wide, keys))],
                ["doc_id", "n", "bits", "wide", "keys"],
            )

    return map_batches(whole_documents(documents), work, SIGNATURE)


def token_sets(documents: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``doc_id`` and ``tokens`` of the wanted documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t.view(np.int64) for t in _sets(text_bytes(batch.column("text")), k)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "tokens"])

    return map_batches(whole_documents(documents).join(wanted, "doc_id", "left_semi"), work, "doc_id long, tokens array<long>")


def _apart(x: str, y: str) -> str:
    return " + ".join(f"bit_count({x}.bits[{i}] ^ {y}.bits[{i}])" for i in range(4))


def _wide_apart(x: str, y: str) -> str:
    return f"aggregate(zip_with({x}.wide, {y}.wide, (p, q) -> bit_count(p ^ q)), 0, (s, c) -> s + c)"


def _most_apart(x: str, y: str, percent: int) -> str:
    """SQL: as many tokens in one of two sets only as their similarity allows."""
    return f"{x}.n + {y}.n - 2 * {_least_shared(x, y, percent)}"


def _may_be_similar(x: str, y: str, percent: int) -> str:
    """SQL: sizes and bitmaps allow the similarity.  Tokens in one set only flip a bit each, so the bitmaps differ in no more
    bits than there are such tokens."""
    return f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n) and {_apart(x, y)} <= {_most_apart(x, y, percent)}"


def _least_shared(x: str, y: str, percent: int) -> str:
    return f"(({percent} * ({x}.n + {y}.n) + {99 + percent}) div {100 + percent})"


def _not_ruled_out(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``, other columns) that the wider bitmaps allow, and in how many bits those differ (``apart``)."""
    wide = signed.select("doc_id", F.struct("n", "wide").alias("w"))
    return (
        pairs.join(wide.select(F.col("doc_id").alias("a"), F.col("w").alias("x")), "a")
        .join(wide.select(F.col("doc_id").alias("b"), F.col("w").alias("y")), "b")
        .withColumn("apart", F.expr(_wide_apart("x", "y")))
        .where(f"apart <= {_most_apart('x', 'y', percent)}").drop("x", "y")
    )


def _compare(pairs: DataFrame, documents: DataFrame, scratch: Scratch, k: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are similar."""
    pairs = scratch.land(pairs.select("a", "b"), "pairs")
    # A written table has a known size: texts stay where they are as long as the planner can broadcast the ids.
    wanted = scratch.land(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
    sets = scratch.land(token_sets(documents, wanted, k), "sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", F.size(F.array_intersect("x", "y")).alias("shared"), (F.size("x") + F.size("y")).alias("sizes"))
    found = scratch.land(both.where(f"100 * shared >= {percent} * (sizes - shared)").select("a", "b").distinct(), "links")
    scratch.drop(pairs, wanted, sets)
    return found


def meetings(lists: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) of different groups that meet in a list and that sizes and bitmaps allow.

    Two sets that share much meet in many lists.  A set's row in a list has the keys of the lists before it, and where two sets
    share one of those they have met there, so most pairs come once and none is missed.  Both sides of the join are one
    exchange: no condition is about one side alone.
    """
    # Rows of one id and size have the same bitmaps and group in all lists, and what is asked of a key goes by its kind.
    own = Window.partitionBy("doc_id", "n", F.expr("key % 2")).orderBy("key").rowsBetween(-LISTS_BEFORE, -1)
    lists = lists.withColumn("earlier", F.collect_list("key").over(own))
    return lists.alias("x").join(
        lists.alias("y"),
        F.expr(
            "x.key = y.key and x.root <> y.root and (x.n < y.n or (x.n = y.n and x.doc_id < y.doc_id))"
            f" and (x.key % 2 <> 0 or greatest(x.n, y.n) >= {boundary}) and {_may_be_similar('x', 'y', percent)}"
            f" and (x.wide is null or y.wide is null or {_wide_apart('x', 'y')} <= {_most_apart('x', 'y', percent)})"
            " and not arrays_overlap(x.earlier, y.earlier)"
        ),
    ).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))


def _sharing_enough(pairs: DataFrame, signed: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """The pairs without those of large sets that share too few prefix tokens.

    What two sets share is in both prefixes or behind the prefix that ends first."""
    pairs = scratch.land(pairs.select("a", "b"), "met")
    wanted = scratch.land(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
    tokens = F.when(F.col("n") >= WIDE_FROM, F.expr("filter(keys, key -> key % 2 = 0)")).alias("keys")
    prefixes = scratch.land(signed.join(wanted, "doc_id", "left_semi").select("doc_id", "n", tokens), "prefixes")
    behind = f"greatest(({percent} * x.n + 99) div 100, ({percent} * y.n + 99) div 100) - 1"
    rest = (
        pairs.join(prefixes.select(F.col("doc_id").alias("a"), F.struct("n", "keys").alias("x")), "a")
        .join(prefixes.select(F.col("doc_id").alias("b"), F.struct("n", "keys").alias("y")), "b")
        .where(f"x.keys is null or y.keys is null or size(array_intersect(x.keys, y.keys)) + {behind} >= {_least_shared('x', 'y', percent)}")
    )
    rest = scratch.land(rest.select("a", "b").distinct(), "rest")
    scratch.drop(pairs, wanted, prefixes)
    return rest


def groups(documents: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` - the smallest id reachable by links - of every row.

    Words are runs of other than ASCII white space with A-Z in lower case; a text of fewer than ``k`` is one n-gram.  Null and
    empty texts have no n-gram and no link, and are alone.  Rows that repeat an id are one node with several sets; rows without
    an id are linked with nothing, but one whose set a document with an id has too is in its group.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "jaccard_join")
    profiled = scratch.land(profile(documents, k), "profile")
    rows = profiled.where("block is null")
    classes = rows.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("representative"), F.first("n").alias("n"), F.first("least").alias("least"))
    alone = scratch.land(classes.where("representative is not null").select("representative", "n", "least"), "classes")
    small = alone.where(f"n <= {MOST_LIGHT}")
    sizes = {r.n: r.many for r in small.groupBy("n").agg(F.count(F.lit(1)).alias("many")).collect()}
    many, different = small.agg(F.count(F.lit(1)), F.approx_count_distinct("least")).first()
    boundary = light_boundary(sizes, many / max(1, different), percent)
    slots, counts = frequent_slots(profiled, scratch)
    own = alone.select(F.col("representative").alias("doc_id"))
    signed = scratch.land(signatures(documents, k, percent, boundary, slots, counts).join(own, "doc_id", "left_semi"), "signatures")

    keyed = signed.select("doc_id", "n", F.explode("keys").alias("key"))
    same_list = Window.partitionBy("key")
    ordered = same_list.orderBy("n", "doc_id")
    lists = keyed.select(
        "key", "doc_id", "n", F.lag("doc_id").over(ordered).alias("previous"), F.first("doc_id").over(ordered).alias("smallest"), F.lead("doc_id").over(ordered).alias("following"),
    ).where("previous is not null or following is not null")
    lists = scratch.land(lists.drop("following"), "lists")
    bitmaps = signed.select("doc_id", "n", "bits")
    tokens_or_heavy = f"key % 2 <> 0 or n >= {boundary}"

    def nearest(tried: DataFrame, fewest: str, most: int) -> DataFrame:
        """The likeliest partners of each set by the narrow bitmaps.  Which pairs are tried first is free to choose."""
        near = (
            tried.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.first("groups").alias("groups"))
            .join(bitmaps.select(F.col("doc_id").alias("a"), F.struct("n", "bits").alias("x")), "a")
            .join(bitmaps.select(F.col("doc_id").alias("b"), F.struct("n", "bits").alias("y")), "b")
            .where(f"{fewest} and {_may_be_similar('x', 'y', percent)}")
            .select("a", "b", "groups", F.expr(_apart("x", "y")).alias("apart"))
        )
        likeliest = Window.partitionBy("b").orderBy("apart", "a")
        return near.withColumn("place", F.row_number().over(likeliest)).where(f"place <= {most}").drop("apart", "place")

    # First round: neighbours and the smallest.
    tried = lists.where(tokens_or_heavy).select(F.col("doc_id").alias("b"), F.explode(F.array_distinct(F.array("previous", "smallest"))).alias("a"), F.lit(None).cast("array<long>").alias("groups"))
    often = f"(y.n < {boundary} or {FEW_MEETINGS} * met >= y.n)"
    first = _not_ruled_out(nearest(tried.where("a is not null and a <> b"), often, 2), signed, percent)
    joined = scratch.land(components(_compare(first, documents, scratch, k, percent), scratch), "components")

    def still_open(before: DataFrame) -> DataFrame:
        """Lists that hold different groups."""
        placed = before.select("key", "doc_id", "n").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
        return placed.withColumn("low", F.min("root").over(same_list)).withColumn("high", F.max("root").over(same_list)).where("low < high").drop("low", "high")

    def nearest_others(lists: DataFrame) -> DataFrame:
        """``other`` is the nearest smaller set of another group in a list, ``smallest`` the list's first one."""
        member = F.struct("doc_id", "root")
        ranked = lists.withColumn("previous", F.lag(member).over(ordered)).withColumn("smallest", F.first(member).over(ordered))
        change = F.expr("case when previous.root <> root then previous end")
        return ranked.withColumn("other", F.last(change, ignorenulls=True).over(ordered))

    # Joining rounds: for two groups that meet, the likeliest pair.
    open_lists = scratch.land(still_open(lists), "open_lists")
    scratch.drop(lists)
    for _ in range(JOINING_ROUNDS):
        tried = (
            nearest_others(open_lists).where(tokens_or_heavy)
            .select("root", F.col("doc_id").alias("b"), F.explode(F.array_distinct(F.array("other", "smallest"))).alias("other"))
            .where("other.root <> root")
            .select("b", F.col("other.doc_id").alias("a"), F.array_sort(F.array("root", "other.root")).alias("groups"))
        )
        closest = Window.partitionBy("b").orderBy("apart", "a")
        allowed = _not_ruled_out(nearest(tried, "true", LOOKED_AT), signed, percent)
        own = allowed.withColumn("place", F.row_number().over(closest)).where("place <= 2")
        likeliest = own.groupBy("groups").agg(F.min(F.struct("apart", "a", "b")).alias("pair")).select("pair.a", "pair.b")
        found = _compare(likeliest, documents, scratch, k, percent)
        joined = scratch.land(components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(found), scratch), "components")
        before, open_lists = open_lists, scratch.land(still_open(open_lists), "open_lists")
        scratch.drop(before)

    # Last round: whatever a list holds of different groups.
    large = F.when(F.col("n") >= WIDE_FROM, F.col("wide")).alias("wide")
    before, open_lists = open_lists, open_lists.join(signed.select("doc_id", "bits", large), "doc_id")
    rest = meetings(open_lists, boundary, percent).distinct()
    rest = _sharing_enough(_not_ruled_out(rest, signed, percent), signed, scratch, percent)
    last = _compare(rest, documents, scratch, k, percent)
    final = components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(last), scratch)

    members = rows.select("doc_id", "n", "digest").join(classes.select("digest", "representative"), "digest", "left")
    named = members.join(final.withColumnRenamed("node", "representative"), "representative", "left")
    result = scratch.land(named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "representative", "doc_id").alias("component_id")), "groups")
    scratch.drop(signed, before, rest)
    return result


def one_of_each(documents: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """The documents, all columns, without those that are linked, over any number of others, with one of a smaller id.

    Rows without an id, and rows that repeat the id of one that stays, stay.
    """
    others = groups(documents, k, percent).where("component_id <> doc_id").select(F.col("doc_id").alias("_other")).distinct()
    return documents.join(others, documents["doc_id"].cast("long") == others["_other"], "left_anti")
