"""Benchmark decontamination: which documents contain a test item.

An item is contained in a document when at least ``least`` of its different word shingles occur there, wherever.  Of
an item with n shingles at most ``n - ceil(least * n)`` may lack, so one of any larger number of its shingles must occur.
Each item is represented by that many of its smallest hashes, its MinHash sketch; the number follows
from the item's size.  Sketches are laid out by classes of like size, and items are looked for in documents that are large
enough for them.  A document that shares no hash with an item's sketch cannot contain the item, so unlike a sketch of
fixed length this one loses nothing; candidates are then compared shingle by shingle, as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.common import Scratch

WORDS_A_SHINGLE = 5
LEAST = 0.8


def _words(text: str) -> str:
    """SQL for the letter and digit runs of a text, in lower case."""
    return rf"filter(split(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), w -> w <> '')"


def _text_hashes(words: str, k: int) -> str:
    """SQL for the hashes of a text's runs of ``k`` words, repeats included; a shorter text has none."""
    parts = ", ".join(f"get({words}, i + {j})" for j in range(k))
    return f"if(size({words}) >= {k}, transform(sequence(0, size({words}) - {k}), i -> xxhash64({parts})), cast(array() as array<bigint>))"


def _shingles(words: str, k: str) -> str:
    """SQL for the different runs of ``k`` words as text."""
    return f"array_distinct(if(size({words}) >= {k}, transform(sequence(1, size({words}) - {k} + 1), i -> array_join(slice({words}, i, {k}), ' ')), cast(array() as array<string>)))"


def _need(n: str, least: float) -> str:
    """SQL for how many of ``n`` shingles have to occur."""
    return f"int(ceil({n} * {least!r}D - 1e-9))"


def items_of(benchmark: DataFrame, scratch: Scratch, least: float = LEAST, k: int = WORDS_A_SHINGLE) -> DataFrame:
    """Test items with a key of their own, their different shingles, and how many of these a document needs.

    An item of fewer than ``k`` words is one shingle of its own length ``k``; one without words is left out.
    """
    worded = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.expr(_words("cast(text as string)")).alias("words"))
    keyed = worded.where("size(words) > 0").select(F.monotonically_increasing_id().alias("item"), "item_id", "words", F.expr(f"least(size(words), {k})").alias("k"))
    hashes = " ".join(f"when {j} then {_text_hashes('words', j)}" for j in range(1, k + 1))
    cut = keyed.select("item", "item_id", "k", F.expr(_shingles("words", "k")).alias("shingles"), F.expr(f"array_sort(array_distinct(case k {hashes} end))").alias("hashes"))
    sized = cut.select("item", "item_id", "k", F.size("shingles").alias("n"), F.expr(_need("size(shingles)", least)).alias("need"), "shingles", "hashes")
    return scratch.land(sized, "items")


def sketches(items: DataFrame) -> DataFrame:
    """``hash``, ``item``, ``size_class`` and ``need``: the sketch of each item; its length grows with the item."""
    # Outer, here and below: the filter that a plain explode implies would be pushed below the words, and then split
    # the text again for every shingle.
    return items.select(
        "item", F.floor(F.log2("n")).cast("int").alias("size_class"), "need", F.explode_outer(F.expr("slice(hashes, 1, n - need + 1)")).alias("hash")
    ).where("hash is not null")


def _digest(text: str) -> str:
    return f"unhex(sha2(coalesce({text}, ''), 256))"


def found_texts(documents: DataFrame, benchmark: DataFrame, scratch: Scratch, least: float = LEAST, k: int = WORDS_A_SHINGLE) -> DataFrame:
    """``doc_id``, ``digest`` of the text, and ``item_id``, ``n`` and ``shared`` of each item in it, for every row with one.

    A text is looked at by itself, so equal texts are one: what is found goes by digest, whatever ids the rows have.
    Candidates are texts that share a hash with an item's sketch and are large enough for its size; each different
    candidate text is cut into shingles once and compared with its items' as text.
    """
    items = items_of(benchmark, scratch, least, k)
    sketch = scratch.land(sketches(items).repartitionByRange("size_class", "hash"), "sketches")
    # No hash of a document above the largest of any sketch can meet one.
    largest, lengths = sketch.agg(F.max("hash")).first()[0], [r.k for r in items.select("k").distinct().collect()]
    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    worded = given.select("doc_id", F.expr(_digest("text")).alias("digest"), F.expr(_words("text")).alias("words"))
    runs = ", ".join(_text_hashes("words", length) for length in lengths) or "cast(array() as array<bigint>)"
    hashed = worded.select("doc_id", "digest", F.expr(f"concat({runs})").alias("hashes")).select(
        "doc_id", "digest", F.size("hashes").alias("size"), F.explode_outer(F.filter("hashes", lambda h: h <= F.lit(largest).cast("long"))).alias("hash")
    )
    met = hashed.join(sketch, "hash").where("size >= need").select("doc_id", "digest", "item").distinct()
    candidates = scratch.land(met, "candidates")
    pairs = candidates.select("digest", "item").distinct()
    wanted = scratch.land(pairs.groupBy("digest").agg(F.collect_list("item").alias("items")), "wanted")
    texts = given.select(F.expr(_digest("text")).alias("digest"), "text").join(wanted.select("digest"), "digest", "left_semi")
    once = texts.groupBy("digest").agg(F.first("text").alias("text")).join(wanted, "digest")
    cut = [F.expr(_shingles("words", str(length))) for length in lengths] or [F.array().cast("array<string>")]
    shingled = once.select("digest", "items", F.expr(_words("text")).alias("words")).select("digest", "items", F.concat(*cut).alias("shingles"))
    # Landed: texts are cut before they are dealt out to their items.
    each = scratch.land(shingled, "shingles").select("digest", "shingles", F.explode("items").alias("item"))
    compared = each.join(items.drop("hashes").withColumnRenamed("shingles", "own"), "item").select(
        "digest", "item", "item_id", "n", "need", F.size(F.array_intersect("own", "shingles")).alias("shared"))
    enough = scratch.land(compared.where("shared >= need").drop("need"), "found")
    found = scratch.land(candidates.join(enough, ["digest", "item"]).select("doc_id", "digest", "item_id", "n", "shared"), "leaks")
    scratch.drop(items, sketch, candidates, wanted, enough)
    return found


def contained_items(documents: DataFrame, benchmark: DataFrame, least: float = LEAST, k: int = WORDS_A_SHINGLE) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_item_shingles``, ``n_shared`` and ``containment`` of every document that contains an item.

    Null and empty texts, of either side, contain and are contained in nothing.  An item of fewer than ``k`` words is
    contained where its words follow each other.  Rows that repeat an id count as one with the best containment, and so do
    items; rows without an id are one document without an id, and items alike.
    """
    found = found_texts(documents, benchmark, Scratch(documents.sparkSession, "decontaminate"), least, k)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("shared") / F.col("n"), "n", "shared")).alias("best"))
    return best.select(
        "doc_id", "item_id", F.col("best.n").cast("long").alias("n_item_shingles"), F.col("best.shared").cast("long").alias("n_shared"),
        F.col("best.col1").alias("containment"),
    )


def contaminated(documents: DataFrame, benchmark: DataFrame, least: float = LEAST, k: int = WORDS_A_SHINGLE) -> DataFrame:
    """The ids of documents that contain an item."""
    return contained_items(documents, benchmark, least, k).select("doc_id").distinct()


def clean(documents: DataFrame, benchmark: DataFrame, least: float = LEAST, k: int = WORDS_A_SHINGLE) -> DataFrame:
    """The documents, all columns, that contain no item.  Texts decide, so ids may be null or repeated."""
    leaks = found_texts(documents, benchmark, Scratch(documents.sparkSession, "decontaminate"), least, k).select(F.col("digest").alias("_digest")).distinct()
    return documents.join(leaks, F.expr(_digest("cast(text as string)")) == leaks["_digest"], "left_anti")
