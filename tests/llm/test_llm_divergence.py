"""Source divergence against brute force."""

import collections
import random
import re

import numpy as np
import pytest

from voxtally.llm import divergence

ROWS = "lang string, source string, text string, item string, value long, rank int, doc_id long"


def brute(rows, least=3, most=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for _, _, t in rows]
    docs, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    for (lang, source, _), found in zip(rows, words):
        docs.update((lang, w) for w in set(found))
        counts[lang, source].update(found)
    out = []
    for lang in {r[0] for r in rows}:
        kept = [w for (x, w), n in docs.items() if x == lang and n >= least]
        groups = {s: counts[x, s] for x, s in {r[:2] for r in rows} if x == lang}
        groups[None] = sum(groups.values(), collections.Counter())

        def shares(count):
            whole = sum(count[w] for w in kept) + len(kept)
            return {w: 1 + 10**9 * (count[w] + 1) // whole for w in kept}

        share = {s: shares(c) for s, c in groups.items()}
        for s in groups.keys() - {None}:
            pairs = [(-sum((share[s][w] - share[t][w]) ** 2 // share[t][w] for w in kept), t.encode()) for t in groups if t not in (None, s)]
            terms = [(-((share[s][w] - share[None][w]) ** 2 // share[None][w]), w.encode()) for w in kept if groups[s][w] and share[s][w] > share[None][w]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, most)):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(sorted(found)[:limit], 1)]
    return sorted(out)


def audited(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash", 7, 7, 1) for r in rows], ROWS)
    got = divergence.audit(df, **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("first_level, map_bits, gathered", [(1, 1 << 20, 1 << 21), (4, 64, 4), (3, 1 << 10, 50)])
def test_audit_equals_brute_force(spark, documents, monkeypatch, first_level, map_bits, gathered):
    monkeypatch.setattr(divergence, "GATHERED", gathered)
    monkeypatch.setattr(divergence, "CELLS", 40)
    pick = random.Random(2)
    vocabulary = ["".join(pick.choice("abcé日Z") for _ in range(pick.choice([1, 2, 3, 4, 5, 8, 9, 17, 33]))) for _ in range(120)]
    rows = [(pick.choice(["en", "de", None]), pick.choice(["a", "b", "c", "é", "z", None]),
             " ".join(pick.choice(vocabulary[: pick.choice([5, 40, 120])]) + pick.choice(["", "-", "1", "`"]) for _ in range(pick.randrange(30)))) for _ in range(90)]
    rows += rows[:9] + [("en", "empty", None), ("en", "blank", " 12 "), ("fr", "only", "two two"), ("it", "x", ""), ("it", "y", "rare"), ("en", "a", "x" * 5000), ("en", "b", "x" * 4999 + "y")]
    assert audited(spark, rows, first_level=first_level, map_bits=map_bits) == brute(rows)


def test_audit_of_odd_tables(spark, documents):
    assert audited(spark, []) == [] and audited(spark, [(None, None, None)]) == []
    rows = [("en", s, "same text again") for s in "abc"]
    assert audited(spark, rows) == brute(rows) and all(r[4] == 0 for r in brute(rows))


def test_prefixes_count_documents_and_not_terms(spark, documents):
    terms = divergence.document_terms(spark.createDataFrame([("en", "a", "abcd abce abcf xy"), ("en", "b", "abcz xy")], "lang string, source string, text string"))
    counts = sorted(r.docs for r in divergence.prefix_documents(terms, 0, 3, None).groupBy("key").agg({"docs": "sum"}).withColumnRenamed("sum(docs)", "docs").collect())
    assert counts == [2, 2]
    few = divergence.kept_map(terms, 2, 1 << 12, 2)
    assert sum(int(x).bit_count() for x in few) == 1  # only "xy" is complete in two documents


def test_share_needs_no_more_than_64_bits(spark):
    numbers = [(n, w) for n in (0, 1, 7, 10**9, 2 * 10**14) for w in (1, 3, 10**6 + 1, 2 * 10**14 + 5) if n < w]
    rows = spark.createDataFrame(numbers, "n long, w long").selectExpr("n", "w", f"{divergence.share('n', 'w')} AS p").collect()
    assert all(r.p == 1 + 10**9 * (r.n + 1) // r.w for r in rows)
    assert np.iinfo(np.int64).max > 32_000 * (2 * 10**14 + 6)
