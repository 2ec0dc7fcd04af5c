"""Operators over whole tables, against brute force."""

import base64
import collections
import gzip
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from voxtally.llm import components, decontaminate, jaccard_join, page_text, suffix_tree, warc
from voxtally.llm.common import Scratch

from . import automaton
from .conftest import ODD


def grams(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_groups(texts):
    sets = [grams(t, 4) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 85 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    return {i: (len(s), r) for i, (s, r) in enumerate(zip(sets, root))}


@pytest.mark.parametrize("boundary", [2, 20, 65])
def test_groups_equal_brute_force(documents, monkeypatch, boundary):
    monkeypatch.setattr(jaccard_join, "light_boundary", lambda *a: boundary)
    pick = random.Random(7)
    texts = list(ODD)
    for length in (6, 9, 12, 20, 40, 90, 200):
        base = [f"w{pick.randrange(2000)}" for _ in range(length)]
        for _ in range(7):
            copy = list(base)
            for _ in range(pick.randint(0, max(1, length // 25))):
                copy[pick.randrange(len(copy))] = f"n{pick.randrange(2000)}"
            texts.append(" ".join(copy if pick.random() < 0.7 else copy + [f"t{pick.randrange(99)}"]))
    rows = jaccard_join.groups(documents(*texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_groups(texts)


def test_sets_that_share_many_lists_meet_about_once(spark):
    bits, other = [0] * 4, [-1] * 4
    rows = [(2 * key, i, 60, i, bits, None) for i in range(4) for key in range(40)] + [(2 * key, 9, 60, 9, other, None) for key in range(40)]
    rows += [(3, 7, 20, 7, bits, None), (3, 8, 20, 8, bits, None), (4, 7, 20, 7, bits, None), (4, 8, 20, 8, bits, None)]
    lists = spark.createDataFrame(rows, "key long, doc_id long, n int, root long, bits array<long>, wide array<long>")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        met = jaccard_join.meetings(lists, 30, 85)
        found = [tuple(r) for r in met.collect()]
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(found) == [(a, b) for a in range(4) for b in range(a + 1, 4)] + [(7, 8)]
    assert "ReusedExchange" in plan


def test_groups_of_odd_tables(documents):
    docs = documents("a b c d e", "a b c d e", "other", ids=[3, None, 3])
    rows = sorted((r.doc_id is None, r.n_shingles, r.component_id) for r in jaccard_join.groups(docs).collect())
    assert rows == [(False, 1, 3), (False, 2, 3), (True, 2, 3)]
    assert jaccard_join.groups(docs.where("false")).count() == 0
    docs = documents("a b c d e", "a b c d e", "", None)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]


def test_components_of_a_chain(spark, documents):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    assert {r.node: r.root for r in found.collect()} == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}


def test_contained_items(documents, spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    near = item.replace("xi", "XX")
    far = item.replace("eta theta", "no no")
    texts = [f"before {item.upper()}! after", f"{near} x", far, "", None, "two words", "filler " * 3000 + item]
    benchmark = spark.createDataFrame([(1, item, "z"), (2, None, "z"), (3, "two words", "z"), (4, "", "z")], "item_id long, text string, hash string")
    rows = {(r.doc_id, r.item_id): r.containment for r in decontaminate.contained_items(documents(*texts), benchmark).collect()}
    assert rows == {(0, 1): 1.0, (1, 1): 9 / 11, (6, 1): 1.0, (5, 3): 1.0} or rows == {(0, 1): 1.0, (6, 1): 1.0, (5, 3): 1.0, (1, 1): pytest.approx(9 / 11)}
    docs = documents(*texts)
    left = decontaminate.clean(docs, benchmark)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4]
    assert decontaminate.contained_items(docs, benchmark.where("false")).count() == 0
    assert decontaminate.contained_items(docs.where("false"), benchmark).count() == 0


def brute_contained(texts, items):
    words = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    out = set()
    for j, item in enumerate(items):
        iw = words(item)
        k = min(5, len(iw))
        own = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if k else set()
        for i, text in enumerate(texts):
            dw = words(text)
            shared = len(own & {tuple(dw[a:a + k]) for a in range(len(dw) - k + 1)})
            if own and 10 * shared >= 8 * len(own):
                out.add((i, j, len(own), shared))
    return out


def test_contained_items_equal_brute_force(documents, spark):
    pick = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    run = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    items = [" ".join(run(n)) for n in (1, 2, 3, 4, 5, 6, 9, 14, 20, 40, 80) for _ in range(3)] + ["", None, "one two three four"]
    texts = [None, "", "one two three four", "a one, two THREE four b"]
    for _ in range(120):
        text = run(pick.choice([0, 3, 30, 200]))
        item = (pick.choice(items) or "").split()
        for i in range(len(item)):
            if pick.random() < 0.02:
                item[i] = "zz"
        at = pick.randint(0, len(text))
        texts.append(" ".join([*text[:at], *item, *text[at:]]))
    benchmark = spark.createDataFrame([(j, t, 1) for j, t in enumerate(items)], "item_id long, text string, n int")
    want = brute_contained(texts, items)
    rows = decontaminate.contained_items(documents(*texts), benchmark).collect()
    assert {(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in rows} == want and len(rows) == len(want) > 100
    leaky = {i for i, *_ in want}
    assert sorted(r.doc_id for r in decontaminate.clean(documents(*texts), benchmark).collect()) == [i for i in range(len(texts)) if i not in leaky]


def test_leaks_without_ids(documents, spark):
    item = "one two three four five six"
    benchmark = spark.createDataFrame([(None, item), (None, "seven eight"), (3, item)], "item_id long, text string")
    docs = documents(f"x {item}", f"y {item}", "seven eight nine", "clean", ids=[None, 5, 5, None])
    assert [r.text for r in decontaminate.clean(docs, benchmark).collect()] == ["clean"]
    rows = {(r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, benchmark).collect()}
    assert rows == {(None, None), (None, 3), (5, None), (5, 3)}


def test_base_score_and_known_words(documents):
    texts = [*ODD, *(f"some words repeat word{i % 7} and Words{i}" for i in range(40))]
    rows = {r.doc_id: r for r in suffix_tree.score(documents(*texts), common_words=8).collect()}
    tokens = {i: [*(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")), None] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total = sum(count.values())
    for i, words in tokens.items():
        row = rows[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[i], len(words), sum(count[w] > 0 for w in words), total)
        assert row.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in words))
        assert -math.inf < row.score < 0


def test_suffix_tree_learns_contexts_and_adds_up(documents, spark):
    docs = documents(*["abab abab abab"] * 30)
    counted = suffix_tree.counts(docs, 3)
    tree = automaton.tree(counted, 3, 1e-4, 1.0)
    assert tree.kept > 1
    spelled = tree.spell([suffix_tree.normal(b"abab"), suffix_tree.normal(b"bbbb")])
    assert spelled[0] > spelled[2] and len(spelled) == 4
    rows = 10.0 ** tree.log10.reshape(-1, tree.width)
    seen = tree.width - 2
    assert rows[:, :seen].sum(axis=1) + rows[:, seen] * (suffix_tree.SYMBOLS - seen) == pytest.approx(1, abs=1e-4)
    assert suffix_tree.score(docs.where("false")).count() == 0


def test_archives(spark, documents):
    pages = [(5, "http://a/%41\r\nx", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, None, None), (8, "http://b", ""), (2, "http://a/2", "<p>same</p>"), (None, "u", "é")]
    df = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id long, url string, html string, digest string, n int")
    rows = warc.archived(df).collect()
    code = lambda html: base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    want = [(5, 11, code("<p>same</p>"), "revisit", 2), (2, 11, code("<p>same</p>"), "response", None), (2, 11, code("<p>same</p>"), "response", None),
            (9, 0, code(""), "revisit", 8), (8, 0, code(""), "response", None), (None, 2, code("é"), "response", None)]
    assert sorted(map(str, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows))) == sorted(map(str, want))
    assert {r.url for r in rows} == {p[1] for p in pages} and all(r.digest_ok is not False for r in rows)
    assert all(r.record_type == "response" for r in warc.archived(df, least_bytes=12).collect())
    assert warc.archived(df.where("false")).count() == 0
    assert gzip.decompress(warc.record(1, "u", b"x", None)).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def test_page_text(spark, documents):
    inside = ("<html><head><title>t</title><style>p{}</style></head><body><nav><li>menu</nav><div class='ad-box'>buy<div>now</div></div><article><header><h1>Head</h1>"
              "</header><p>A &amp;amp; <b>b</b><br>c<p class=notice>no<p>d\n\t e<script>var x='</p>'</script><aside>side</aside><ul><li>f<li>g</ul></article>"
              "<section id=comments><article class=comment>say</article></section><form>q</form><footer>foot</footer>")
    bare = "<body><div>Shared top</div><p>{}</p><p>{}</p><div>Shared end</div></body>"
    pages = [(1, "http://h/a/10", inside), (2, "http://h/b/201", bare.format("one", "two")), (3, "https://h/b/202?x", bare.format("three", "four")), (4, None, None), (5, "", ""),
             (6, "http://g/x", bare.format("5", "6"))]
    df = spark.createDataFrame([(*p, "clash", "p") for p in pages], "page_id long, url string, html string, text string, host string")
    rows = {r.page_id: r.text for r in page_text.extract(df).collect()}
    assert rows[1] == "Head\n\nA &amp; b c\n\nd e\n\nf\n\ng"
    assert (rows[2], rows[3]) == ("one\n\ntwo", "three\n\nfour") and rows[4] == rows[5] == ""
    assert rows[6] == "Shared top\n\n5\n\n6\n\nShared end"
    assert page_text.extract(df.where("false")).count() == 0


def texts_of(spark, pages):
    df = spark.createDataFrame([(i, f"http://h{i}/x", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in sorted(page_text.extract(df).collect(), key=lambda r: r.page_id)]


def test_layout_classes_lose_no_text(spark, documents):
    whole = ["<body class='right-sidebar'><article><p>main text</p></article></body>", "<body class='single no-sidebar comments-open'><article><p>main text</p></article>",
             "<html class='cookie'><main class='search'><p>main text</p></main>"]
    assert texts_of(spark, whole) == ["main text"] * 3
    inside = [f"<article><p>first</p><div {a}>second</div></article>" for a in ("class='post-search'", "class='social-science'", "class='alert'", "id='related-work'", "class=adverb")]
    assert texts_of(spark, inside) == ["first\n\nsecond"] * 5
    gone = [f"<article><p>first</p><div {a}>second</div></article>" for a in ("class='big ad'", "class='ad-box'", "id=comments", "role=navigation hidden", "class=share_links")]
    assert texts_of(spark, gone) == ["first"] * 5
    assert texts_of(spark, ["<article><header class='banner'><h1>Head</h1></header><p>text</p></article><header class=x>top</header>"]) == ["Head\n\ntext"]


def test_small_containers_do_not_decide(spark, documents):
    body = "".join(f"<p>paragraph {i} of the page</p>" for i in range(5))
    text = "\n\n".join(f"paragraph {i} of the page" for i in range(5))
    assert texts_of(spark, [f"<body>{body}<article class='teaser'>Read also this</article>", f"<main>stub</main><div>{body}"]) == [f"{text}\n\nRead also this", f"stub\n\n{text}"]
    assert texts_of(spark, [f"<div>short aside line</div><article>{body}</article>"]) == [text]


def test_generated_hosts_without_containers(spark, documents):
    pick = random.Random(12)
    rows, want = [], {}
    for host in range(6):
        template = [f"menu {host}", f"about {host}", f"contact {host} now"]
        pages = [[f"page {host} {i} {pick.random()}" for _ in range(pick.randint(1, 6))] for i in range(12)]
        for i, own in enumerate(pages):
            lines = [template[0], *own[: len(own) // 2], template[1], *own[len(own) // 2 :], template[2]]
            teaser = "<article>x</article>" if host % 2 else ""
            rows.append((100 * host + i, f"https://host{host}.org/{pick.choice('abc')}/{i}", teaser + "".join(f"<div>{t}</div>" for t in lines)))
            want[100 * host + i] = "\n\n".join([*(["x"] if teaser else []), *own])
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in page_text.extract(df, 3).collect()} == want


def test_shared_lines_are_a_longest_common_subsequence():
    pick = random.Random(3)
    for _ in range(500):
        a, b = ([pick.randrange(4) for _ in range(pick.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        places = page_text.shared_lines(a, b)
        rest = iter(b)
        assert len(places) == best[-1][-1] and places == sorted(set(places)) and all(any(a[i] == y for y in rest) for i in places)


@pytest.mark.parametrize("most_held", [0, 100, 1 << 20])
def test_suffix_tree_keeps_every_context_seen_often(documents, most_held):
    pick = random.Random(5)
    texts = ["rare qzkjvx" + " qzkjvx" * 4] * 12 + [" ".join(pick.choice(["alpha", "beta", "gamma", "delta", "epsilon"]) for _ in range(4000)) for _ in range(60)]
    docs = documents(*texts)
    teaching = docs.doc_id >= 0
    counted = suffix_tree.counts(docs, 4).cache()
    whole = sum(r.n for r in counted.where("kind = 0").collect())
    assert 50 <= 60 < 5e-5 * whole  # by their share the rare word's contexts were left out
    scratch = Scratch(docs.sparkSession, "test")
    root, model = suffix_tree.contexts(counted, scratch, 4, 50, 1.0)
    assert {(1, ord(c)) for c in "qzkjvx"} <= {(r.k, r.context) for r in model.collect()}
    tree = automaton.tree(counted, 4, 50 / whole, 1.0)
    assert model.count() + 1 == tree.kept
    words = {r.key: r.n for r in counted.where("kind = 1").collect()}
    total, once = sum(words.values()), max(1, sum(n == 1 for n in words.values()))
    rows = {r.doc_id: r.score for r in suffix_tree.score(docs, teaching, 4, most_held=most_held).collect()}
    for i in (0, 30):
        normal = suffix_tree.normal(texts[i].encode())
        hashes = [*next(iter(suffix_tree.hashed_texts([normal]))).view("int64").tolist(), int(suffix_tree.END_TOKEN)]
        want = sum(math.log10((words[h] + once * 10.0**p) / (total + once)) for h, p in zip(hashes, tree.spell([normal]), strict=True))
        assert rows[i] == pytest.approx(want, rel=1e-5)


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_pages_are_paired_over_folders_copies_and_tasks(spark, documents, tasks):
    page = "<body><div>Menu</div><p>{}</p><div>Foot</div></body>"
    folders = [(i, f"http://h/2024/{i // 30:02}/{i % 30:02}/title-{i}/", page.format(f"own {i}")) for i in range(40)]
    copies = [(100 + i, f"http://k/a/{i:02}", page.format("one" if i < 20 else "two")) for i in range(40)]
    rest = [(200, "http://g/x", page.format("alone")), (201, "http://l/a", page.format("same")), (202, "http://l/b", page.format("same")), (203, "http://h/2024/00/05/x", None)]
    df = spark.createDataFrame([*folders, *copies, *rest], "page_id long, url string, html string")
    rows = {r.page_id: r.text for r in page_text.extract(df, tasks).collect()}
    want = {i: f"own {i}" for i in range(40)} | {100 + i: "one" if i < 20 else "two" for i in range(40)}
    want |= {200: "Menu\n\nalone\n\nFoot", 201: "Menu\n\nsame\n\nFoot", 202: "Menu\n\nsame\n\nFoot", 203: ""}
    assert rows == want


def test_suffix_tree_writes_no_line_for_a_common_word(documents, monkeypatch):
    rows, land = {}, Scratch.land

    def counted(self, df, name):
        out = land(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "land", counted)
    scored = suffix_tree.score(documents(*["abab abab cdcd"] * 60), F.lit(True), 4, most_held=0)
    assert scored.count() == 60
    assert rows["lines"] == 60
