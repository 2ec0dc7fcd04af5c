"""Personal data: fixed forms by brute force, the field by enumeration and on held-out windows."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from voxtally.llm import personal_data as personal

from .conftest import ODD

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checked(kind, found):
    digits = [int(c) for c in re.sub("[^0-9]", "", found)]
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_base(text):
    kinds = list(PATTERNS)
    found = [(m.start(), i, m.end()) for i, kind in enumerate(kinds) for m in re.finditer(PATTERNS[kind], text) if checked(kind, m[0])]
    return [(s, e, kinds[i]) for s, i, e in sorted(found)]


def test_base_spans_equal_the_patterns():
    pick = random.Random(4)
    for _ in range(20_000):
        text = "".join(pick.choice("1234567890" * 2 + "ab@.+- ()%_é") for _ in range(pick.randint(0, 40)))
        assert personal.base_spans(text) == brute_base(text), text
    for text in ["1" * 100_000, "1." * 50_000, "a@" * 50_000, "a.b@" + "c." * 50_000 + "d", "+1" * 50_000, "1 " * 50_000]:
        personal.base_spans(text)  # each in time proportional to its length


def corpus(seed, n):
    """Invented texts with personal data in plain forms, and as many with other numbers."""
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefghilmnorstu") for _ in range(pick.randint(2, 9)))

    def card():
        digits = "4" + "".join(str(pick.randrange(10)) for _ in range(14))
        return next(f"{digits}{c}" for c in range(10) if personal.luhn(f"{digits}{c}"))

    def told():
        return pick.choice([f"{word()}.{pick.randrange(99)}@{word()}{pick.randrange(9)}.example.com", ".".join(str(pick.randrange(256)) for _ in range(4)), card(),
                            f"+{pick.randrange(1, 99)} ({pick.randrange(100, 999)}) {pick.randrange(100, 999)}-{pick.randrange(1000, 9999)}"])

    def other():
        return personal._plain_number(pick)

    return [" ".join([*(word() for _ in range(14)), told() if i % 2 else other(), *(word() for _ in range(14))]) for i in range(n)]


@pytest.fixture(scope="module")
def field():
    return personal.fit(personal.examples(corpus(1, 500)))


def test_field_sums_over_all_segmentations(field):
    text = "x 017 555-7713 4111 ann at host dot org 9"
    found = personal.candidates(text)
    assert 5 < len(found) < 14
    rng = np.random.default_rng(0)
    random_field = personal.Field(rng.normal(0, 1, field.weights.shape), rng.normal(0, 1, field.following.shape))
    score = random_field.scores(found)
    totals, best = [], (-math.inf, None)
    for chosen in itertools.product(range(-1, 4), repeat=len(found)) if len(found) < 8 else _disjoint(found):
        picked = sorted((found[k].start, found[k].end, k, y) for k, y in enumerate(chosen) if y >= 0)
        if any(a[1] > b[0] for a, b in zip(picked, picked[1:])):
            continue
        before, total = 4, 0.0
        for _, _, k, y in picked:
            total += score[k, y] + random_field.following[before, y]
            before = y
        totals.append((total, picked))
        best = max(best, (total, [(s, e, y) for s, e, _, y in picked]))
    whole, expected, followed = personal.expectations(random_field, found)
    assert whole == pytest.approx(np.logaddexp.reduce([t for t, _ in totals]))
    want = np.zeros_like(expected)
    for total, picked in totals:
        for _, _, k, y in picked:
            want[k, y] += math.exp(total - whole)
    assert np.allclose(expected, want) and followed.sum() == pytest.approx(expected.sum())
    assert personal.decode(random_field, found) == best[1]


def _disjoint(found):
    """All choices of types for sets of candidates that do not overlap."""
    def extend(k, chosen, end):
        if k == len(order):
            yield chosen
            return
        yield from extend(k + 1, chosen, end)
        c = found[order[k]]
        if c.start >= end:
            for y in range(4):
                yield from extend(k + 1, {**chosen, order[k]: y}, c.end)
    order = sorted(range(len(found)), key=lambda k: (found[k].start, found[k].end))
    for chosen in extend(0, {}, 0):
        yield [chosen.get(k, -1) for k in range(len(found))]


def test_field_finds_other_spellings_and_leaves_numbers_alone(field):
    found, there, wrong = collections.Counter(), collections.Counter(), 0
    for text, truth in personal.examples(corpus(2, 400), seed=8):
        got = {(s, e, personal.BASE_KINDS[y]) for s, e, y in personal.decode(field, personal.candidates(text), (), personal.CAUTION)}
        wrong += len(got - set(truth))
        for span in truth:
            there[span[2]] += 1
            found[span[2]] += span in got
    assert all(found[k] >= 0.7 * there[k] and there[k] > 50 for k in personal.BASE_KINDS), (found, there)
    assert wrong <= 0.02 * sum(there.values())


def test_added_spans_stand_beside_base_spans(field):
    kinds = lambda text: [k for _, _, k in personal.all_spans(text, field, personal.CAUTION)]
    assert kinds("write to ann [at] host [dot] org today") == ["likely_email"]
    assert kinds("ann@host.org or tel (017) 555-7713") == ["email", "likely_phone"]
    assert kinds("meet me at the house on 2024-05-01, 10:30, for 1,200.50") == []
    assert kinds("look at example. The rest") == [] and kinds("") == []
    assert personal.masked("tel (017) 555-7713, ann@host.org.", field) == "tel <phone>, <email>."


def test_digests_of_odd_texts(documents, field):
    texts = [*ODD, "a@b.c and 1.2.3.4", "+1 (017) 555-7713 4111 1111 1111 1111", "٣" * 12 + " é@b.c"]
    rows = {r.doc_id: r for r in personal.digests(documents(*texts), field).collect()}
    for i, text in enumerate(texts):
        base = brute_base(text or "")
        assert rows[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in base).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in personal.BASE_KINDS] == [sum(x[2] == k for x in base) for k in personal.BASE_KINDS]
        assert {f"{k}:{s}:{e}" for s, e, k in base} <= set(rows[i].spans.split(","))
    docs = documents("mail a@b.c", None)
    out = personal.mask(docs, field)
    assert out.columns == docs.columns and [r.text for r in out.orderBy("doc_id").collect()] == ["mail <email>", None]
    spans = {r.doc_id: [tuple(x) for x in r.spans] for r in personal.scan(docs, field).collect()}
    assert spans == {0: [("email", 5, 10)], 1: []}
    assert personal.digests(docs.where("false"), field).count() == 0


def test_learning_from_a_table(documents):
    docs = documents(*corpus(3, 200), None, "")
    assert personal.learn(docs, most_windows=150).weights.any()
    assert len(personal.sample_windows(docs, 40)) == 40 and personal.sample_windows(docs, 40) == personal.sample_windows(docs.repartition(7), 40)
    nothing = personal.learn(documents("no numbers here", None))
    assert not nothing.weights.any() and personal.added_spans("tel (017) 555-7713", [], nothing, 0) == []
