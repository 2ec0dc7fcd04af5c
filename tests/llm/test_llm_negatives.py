"""Hard negatives against brute force."""

import random

import numpy as np
import pytest

from voxtally.llm import hard_negatives

EMBEDDINGS = "vec_id long, label int, embedding array<float>, score long, dim string"


def brute(rows):
    given = {}
    for vec_id, label, vector in rows:
        if vec_id is not None and label is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            label = (label + 1) % 10 if vec_id % 7 == 0 else label
            given[vec_id, label, tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in vector)] = None
    out = []
    for vec_id, label, vector in given:
        if vec_id % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), i, lab) for i, lab, v in given if len(v) == len(vector)]
        positives = sorted({(s, i) for s, i, lab in scored if lab == label and i != vec_id})[:5]
        for s, i in positives:
            fits = sorted({(t, j) for t, j, lab in scored if lab != label and 50 * -s <= 100 * -t <= 95 * -s})[:3]
            out += [(vec_id, i, rank, j, -s, -t) for rank, (t, j) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], EMBEDDINGS)
    got = hard_negatives.mine(df, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("smooth", [False, True])
@pytest.mark.parametrize("anchor_bytes", [1 << 25, 6000])
def test_negatives_equal_brute_force(spark, documents, monkeypatch, smooth, anchor_bytes):
    rng = np.random.default_rng(4)
    values = rng.normal(0, 0.2, (400, 10))
    if smooth:  # neighbouring components are alike, and bounds rule out nearly everything
        values = np.repeat(rng.normal(0, 1, (400, 2)), 40, axis=1) + rng.normal(0, 0.01, (400, 80))
        monkeypatch.setattr(hard_negatives, "CELLS", 64)
    rows = [(i, int(rng.integers(0, 4)), [float(x) for x in v]) for i, v in enumerate(values)]
    assert mined(spark, rows, anchor_bytes=anchor_bytes) == brute(rows)


def test_negatives_of_odd_rows(spark, documents):
    pick = random.Random(8)
    rows = [(pick.randrange(-200, 200), pick.randrange(3), [pick.choice([0.0, 0.5, 1.0, -0.25]) for _ in range(pick.choice([3, 3, 3, 8]))]) for _ in range(250)]
    rows += rows[:40]  # repeated rows, and ids with several vectors
    rows += [(0, None, [1.0]), (50, 1, None), (None, 1, [1.0, 1.0, 1.0]), (100, 1, [float("nan"), 1.0, 1.0]), (3, 1, [float("inf"), 0.0, 0.0]),
             (4, 2, [None, 1.0, 1.0]), (150, 1, []), (151, 1, []), (152, 2, []), (400, 1, [1e30, 0.0, 0.0])]
    assert mined(spark, rows) == brute(rows[:-1])
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0])]) == []


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(1)
    matrix = np.floor(256 * np.repeat(rng.normal(0, 1, (60, 6)), 16, axis=1))
    mean, deviation = (x.astype(np.float32) for x in hard_negatives.summaries(matrix))
    exact = matrix @ matrix.T
    width = np.inf
    for group in hard_negatives.GROUPS:
        middle, spread = hard_negatives.factors(mean, deviation, group)
        a, b = middle @ middle.T, spread @ spread.T
        assert (np.abs(exact - a) <= b * 1.001 + 1).all() and b.mean() <= width
        width = b.mean()
    assert width < 0.2 * np.abs(exact).mean()
