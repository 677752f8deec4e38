"""Hard negatives against all scores, and the bounds against exact scores."""

from __future__ import annotations

import math

import numpy as np
import pytest

from roostline.llm import hard_negatives as hn
from roostline.llm.hard_negatives import OP11_SQL, Side, mine, op11_hard_negatives, summarize, surviving
from tests.comparing import connect, differences


def frame(spark, rows):
    schema = "vec_id bigint, embedding array<float>, label int, anchor_id string, score int"
    return spark.createDataFrame([(*r, "x", 1) for r in rows], schema).repartition(3)


def plain(rows, every=100, positives=5, negatives=5, low=80, high=100):
    """All scores of all anchors, sorted."""
    usable = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        scaled = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum((abs(256 * float(np.float32(x))) + 1) ** 2 for x in vector) < 2.0**62:
            usable[i] = min(usable.get(i, (label, scaled)), (label, scaled))
    out = []
    for a, (label, vector) in usable.items():
        if a % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, v)), i, own == label)
            for i, (own, v) in usable.items()
            if i != a and len(v) == len(vector)
        )
        for top, positive in [(-s, i) for s, i, same in scored if same][:positives]:
            inside = [(-s, i) for s, i, same in scored if not same and low * top <= -100 * s <= high * top]
            out += [(a, positive, n + 1, i, top, s) for n, (s, i) in enumerate(inside[:negatives])]
    return sorted(out)


def collected(df):
    names = "anchor_id positive_id rank negative_id positive_score negative_score".split()
    assert df.columns == names
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def clusters():
    """Vectors around a few centres, with copies of one vector, under few labels."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(6, 24))
    rows = []
    for i in range(900):
        near = centres[i % 6] if i % 3 else centres[0]
        noise = 0 if i % 10 == 3 else draw.normal(size=24) * 0.4
        rows.append((i, (near + noise).astype(np.float32).tolist(), int(draw.integers(0, 4))))
    return rows


def test_equals_all_scores(spark, clusters):
    want = plain(clusters, every=30)
    assert len(want) > 300
    assert collected(mine(frame(spark, clusters), "vec_id % 30 = 0")) == want


def test_rounds_and_small_blocks(spark, clusters, monkeypatch):
    monkeypatch.setattr(hn, "ROW_BLOCK", 37)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 5)
    got = mine(frame(spark, clusters), "vec_id % 30 = 0", positives=2, negatives=3, lowest=50, highest=90, anchors_at_once=9)
    assert collected(got) == plain(clusters, 30, 2, 3, 50, 90)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (200, [-1.0, 0.0], 2), (300, [0.0, 0.0], 1), (400, [], 1),
        (500, [3e18, 1.0], 1), (600, [1e6, 2e6], 1), (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1),
        (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [1.0, 0.5], None), (6, [0.9, 0.5], 2), (7, [0.9, 0.5], 2),
        (8, [1.0, 0.5, 0.1], 2), (9, [1.0, 0.5], 1), (9, [5.0, 0.5], 1), (9, [5.0, 0.5], 0), (10, [0.0, 0.0], 3),
        (11, [], 2), (12, [], 1), (13, [1e6, 1.9e6], 3), (0, [1.0, 0.5], 1), (14, [-0.004, 0.003], 3),
    ]
    assert collected(mine(frame(spark, rows), "vec_id % 100 = 0")) == plain(rows)


def test_copies_of_one_vector_and_ties(spark):
    rows = [(i, [0.5, 0.25, 1.0], i % 2) for i in range(400)]
    assert collected(mine(frame(spark, rows), "vec_id % 100 = 0")) == plain(rows)


def test_empty_and_no_anchors(spark):
    assert collected(mine(frame(spark, []), "vec_id % 100 = 0")) == []
    assert collected(mine(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)]), "vec_id % 100 = 0")) == []
    assert collected(mine(frame(spark, [(100, [1.0], 1)]), "vec_id % 100 = 0")) == []


def test_bounds_hold_and_prune():
    draw = np.random.default_rng(1)
    base = np.repeat(draw.normal(size=(40, 8)) * 200, 8, axis=1)
    vectors = np.floor(base + draw.normal(size=base.shape) * 10).astype(np.int64)
    side = Side(np.arange(40), np.zeros(40), vectors, *summarize(vectors))
    scores = vectors @ vectors.T
    low = np.sort(scores, axis=1)[:, -3].astype(float)
    left, at, mask = surviving(side, side, low, np.full(40, np.inf), np.ones((40, 40), bool))
    kept = np.zeros((40, 40), bool)
    kept[np.ix_(left, at)] = mask
    assert not ((scores >= low[:, None]) & ~kept).any()
    assert kept.sum() < 0.2 * kept.size


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_equals_its_twin(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(spark, connect(folder), folder, op11_hard_negatives, OP11_SQL) == []
