"""Spanning-tree mining against all scores."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from groupledger.llm import hard_negatives as hard

ROWS = "vec_id long, embedding array<float>, label int"


def _expected(rows: list[tuple], every: int = 10) -> set[tuple]:
    """All scores of every anchor, sorted."""
    known: dict[int, tuple] = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        known[i] = max(known.get(i, (label, whole)), (label, whole))
    out = set()
    for a, (label, v) in known.items():
        if a % every:
            continue
        scores = sorted(
            (-sum(x * y for x, y in zip(v, w)), o, other == label)
            for o, (other, w) in known.items() if o != a
        )
        for s, p, _ in [x for x in scores if x[2]][:5]:
            hits = [(n, -t) for t, n, same in scores if not same and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out.update((a, p, rank, n, -s, t) for rank, (n, t) in enumerate(hits, 1))
    return out


def _mined(spark, rows, every: int = 10) -> set[tuple]:
    df = spark.createDataFrame(rows, ROWS)
    got = [tuple(r) for r in hard.mine(hard.whole_vectors(df), F.col("vec_id") % every == 0).collect()]
    assert len(got) == len(set(got))
    return set(got)


def _clustered(seed: int, count: int, dim: int = 6) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    return [
        (i, (centres[i % 5] + rng.normal(scale=0.4, size=dim)).astype(np.float32).tolist(), int(rng.integers(4)))
        for i in range(count)
    ]


@pytest.mark.parametrize(("block", "rows"), [(256, 8192), (4, 50)])
def test_all_negatives_are_found(spark, monkeypatch, block, rows):
    monkeypatch.setattr(hard, "BLOCK", block)
    monkeypatch.setattr(hard, "ROWS", rows)
    monkeypatch.setattr(hard, "LEAST_ROWS", 100)
    data = _clustered(1, 600)
    data += [(1000 + i, data[3][1], i % 3) for i in range(120)]  # copies: ties by id
    want = _expected(data)
    assert len(want) > 500
    assert _mined(spark, data) == want


def test_bounds_spare_scores():
    """Near anchors share most bounds, so far fewer than all scores are worked out."""
    rng = np.random.default_rng(3)
    anchors = rng.normal(size=8) * 200 + rng.normal(size=(40, 8))
    order, parents, edges = hard.spanning_tree(np.floor(anchors))
    vectors = np.floor(rng.normal(size=(3000, 8)) * 100)
    rows = hard.Rows(np.arange(3000), np.zeros(3000), vectors)
    tree = hard.Rows(np.arange(40), np.zeros(40), np.floor(anchors)[order])
    best = {}

    def seeks(at, low, high):
        return np.flatnonzero(high >= hard._kth(low, 5))

    def takes(at, wanted, scores):
        best[at] = set(wanted[hard._best(scores, wanted, 5)])

    scored = hard.walk(tree, parents, edges, rows, seeks, takes)
    for at in range(40):
        exact = vectors @ tree.vectors[at]
        assert best[at] == set(hard._best(exact, rows.ids, 5))
    assert scored < 0.3 * 40 * 3000


def test_tree_is_a_minimum_one():
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(30, 3))
    order, parents, edges = hard.spanning_tree(vectors)
    assert sorted(order) == list(range(30)) and parents[0] == -1
    assert all(parents[i] < i for i in range(30))
    groups, total = list(range(30)), 0.0  # Kruskal
    far = sorted((np.linalg.norm(vectors[i] - vectors[j]), i, j) for i in range(30) for j in range(i))
    for d, i, j in far:
        if groups[i] != groups[j]:
            total += d
            groups = [groups[i] if g == groups[j] else g for g in groups]
    assert edges.sum() == pytest.approx(total)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 0.5], 2), (3, [0.5], 2), (4, [], 2),
        (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [None, 1.0], 2), (8, None, 2), (9, [1.0, 1.0], None),
        (None, [1.0, 1.0], 2), (20, [-1.0, -1.0], 1), (30, [1.0, 0.75], 3), (-10, [0.5, 0.5], 2), (11, [0.5, 0.25], 2),
    ]
    want = _expected(data)
    assert want
    assert _mined(spark, data) == want
    assert _mined(spark, []) == set()
    assert _mined(spark, [(3, [1.0], 1), (4, [1.0], 2)]) == set()
    wide = spark.createDataFrame(data, ROWS)
    for name in ("part", "block", "place", "vector", "rank", "anchor_id"):
        wide = wide.withColumn(name, F.lit(1))
    assert hard.whole_vectors(wide).columns == ["vec_id", "label", "vector"]


def test_too_long_vectors_fail(spark):
    df = spark.createDataFrame([(0, [1e9], 1), (1, [1e9], 1)], ROWS)
    with pytest.raises(Exception, match="too long for exact scores"):
        hard.mine(hard.whole_vectors(df), F.col("vec_id") % 100 == 0).collect()


def test_random_rows(spark):
    rng = random.Random(8)
    data = [(rng.randint(0, 150), [rng.choice([0.0, 0.25, 1.0, -1.0]) for _ in range(3)], rng.randint(0, 2))
            for _ in range(250)]
    assert _mined(spark, data) == _expected(data)
