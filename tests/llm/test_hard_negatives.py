"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemill.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, positives=5, negatives=3, least=50, most=95):
    good = [
        (i, k, lab, [math.floor(256 * x) for x in v])
        for i, (k, v, lab) in enumerate(rows)
        if k is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, k, lab, v in good:
        if not anchor(k):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, n, m) for m, j, n, w in good if m != i and len(w) == len(v)]
        for minus, j, _, _ in sorted(s[:3] + (0,) for s in scored if s[2] == lab)[:positives]:
            found = sorted((s, n) for s, n, other, _ in scored if other != lab and least * -minus <= 100 * -s <= most * -minus)
            out += [(k, j, r + 1, n, -minus, -s) for r, (s, n) in enumerate(found[:negatives])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(900):
        label = int(rng.integers(0, 6))
        rows.append((i, centres[label] * rng.uniform(0.2, 2) + rng.normal(size=12) * 0.6, label))
    rows += [(1000 + i, centres[1], 1 + i % 2) for i in range(200)]  # one common vector under two labels
    rows += [(2000, -centres[1], 1), (2000, centres[2], 2), (2000, centres[2], 2), (2001, centres[2], 3), (2050, np.zeros(12), 1)]
    rows = [(k, [float(np.float32(x)) for x in v], lab) for k, v, lab in rows]
    rows += [(2100, None, 1), (2150, [None] * 12, 1), (2200, [float("nan")] * 12, 1), (2250, [float("inf")] * 12, 1)]
    rows += [(2300, [1.0] * 12, None), (None, [1.0] * 12, 1), (2350, [], 1), (2351, [], 1), (2352, [], 2)]
    return rows + [(2400, [3.0, 4.0], 1), (2401, [3.0, 3.0], 1), (2402, [2.5, 3.5], 2), (2403, [2.0, 2.0], 2), (2404, [1.0, 1.0], 3)]


@pytest.mark.parametrize("small", [False, True])
def test_results_equal_brute_force(spark, rows, small, monkeypatch):
    if small:  # several pivots and blocks, deep trees, many turns of the search
        for name, value in {"SAMPLE": 60, "SHARD_ROWS": 100, "BLOCK_ROWS": 50, "FAN": 3, "LEAF": 4, "QUERIES_AT_ONCE": 7, "QUERIES_A_TASK": 9}.items():
            monkeypatch.setattr(hn, name, value)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("row", "id", "anchor", "size", "shard", "low", "rank"):
        frame = frame.withColumn(name, frame["label"])
    got = hn.hard_negatives(frame, F.col("vec_id") % 50 == 0)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda k: k % 50 == 0)


def test_other_settings_and_no_rows(spark, rows):
    some = rows[:150]
    frame = spark.createDataFrame(some, SCHEMA)
    got = hn.hard_negatives(frame, F.col("vec_id") == 3, positives=2, negatives=4, least_percent=10, most_percent=99)
    assert sorted(map(tuple, got.collect())) == brute(some, lambda k: k == 3, 2, 4, 10, 99)
    assert hn.hard_negatives(frame, F.lit(False)).count() == 0
    assert hn.hard_negatives(frame.limit(0), F.lit(True)).count() == 0


def test_bounds_hold_and_tree_keeps_its_radii():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(700, 8)) * rng.uniform(0.1, 3, size=(700, 1)))
    most = float(np.linalg.norm(x, axis=1).max())
    tree = hn.CoverTree(x, most)
    assert sorted(tree.order.tolist()) == list(range(700)) and sorted(b - a for a, b in tree.leaves)[-1] <= hn.LEAF
    q = np.floor(256 * rng.normal(size=(20, 8)))
    q[3] = 0
    at, leaf, upper = tree.leaves_for(q, np.linalg.norm(q, axis=1), np.full(20, -np.inf), np.full(20, np.inf))
    assert len(at) == 20 * len(tree.leaves)
    for i, one, bound in zip(at, leaf, upper):
        a, b = tree.leaves[one]
        assert (tree.x[a:b] @ q[i]).max() <= bound
    few = tree.leaves_for(q, np.linalg.norm(q, axis=1), np.full(20, 2e5), np.full(20, np.inf))
    assert len(few[0]) < len(at)
    for centres, angle, parents, leaf in tree.levels[1:]:
        assert len(centres) == len(angle) == len(parents) == len(leaf)


def test_near_points_prune_far_leaves():
    """On clustered points the descent skips most leaves."""
    rng = np.random.default_rng(2)
    x = np.floor(256 * (np.repeat(rng.normal(size=(40, 16)), 100, 0) + 0.02 * rng.normal(size=(4000, 16))))
    norms = np.linalg.norm(x, axis=1)
    tree = hn.CoverTree(x, float(norms.max()))
    scores = x[:10] @ x.T
    low = np.sort(scores, axis=1)[:, -50]
    at, _, _ = tree.leaves_for(x[:10], norms[:10], low, np.full(10, np.inf))
    assert len(at) < 10 * len(tree.leaves) / 3
