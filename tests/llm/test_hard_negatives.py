"""Hard negatives against all pairs in plain Python integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from boxloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    fine = [
        (i, tuple(math.floor(256 * x) for x in v), (y + 1) % 10 if i % 7 == 0 else y)
        for i, v, y in rows
        if i is not None and y is not None and v and all(x is not None and math.isfinite(x) and abs(x) < 2**40 for x in v)
    ]
    fine = [r for r in fine if sum(float(x) ** 2 for x in r[1]) < 2**62]
    out = []
    for i, q, y in sorted({r for r in fine if r[0] % 50 == 0}):
        scored = [(-sum(a * b for a, b in zip(q, p)), j, z) for j, p, z in fine if j != i and len(p) == len(q)]
        for s, j, _ in sorted(r for r in scored if r[2] == y)[:5]:
            fit = sorted(r for r in scored if r[2] != y and 50 * -s <= 100 * -r[0] <= 95 * -s)[:3]
            out += [(i, j, k + 1, b, -s, -n) for k, (n, b, _) in enumerate(fit)]
    return sorted(out)


def vectors(rng, n, width=12, centres=6):
    middle = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(centres)]
    return [(i, [m + rng.gauss(0, 0.4) for m in rng.choice(middle)], rng.randrange(3)) for i in range(n)]


def mined(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("mine") for c in ("q", "width", "rank", "part", "parts", "shelf", "deal", "key", "asked", "rows")})
    return sorted(tuple(r) for r in hn.mine(df).collect())


def test_small_trees_blocks_and_shelves(spark, monkeypatch):
    for name, value in (("TREE", 4), ("BLOCK", 64), ("SHELF", 2), ("BLOCKS_A_KEY", 2)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(random.Random(1), 1500)
    assert mined(spark, rows) == brute(rows)


@pytest.mark.parametrize("clashing", [False, True])
def test_hostile_rows(spark, clashing):
    rng = random.Random(2)
    rows = vectors(rng, 260)
    rows += [rows[100], rows[100], rows[51], (100, rows[3][1], 1), (150, rows[3][1], 2)]  # repeated rows and ids
    rows += [(1000 + k, rows[100][1], k % 4) for k in range(30)]  # ties
    rows += [(None, rows[5][1], 1), (2000, None, 1), (2050, [], 1), (2100, rows[5][1], None), (2150, [1.0, None] * 6, 1)]
    rows += [(2200, [float("nan")] * 12, 0), (2250, [float("inf")] * 12, 0), (2300, [1e300] * 12, 1), (2350, [0.0] * 12, 1)]
    rows += [(3000 + k, [rng.random() for _ in range(5)], k % 2) for k in range(60)]  # another width
    rows += [(4000 + k, [rng.random() * 1e6 for _ in range(12)], k % 2) for k in range(51)]  # longer integers
    rows += [(-50, rows[7][1], 1), (-49, rows[8][1], -5)]
    assert mined(spark, rows, clashing) == brute(rows)


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1)]) == []


def test_tree_spans_with_least_edges():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 5))
    order, parent, edge = hn.spanning_tree(x)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and (parent[1:] < np.arange(1, 40)).all()
    assert np.allclose(edge[1:], np.sqrt(((x[order[1:]] - x[order[parent[1:]]]) ** 2).sum(1)))
    # Kruskal's total
    pairs = sorted((float(np.linalg.norm(x[a] - x[b])), a, b) for a in range(40) for b in range(a))
    root, total = list(range(40)), 0.0
    for d, a, b in pairs:
        if root[a] != root[b]:
            total += d
            root = [root[a] if r == root[b] else r for r in root]
    assert math.isclose(total, edge.sum())


def test_bounds_save_scores():
    """Near anchors and settled thresholds leave few candidates to score."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(2, 16)) * 256
    anchors = np.floor(centres[0] + rng.normal(size=(50, 16)) * 2).astype(np.int64)
    order, parent, edge = hn.spanning_tree(anchors.astype(float))
    rest = np.floor(np.concatenate([centres[0] * 1.2 + rng.normal(size=(40, 16)), centres[1] + rng.normal(size=(4000, 16)) * 60])).astype(np.int64)
    seen = []

    class Counting(hn.Tree):
        def walk(self, x):
            for a, low, high, settle in super().walk(x):
                yield a, low, high, lambda wanted: seen.append(int(wanted.sum())) or settle(wanted)

    ids = np.arange(len(rest)) + 10**6
    found = hn.positives_of(Counting(anchors[order], parent, edge), order, rest, ids, 5)
    exact = [sorted(zip((-(rest @ q)).tolist(), ids.tolist()))[:5] for q in anchors[order]]
    assert [[(-s, i) for i, s in zip(i_.tolist(), s_.tolist())] for i_, s_ in found] == exact
    assert sum(seen) < 0.2 * 50 * len(rest)
