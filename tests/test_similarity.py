"""The embedding join against all pairs, hot buckets, odd vectors, and picks without near duplicates."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.operators import queue, similarity
from boxloom.operators.manifest import near_leakage


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def exact(x, threshold):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(u @ u.T >= threshold, 1))
    return set(zip(a.tolist(), b.tolist()))


def cloud(seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(1500, 24))
    moved = base[:400] + rng.normal(size=(400, 24)) * rng.uniform(0.1, 0.7, size=(400, 1))
    pile = base[7] + rng.normal(size=(300, 24)) * 0.35
    return np.concatenate([base, moved, pile])


@pytest.mark.parametrize("hot", [32, 1024])
def test_pairs_are_exact_above_and_complete(spark, hot):
    x = cloud()
    found = {(r["id_a"], r["id_b"]): r["cosine"] for r in similarity.embedding_pairs(frame(spark, list(enumerate(x.tolist()))), 0.9, hot=hot).collect()}
    want = exact(x, 0.9)
    assert len(want) > 5000
    assert not set(found) - want
    assert len(want - set(found)) <= 0.002 * len(want)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert all(abs(u[a] @ u[b] - v) < 1e-9 for (a, b), v in found.items())


def test_recall_follows_the_plan(spark):
    x = cloud(2)
    want = exact(x, 0.9)
    found = {(r["id_a"], r["id_b"]) for r in similarity.embedding_pairs(frame(spark, list(enumerate(x.tolist()))), 0.9, recall=0.9).collect()}
    assert found <= want and len(found) >= 0.9 * len(want)


def test_plan_grows_slowly():
    bits, tables = zip(*[similarity.lsh_plan(n, 0.9, 0.9) for n in (10**3, 10**6, 10**9)])
    assert bits == (6, 14, 24) and tables[-1] < 100
    with pytest.raises(ValueError):
        similarity.lsh_plan(10, 0.0, 0.9)


def test_copies_and_odd_vectors(spark):
    rows = [(5, [1.0, 2.0]), (3, [1.0, 2.0]), (9, [1.0, 2.0]), (4, [2.0, 4.0]), (6, [-1.0, -2.0]), (7, [1.0, 2.0, 0.0])]
    rows += [(10, None), (11, []), (12, [0.0, 0.0]), (13, [float("nan"), 1.0]), (14, [float("inf"), 1.0]), (15, [None, 1.0]), (None, [1.0, 2.0])]
    got = sorted((r["id_a"], r["id_b"], round(r["cosine"], 9)) for r in similarity.embedding_pairs(frame(spark, rows), 0.9).collect())
    assert got == [(3, 4, 1.0), (3, 5, 1.0), (3, 9, 1.0)]
    assert similarity.embedding_pairs(frame(spark, []), 0.9).count() == 0


def test_leakage_over_folds(spark):
    images = spark.createDataFrame([(k, "d", k % 2) for k in range(4)], "image_id long, dataset_id string, fold_id int")
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.99, 0.05]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "image_id long, embedding array<double>")
    got = near_leakage(similarity.embedding_pairs(rows, 0.9, ident="image_id"), images)
    assert [(r["id_a"], r["id_b"], r["fold_a"], r["fold_b"]) for r in got.collect()] == [(0, 1, 0, 1)]


def test_picks_are_best_and_apart(spark):
    x = cloud(3)
    df = frame(spark, list(enumerate(x.tolist()))).withColumn("priority", (F.col("vec_id") % 97).cast("double"))
    loose = queue.diverse_pick(df, 150, 7).collect()
    assert sum(r["cluster_size"] for r in loose) == len(x) and len({r["cluster"] for r in loose}) == len(loose) <= 150
    picked = queue.diverse_pick(df, 150, 7, min_cosine=0.6).collect()
    ids = [r["vec_id"] for r in picked]
    assert 0 < len(ids) <= len(loose) and set(ids) <= {r["vec_id"] for r in loose}
    assert not exact(x[ids], 0.6)
    gone = [r for r in loose if r["vec_id"] not in set(ids)]
    assert gone
    better = {r["vec_id"]: r["priority"] for r in loose}
    for r in gone:  # each gave way to one at least as good
        near = [o for o in better if o != r["vec_id"] and exact(x[[r["vec_id"], o]], 0.6)]
        assert max(better[o] for o in near) >= r["priority"]


@pytest.mark.parametrize("hot", [32, 1024])
def test_no_pair_at_the_threshold_is_lost(spark, hot):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(2, 6_000, 24))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    x = np.concatenate([a, 0.9001 * a + np.sqrt(1 - 0.9001**2) * b])
    found = {(r["id_a"], r["id_b"]) for r in similarity.embedding_pairs(frame(spark, list(enumerate(x.tolist()))), 0.9, hot=hot).collect()}
    assert found == exact(x, 0.9) and len(found) >= 6_000
