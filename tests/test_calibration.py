"""Isotonic fit over parts against a serial one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.operators import calibration as cal

ROWS = "class_id int, score double, tp boolean"


def serial(rows):
    """Blocks [x0, x1, hits, n] of one class by the plain rule."""
    points = {}
    for _, s, tp in rows:
        h, n = points.get(s, (0, 0))
        points[s] = (h + tp, n + 1)
    out = []
    for s in sorted(points):
        out.append([s, s, *points[s]])
        while len(out) > 1 and out[-2][2] * out[-1][3] >= out[-1][2] * out[-2][3]:
            last = out.pop()
            out[-1] = [out[-1][0], last[1], out[-1][2] + last[2], out[-1][3] + last[3]]
    return out


def rows_of(kind, n, seed=1):
    rng = random.Random(seed)
    scores = [rng.random() for _ in range(n)]
    chance = {"rising": lambda s: s, "falling": lambda s: 1 - s, "flat": lambda s: 0.5, "exact": lambda s: float(s > 0.5)}[kind]
    return [(c, s, rng.random() < chance(s)) for c in (0, 1) for s in scores]


@pytest.mark.parametrize("kind", ["rising", "falling", "flat", "exact"])
def test_fit_over_small_parts(spark, kind):
    rows = rows_of(kind, 600)
    df = spark.createDataFrame(rows, ROWS).repartition(8)
    got = cal.fit_isotonic(df, min_n=1, block_rows=16).collect()
    for cid in (0, 1):
        mine = sorted([r.x0, r.x1, r.hits, r.n] for r in got if r.class_id == cid)
        assert mine == serial([r for r in rows if r[0] == cid])


def test_apply_between_and_beyond_blocks(spark):
    fitted = spark.createDataFrame([(1, 0.2, 0.4, 1, 4, 0.25), (1, 0.6, 0.6, 3, 4, 0.75)], "class_id int, x0 double, x1 double, hits long, n long, value double")
    rows = [(1, x) for x in (0.0, 0.2, 0.3, 0.4, 0.5, 0.6, 0.9)] + [(1, None), (2, 0.5), (None, 0.5), (1, 0.5), (1, float("nan"))]
    df = spark.createDataFrame([(c, x, "old") for c, x in rows], "class_id int, score double, calibrated string")
    got = cal.apply_isotonic(df, fitted).collect()
    assert len(got) == len(rows)
    found = {(r.class_id, str(r.score)): r.calibrated if r.calibrated is None else round(r.calibrated, 9) for r in got}
    assert found == {
        (1, "0.0"): 0.25, (1, "0.2"): 0.25, (1, "0.3"): 0.25, (1, "0.4"): 0.25, (1, "0.5"): 0.5, (1, "0.6"): 0.75,
        (1, "0.9"): 0.75, (1, "None"): None, (1, "nan"): None, (2, "0.5"): None, (None, "0.5"): None,
    }


def test_few_rows_nulls_and_an_empty_table(spark):
    rows = [(0, 0.5, True)] * 9 + [(1, 0.5, True)] * 10 + [(1, None, True), (None, 0.5, True), (1, 0.7, None)]
    df = spark.createDataFrame(rows, ROWS)
    assert [(r.class_id, r.n, r.value) for r in cal.fit_isotonic(df, min_n=10).collect()] == [(1, 10, 1.0)]
    assert cal.fit_isotonic(df, [0], min_n=1).count() == 1
    empty = df.limit(0)
    assert cal.fit_isotonic(empty, min_n=1).count() == 0 and cal.apply_isotonic(df, cal.fit_isotonic(empty, min_n=1)).filter("calibrated is not null").count() == 0


def test_a_million_distinct_scores(spark):
    df = spark.range(1_000_000, numPartitions=8).select(
        F.lit(3).alias("class_id"), (F.col("id") / 1_000_000).alias("score"), (F.pmod(F.xxhash64("id"), F.lit(1_000)) < F.col("id") / 1_000).alias("tp")
    )
    got = sorted((r.x0, r.x1, r.hits, r.n) for r in cal.fit_isotonic(df, block_rows=1_000).collect())
    assert sum(r[3] for r in got) == 1_000_000
    want = serial(df.collect())
    assert np.array_equal(np.array(got), np.array(want))


def test_scored_boxes_do_not_meet_the_truth_again(spark):
    """Two joins after the boxes are clipped: the pairs, and their hits; and the same rows as the outcomes give."""
    from boxloom.plans.q_detection import outcomes
    from boxloom.plans.q_review import scored
    from boxloom.plans.registry import Inputs

    t = Inputs(spark, "/root/testdata/sf0.001")
    got = scored(t)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Join ") for line in plan.splitlines()) == 2
    want = outcomes(t).filter("det_id IS NOT NULL").select(*got.columns[:-1], (F.col("outcome") == "TP").alias("tp"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.isEmpty()
