"""Overlap joins in hot places: boxes of every size, piles, and the work that one unit gets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.operators import pairs
from tests.test_matching import iou, pairs_of


def mixed(seed, n, wide=True):
    """One group of boxes from 1 to 1,900 pixels wide, with near copies; the last is the whole image."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            box = tuple(v + rng.uniform(-0.02, 0.02) * (rows[-1][5] - rows[-1][3]) for v in rows[-1][3:7])
        else:
            x, y, w, h = rng.uniform(-20, 1900), rng.uniform(-20, 1000), 1900 ** rng.random(), 1000 ** rng.random()
            box = (x, y, x + w, y + h)
        rows.append((i, "i0", 1, *box, 0.5))
    return rows + ([(n, "i0", 1, 0.0, 0.0, 1920.0, 1080.0, 0.5)] if wide else [])


@pytest.mark.parametrize("least", [0.05, 0.5, 0.9])
@pytest.mark.parametrize("cell_limit", [8, 2_048])
def test_any_size_and_threshold(boxes, least, cell_limit):
    pred, truth = mixed(1, 150), mixed(1, 150)[::2] + mixed(2, 60, False)
    truth = [(i, *t[1:]) for i, t in enumerate(truth)]
    want = {(p, t) for _, p, t, _ in pairs_of(pred, truth, least)}
    got = pairs.iou_pairs(boxes(pred), boxes(truth, "annotation_id"), least, group_limit=1, cell_limit=cell_limit).collect()
    assert {(r["det_id"], r["annotation_id"]) for r in got} == want and len(got) == len(want) > 20


def test_sides_at_the_edge_of_a_level(boxes):
    """Sides of exactly 64 and 128, 128 and 256 pixels: IoU 0.5 stays within reach."""
    rows = [(i, "i0", 1, 0.0, 0.0, s, 64.0, 0.5) for i, s in enumerate((32.0, 64.0, 128.0, 128.0000001, 256.0, 512.0))]
    want = {(p, t) for _, p, t, _ in pairs_of(rows, rows, 0.5) if p < t}
    got = {(r["det_id_a"], r["det_id_b"]) for r in pairs.self_pairs(boxes(rows), 0.5, group_limit=1).collect()}
    assert got == want and {(0, 1), (1, 2), (4, 5)} <= got


def test_pile_and_image_wide_box_are_spread(spark, boxes):
    rng = random.Random(3)
    pile = [(i, "i0", 1, x := rng.uniform(500, 501), y := rng.uniform(300, 301), x + 40, y + 40, 0.5) for i in range(1_500)]
    rows = [*pile, *[(2_000 + i, "i0", 1, 1000.0 + 5 * i, 10.0, 1004.0 + 5 * i, 14.0, 0.5) for i in range(50)], (9_999, "i0", 1, 0.0, 0.0, 1920.0, 1080.0, 0.5)]
    body = boxes(rows).select("image_id", "class_id", F.struct(F.col("det_id").alias("id"), "x1", "y1", "x2", "y2").alias("a"))
    keys, factor = ["image_id", "class_id", *pairs.PLACE], pairs._level_factor(0.5)
    left = pairs.placed(body, "a", 64, factor)
    right = pairs.placed(body.withColumnRenamed("a", "b"), "b", 64, factor)
    # at most 3 x 3 cells at a box's own level and 2 x 2 at the next, whatever its size
    copies = {r["id"]: r["n"] for r in left.groupBy("a.id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(copies) == {r[0] for r in rows} and max(copies.values()) <= 13
    a, b = pairs._dealt(left, right, keys, 200)
    sizes = [df.groupBy(*keys, "_i", "_j").count().agg(F.max("count")).first()[0] for df in (a, b)]
    assert max(sizes) <= 200
    got = pairs.self_pairs(boxes(rows), 0.9, group_limit=1, cell_limit=200)
    want = sum(iou(p[3:7], q[3:7]) >= 0.9 for k, p in enumerate(pile) for q in pile[:k])
    assert got.count() == got.distinct().count() == want


def test_boxes_without_area(boxes):
    rows = [(1, "i0", 1, 5.0, 5.0, 5.0, 9.0, 0.5), (2, "i0", 1, 9.0, 9.0, 3.0, 3.0, 0.5), (3, "i0", 1, 0.0, 0.0, float("inf"), 9.0, 0.5), (4, "i0", 1, None, 0.0, 4.0, 9.0, 0.5)]
    assert pairs.self_pairs(boxes(rows), 0.5, group_limit=1).count() == 0


@pytest.mark.parametrize("t", [0.75, 0.9, 1.0])
def test_hot_groups_at_a_high_threshold_equal_brute_force_with_few_copies(spark, t):
    """Boxes of all sizes that nearly coincide, at any place: all pairs, and as many copies whatever the size of the group."""
    rng = np.random.default_rng(7)
    size, corner = 10.0 ** rng.uniform(-3, 3, (60, 2)), rng.uniform(-2_000, 2_000, (60, 2))
    move, grow = rng.uniform(-0.12, 0.12, (600, 2)), rng.uniform(0.88, 1.12, (600, 2))
    which = rng.integers(0, 60, 600)
    plain = rng.random(600) < 0.2
    low = corner[which] + np.where(plain[:, None], 0.0, move) * size[which]
    high = low + np.where(plain[:, None], 1.0, grow) * size[which]
    rows = [(i, "a", 1, *map(float, (*low[i], *high[i]))) for i in range(600)]
    boxes = spark.createDataFrame(rows, "det_id bigint, image_id string, class_id int, x1 double, y1 double, x2 double, y2 double")
    got = {(r[0], r[1]) for r in pairs.self_pairs(boxes, t, group_limit=10, cell_limit=200).select("det_id_a", "det_id_b").collect()}
    shared = np.prod(np.clip(np.minimum(high[:, None], high) - np.maximum(low[:, None], low), 0, None), axis=-1)
    area = np.prod(high - low, axis=-1)
    iou = shared / (area[:, None] + area - shared)
    assert got == {(i, j) for i in range(600) for j in range(i + 1, 600) if shared[i, j] > 0 and iou[i, j] >= t}
    assert len(got) > 100
    packed = pairs._packed(boxes, ["image_id"], "det_id", "b", [])
    assert pairs.near_places(packed, "b", t, False).count() <= 12 * 600 and pairs.near_places(packed, "b", t, True).count() == 600
