import math
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from boxloom.functions import geometry as g, scalars as s
from boxloom.operators import boxes as ob, checks
from boxloom.sources import readers


def test_percent_result_of_the_contract_example(spark):
    row = spark.createDataFrame([(1920, 1080, [(192.0, 108.0, 960.0, 540.0, "Truck", 0.9)])],
                                "width int, height int, boxes array<struct<x1:double,y1:double,x2:double,y2:double,label:string,score:double>>")
    result = ob.prediction_results(row).first()["result"][0].asDict(True)
    assert result["value"] == {"x": 10.0, "y": 10.0, "width": 40.0, "height": 40.0, "rotation": 0, "rectanglelabels": ["Truck"]}
    rest = {k: v for k, v in result.items() if k != "value"}
    assert rest == {"from_name": "label", "to_name": "image", "type": "rectanglelabels", "origin": "prediction",
                    "original_width": 1920, "original_height": 1080, "image_rotation": 0, "score": 0.9}


def test_box_checks_catch_nan_infinity_and_order(boxes):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, "a", 0, 0.0, 0.0, 1.0, 1.0, 0.0), (2, "a", 0, nan, 0.0, 1.0, 1.0, 0.5), (3, "a", 0, 0.0, 0.0, nan, 1.0, 0.5),
        (4, "a", 0, 0.0, 0.0, inf, 1.0, 0.5), (5, "a", 0, 1.0, 0.0, 1.0, 1.0, 0.5), (6, "a", 0, -1.0, 0.0, 1.0, 1.0, 0.5),
        (7, "a", 0, 0.0, 0.0, 1.0, 1.0, nan), (8, "a", 0, 0.0, 0.0, 1.0, 1.0, 1.5), (9, "a", 0, None, 0.0, 1.0, 1.0, 0.5),
    ]
    got = {r["det_id"]: (r["ok"], list(r["reasons"])) for r in checks.validate_boxes(boxes(rows)).collect()}
    assert got[1] == (True, [])
    assert not any(got[i][0] for i in range(2, 10))
    assert got[3][1] == ["x2_range"] and got[4][1] == ["x2_range"] and got[5][1] == ["corner_order"]
    assert got[7][1] == ["score_range"] and got[9][1] == ["x1_range", "corner_order"]


def test_predictions_without_boxes_are_fine(spark):
    schema = "image_id string, width int, height int, model_version string, boxes array<struct<x1:double,y1:double,x2:double,y2:double,label:string,score:double,track_id:string>>"
    df = spark.createDataFrame([("a", 10, 10, "m", None), ("b", 0, 10, None, [(0.0, 0.0, 5.0, 0.0, None, 0.2, None)])], schema)
    got = {r["image_id"]: r for r in checks.validate_predictions(df).collect()}
    assert got["a"]["ok"] and got["a"]["boxes"] == []
    assert set(got["b"]["reasons"]) == {"model_version_missing", "width_range", "box 0: y2_range", "box 0: corner_order", "box 0: label_missing"}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(*[st.floats(-500, 2500, allow_nan=False) for _ in range(4)]), min_size=1, max_size=40))
def test_clip_is_idempotent_and_round_trip_holds(boxes, corners):
    df = boxes([(i, "a", 0, *map(float, c), 0.5) for i, c in enumerate(corners)])
    once = ob.clip_boxes(df)
    assert once.exceptAll(ob.clip_boxes(once)).isEmpty()
    worst = ob.round_trip_error(df).agg(F.max("edge_error")).first()[0]
    assert worst is None or worst <= 1.0


def polygon_share_of(spark, points, box):
    row = spark.createDataFrame([([[tuple(map(float, p)) for p in points]], *map(float, box))],
                                "p array<array<struct<x:double,y:double>>>, x1 double, y1 double, x2 double, y2 double")
    return row.select(ob.polygon_share(F.col("p"), g.corners())).first()[0]


def test_polygon_overlap(spark):
    triangle = [(0, 0), (10, 0), (0, 10)]
    assert polygon_share_of(spark, triangle, (0, 0, 10, 10)) == pytest.approx(0.5)
    assert polygon_share_of(spark, triangle, (5, 5, 10, 10)) == pytest.approx(0.0)
    assert polygon_share_of(spark, triangle, (1, 1, 3, 3)) == pytest.approx(1.0)
    concave = [(0, 0), (8, 0), (8, 8), (4, 2), (0, 8)]
    box = (1.0, 1.0, 7.0, 6.0)

    def inside(x, y):
        hit, j = False, len(concave) - 1
        for i, (xi, yi) in enumerate(concave):
            xj, yj = concave[j]
            if (yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi:
                hit = not hit
            j = i
        return hit

    n = 300
    cells = [(box[0] + (a + 0.5) * 6 / n, box[1] + (b + 0.5) * 5 / n) for a in range(n) for b in range(n)]
    grid = sum(inside(x, y) for x, y in cells) / n**2
    assert polygon_share_of(spark, concave, box) == pytest.approx(grid, abs=2e-3)
    assert polygon_share_of(spark, concave[::-1], box) == pytest.approx(grid, abs=2e-3)


def test_touching_boxes_have_no_overlap(spark):
    row = spark.sql("SELECT struct(0D x1, 0D y1, 2D x2, 2D y2) a, struct(2D x1, 0D y1, 4D x2, 2D y2) b")
    assert row.select(g.iou(g.corners("a"), g.corners("b"))).first()[0] == 0.0


@pytest.mark.parametrize("k,n,passes", [(200, 200, True), (199, 200, False), (279, 280, True), (278, 279, False), (359, 361, True), (434, 437, True)])
def test_wilson_bound(spark, k, n, passes):
    bound = spark.range(1).select(s.wilson_lower(F.lit(k), F.lit(n))).first()[0]
    assert (bound >= 0.98) is passes
    if (k, n) == (200, 200):
        assert bound == pytest.approx(0.98115, abs=1e-5)
    if (k, n) == (199, 200):
        assert bound == pytest.approx(0.97223, abs=1e-5)


def test_wilson_without_trials_is_null(spark):
    assert spark.range(1).select(s.wilson_lower(F.lit(0), F.lit(0))).first()[0] is None


def test_stem_time(spark):
    df = spark.createDataFrame([("20260611_165130_934602",), ("frame-1",)], "stem string")
    got = [r[0] for r in df.select(F.unix_micros(s.stem_timestamp("stem"))).collect()]
    assert got == [1781196690934602, None]


def test_tiles_cover_the_image_and_untile_moves_back(spark, boxes):
    images = spark.createDataFrame([("a", 1920, 1080), ("b", 300, 200)], "image_id string, width int, height int")
    tiles = ob.make_tiles(images).collect()
    assert sorted((t["tile_x"], t["tile_y"]) for t in tiles if t["image_id"] == "a") == [(x, y) for x in (0, 512, 1024, 1280) for y in (0, 440)]
    assert [(t["tile_width"], t["tile_height"]) for t in tiles if t["image_id"] == "b"] == [(300, 200)]
    across = boxes([(1, "a", 0, 600.0, 100.0, 700.0, 200.0, 0.9)])
    back = ob.untile(ob.cut_to_tiles(across)).select("x1", "x2").collect()
    assert sorted((r["x1"], r["x2"]) for r in back) == [(600.0, 640.0), (600.0, 700.0)]


def test_unmapped_class_fails_the_migration(spark, boxes):
    mapping = spark.createDataFrame([(0, 3)], "class_id int, new_class_id int")
    assert ob.migrate_taxonomy(boxes([(1, "a", 0, 0.0, 0.0, 1.0, 1.0, 0.5)]), mapping).first()["class_id"] == 3
    with pytest.raises(Exception, match="without a migration"):
        ob.migrate_taxonomy(boxes([(1, "a", 1, 0.0, 0.0, 1.0, 1.0, 0.5)]), mapping).collect()


def test_class_mapping_is_exact(spark):
    df = spark.createDataFrame([("Car",), ("car",), ("BoxTruck",)], "label string")
    got = {r["label"]: (r["class_id"], r["class_status"]) for r in checks.map_classes(df, readers.taxonomy(spark)).collect()}
    assert got == {"Car": (0, "active"), "car": (None, "unknown"), "BoxTruck": (None, "inactive")}


def test_bits_and_entropy(spark):
    row = spark.range(1).select(s.hamming(F.lit(0b1011), F.lit(0b0001)), s.binary_entropy(F.lit(0.5)), s.temperature_scaled(F.lit(0.8), F.lit(1.0))).first()
    assert row[0] == 2 and row[1] == pytest.approx(1.0) and math.isclose(row[2], 0.8)


def test_tiles_of_boxes_by_batches(spark):
    from boxloom.functions.user import TileCuts

    rows = [(1, 10.0, 10.0, 30.0, 30.0, 1920, 1080), (2, 600.0, 10.0, 700.0, 30.0, 1920, 1080), (3, 5.0, 5.0, 5.0, 9.0, 1920, 1080), (4, None, 0.0, 9.0, 9.0, 1920, 1080),
            (5, 0.0, 0.0, 9.0, 9.0, None, 1080), (None, 0.0, 0.0, 9.0, 9.0, 300, 200), (1, 10.0, 10.0, 30.0, 30.0, 1920, 1080)]
    spark.createDataFrame(rows, "det_id long, x1 double, y1 double, x2 double, y2 double, width int, height int").createOrReplaceTempView("cuts_in")
    spark.udtf.register("tile_cuts", TileCuts)
    got = [tuple(r) for r in spark.sql("SELECT * FROM tile_cuts(TABLE(SELECT * FROM cuts_in), 640, 128)").collect()]
    assert sorted(got, key=str) == sorted([(1, 0, 0), (1, 0, 0), (2, 0, 0), (2, 512, 0), (None, 0, 0)], key=str)
    assert spark.sql("SELECT * FROM tile_cuts(TABLE(SELECT * FROM cuts_in WHERE det_id > 9), 640, 128)").count() == 0


def clipped_area(points, box):
    """Clip by the four sides, then shoelace."""
    for axis, at, sign in ((0, box[0], 1), (0, box[2], -1), (1, box[1], 1), (1, box[3], -1)):
        kept = []
        for p, q in zip(points, points[1:] + points[:1]):
            if (p[axis] - at) * sign >= 0:
                kept.append(p)
            if ((p[axis] - at) * sign >= 0) != ((q[axis] - at) * sign >= 0):
                share = (at - p[axis]) / (q[axis] - p[axis])
                kept.append(tuple(at if i == axis else p[i] + share * (q[i] - p[i]) for i in (0, 1)))
        points = kept
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, points[1:] + points[:1]))) / 2


def test_outline_share_equals_clipping_and_is_exact_over_whole_pixels(spark):
    """Edges are prepared once per camera; a box costs one closed sum over them, not four clips of each polygon."""
    rng = random.Random(5)
    cases = []
    for _ in range(300):
        at = sorted(rng.uniform(0, 6.28) for _ in range(rng.randint(3, 9)))
        star = [(100 + r * math.cos(a), 100 + r * math.sin(a)) for a in at for r in [rng.uniform(5, 90)]]
        x, y = rng.uniform(0, 180), rng.uniform(0, 180)
        cases.append((star, (x, y, x + rng.uniform(1, 120), y + rng.uniform(1, 120))))
    shape = [(0.0, 1080.0), (0.0, 700.0), (600.0, 700.0), (600.0, 850.0), (1920.0, 850.0), (1920.0, 1080.0)]
    cases.append((shape, (590.0, 690.0, 613.0, 857.0)))
    cases.append((shape, (590.0, 600.0, 613.0, 700.0)))
    rows = spark.createDataFrame([(i, [p], *b) for i, (p, b) in enumerate(cases)], "i int, p array<array<struct<x:double,y:double>>>, x1 double, y1 double, x2 double, y2 double")
    got = dict(rows.select("i", (ob.outline_share(ob.polygon_outline(F.col("p")), g.corners()) * g.area(g.corners())).alias("a")).collect())
    for i, (points, box) in enumerate(cases):
        assert got[i] == pytest.approx(clipped_area(points, box), abs=1e-6)
    assert got[300] == pytest.approx(10 * 157 + 13 * 7, abs=1e-9) and got[301] == 0.0
    none = rows.limit(1).select(ob.outline_share(ob.polygon_outline(F.lit(None).cast("array<array<struct<x:double,y:double>>>")), g.corners()))
    assert none.first()[0] == 0.0
