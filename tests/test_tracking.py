import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from boxloom.operators import tracking as tr

SCHEMA = "sequence_id string, camera_id string, segment_id bigint, frame_id bigint, det_id bigint, class_id int, x1 double, y1 double, x2 double, y2 double, score double"


def path(start, n, x=100.0, step=8.0, skip=(), cls=1, y=100.0, weak=(), segment=0, camera="front"):
    return [("s00", camera, segment, f, start + f, cls, x + step * f, y, x + step * f + 60, y + 40, 0.3 if f in weak else 0.9) for f in range(n) if f not in skip]


def tracked(spark, rows, cfg=tr.TrackConfig(), **kw):
    out = tr.track(spark.createDataFrame(rows, SCHEMA), cfg, **kw)
    return {r["det_id"]: (r["track_id"], r["association"]) for r in out.collect()}


def test_hole_and_weak_boxes_stay_in_the_track(spark):
    got = tracked(spark, path(0, 12, skip=(5,), weak=(8,)))
    assert {t for t, _ in got.values()} == {"t0"}
    assert got[8][1] == "weak" and got[0][1] == "start" and got[6][1] == "strong"


def test_weak_boxes_start_nothing(spark):
    assert set(tracked(spark, path(0, 4, weak=range(4))).values()) == {(None, None)}


def test_long_gap_class_camera_and_segment_end_a_track(spark):
    rows = path(0, 12, skip=range(4, 9)) + path(100, 4, cls=3, y=100.0) + path(200, 4, camera="back") + path(300, 4, segment=1, y=100.0)
    got = tracked(spark, rows)
    assert len({t for t, _ in got.values()}) == 5
    assert got[9][0] == "t9" and got[100][0] == "t100"


def test_crossing_objects_keep_their_tracks(spark):
    rows = path(0, 21, x=100.0, step=10.0) + path(100, 21, x=300.0, step=-10.0, y=115.0)
    got = tracked(spark, rows, tr.TrackConfig(min_iou=0.1))
    assert {got[f][0] for f in range(21)} == {"t0"} and {got[100 + f][0] for f in range(21)} == {"t100"}


@pytest.mark.parametrize("reverse", [False, True])
def test_relay_of_blocks_equals_one_block(spark, reverse):
    rows = path(0, 40, skip=(3, 11, 12, 30), weak=(7, 20)) + path(100, 40, x=500.0, skip=range(17, 25)) + path(200, 40, y=500.0, camera="back")
    whole = tracked(spark, rows, reverse=reverse)
    assert tracked(spark, rows, reverse=reverse, block_frames=6) == whole


def test_associate_prefers_overlap_then_track_id():
    boxes = pd.DataFrame([(0, 1, 0.0, 0.0, 10.0, 10.0), (0, 2, 0.0, 0.0, 10.0, 10.0), (1, 3, 0.0, 0.0, 10.0, 10.0)],
                         columns=["frame_id", "det_id", "x1", "y1", "x2", "y2"]).assign(strong=True)
    found, live = tr.associate(pd.DataFrame(columns=tr.STATE), boxes, tr.TrackConfig(), 0.3, 200.0)
    assert dict(zip(found["det_id"], found["track_id"])) == {1: "t1", 2: "t2", 3: "t1"} and len(live) == 2


def simple(spark, rows):
    return spark.createDataFrame(rows, "track_id string, frame_id bigint, det_id bigint, class_id int, x1 double, y1 double, x2 double, y2 double, score double")


def test_smoothing_leaves_scale_jumps_alone(spark):
    rows = [("a", f, f, 1, 10.0 + d, 0.0, 50.0 + d, 40.0, 0.9) for f, d in enumerate((0.0, 3.0, 0.0))]
    rows += [("b", 0, 10, 1, 0.0, 0.0, 10.0, 10.0, 0.9), ("b", 1, 11, 1, 0.0, 0.0, 40.0, 40.0, 0.9)]
    got = {r["det_id"]: r for r in tr.smooth(simple(spark, rows)).collect()}
    assert got[1]["s_x1"] == pytest.approx(11.0) and got[1]["x1"] == 13.0 and got[1]["smoothed"]
    assert not got[10]["smoothed"] and got[11]["s_x2"] == 40.0


def test_gap_boxes_are_linear_and_bounded(spark):
    rows = [("a", 0, 0, 1, 0.0, 0.0, 10.0, 10.0, 0.9), ("a", 3, 3, 1, 30.0, 0.0, 40.0, 10.0, 0.9), ("a", 9, 9, 1, 90.0, 0.0, 100.0, 10.0, 0.9),
            ("c", 0, 20, 1, 0.0, 0.0, 10.0, 10.0, 0.9), ("c", 2, 22, 3, 0.0, 0.0, 10.0, 10.0, 0.9)]
    got = tr.propose_gaps(simple(spark, rows), max_gap=3).orderBy("frame_id").collect()
    assert [(r["track_id"], r["frame_id"], r["x1"], r["source"]) for r in got] == [("a", 1, 10.0, "tracker"), ("a", 2, 20.0, "tracker")]


def test_consensus(spark):
    box = "image_id string, det_id bigint, class_id int, x1 double, y1 double, x2 double, y2 double"
    fwd = spark.createDataFrame([("a", 1, 1, 0.0, 0.0, 10.0, 10.0), ("a", 2, 1, 50.0, 0.0, 60.0, 10.0)], box)
    bwd = spark.createDataFrame([("a", 7, 1, 1.0, 0.0, 11.0, 10.0), ("a", 8, 3, 50.0, 0.0, 60.0, 10.0), ("a", 9, 1, 90.0, 0.0, 99.0, 10.0)], box)
    got = {(r["fwd_id"], r["bwd_id"]): r["verdict"] for r in tr.consensus(fwd, bwd).collect()}
    assert got == {(1, 7): "trusted", (2, 8): "review", (None, 9): "review"}


def test_identity_changes(spark):
    rows = [("o", 0, "a", 1), ("o", 1, "a", 1), ("o", 2, None, None), ("o", 3, "a", 1), ("o", 4, "b", 1), ("o", 5, "b", 2)]
    df = spark.createDataFrame(rows, "object_id string, frame_id bigint, track_id string, class_id int")
    got = tr.identity_changes(df).agg(F.count_if("id_switch"), F.count_if("fragmented"), F.count_if("class_change")).first()
    assert tuple(got) == (1, 1, 1)


def random_lanes(seed, lanes=40, frames=15):
    """Boxes that meet, miss frames and tie, in lanes of differing length."""
    rng = np.random.default_rng(seed)
    rows = []
    for lane in range(lanes):
        for frame in range(int(rng.integers(1, frames))):
            for _ in range(int(rng.integers(0, 6))):
                x, y = rng.integers(0, 6, 2) * 10.0
                rows.append((lane, frame * int(rng.choice([1, 1, 1, 2])), x + 4 * frame, y, x + 4 * frame + 40.0, y + 30.0, bool(rng.random() < 0.6)))
    boxes = pd.DataFrame(rows, columns=["lane", "frame_id", "x1", "y1", "x2", "y2", "strong"])
    return boxes.assign(det_id=rng.permutation(len(boxes)) + 1).sort_values(["lane", "frame_id", "det_id"], ignore_index=True)


@pytest.mark.parametrize("seed", range(5))
def test_lanes_side_by_side_equal_lanes_one_by_one(seed):
    """Lanes are associated by thousands in one call, not in one Python group each."""
    boxes, cfg = random_lanes(seed), tr.TrackConfig(min_iou=0.2)
    want, left = set(), set()
    for lane, part in boxes.groupby("lane"):
        found, live = tr.associate(pd.DataFrame(columns=tr.STATE), part, cfg, 0.2 + lane % 2 / 4, 200.0)
        want |= set(found.itertuples(index=False, name=None))
        left |= {(lane, *row) for row in live.itertuples(index=False, name=None)}
    names = boxes["lane"].unique()
    lane = np.searchsorted(names, boxes["lane"])
    mixed = np.random.default_rng(seed).permutation(len(boxes))
    part = boxes.iloc[mixed]
    at, track_id, passes, live = tr.associate_lanes(
        lane[mixed], part["frame_id"].to_numpy(), part["det_id"].to_numpy(), part[tr.CORNERS].to_numpy(), part["strong"].to_numpy(),
        cfg, 0.2 + names % 2 / 4, np.full(len(names), 200.0),
    )
    assert set(zip(part["det_id"].to_numpy()[at], track_id, passes)) == want
    assert set(zip(names[live["lane"]], *[live[n] for n in tr.STATE])) == left


def test_short_lanes_share_one_call(spark):
    """500 lanes of a few boxes: one call of Python takes them together."""
    rows = [r for lane in range(500) for r in path(1000 * lane, 4, segment=lane)]
    out = tr.track(spark.createDataFrame(rows, SCHEMA))
    plan = out._jdf.queryExecution().toString()
    assert "pmod(xxhash64(sequence_id" in plan
    assert out.select("track_id").distinct().count() == 500
