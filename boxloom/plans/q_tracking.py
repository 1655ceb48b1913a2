"""Queries over ordered frames: association, statistics, refinement, guards, user predictors."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.functions import geometry as g
from boxloom.functions.user import predict_images
from boxloom.operators import manifest as m, pairs, review, tracking as tr
from boxloom.plans.oracle_parts import ORACLE_VIEWS, greedy, iou_sql
from boxloom.plans.q_boxes import rounded
from boxloom.plans.registry import Inputs, query
from boxloom.session import checkpointed
from boxloom.sources.readers import nest_predictions

OVERLAP = "a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2"


def lanes(t: Inputs):
    """Boxes with sequence and continuity segment from the image table."""
    images = m.continuity_segments(m.assign_sequences(t.images))
    images = checkpointed(images)
    return t.track_boxes.drop("camera_id", "capture_us").join(images.select("image_id", "camera_id", "sequence_id", "segment_id"), "image_id")


def passes_sql(first: str, pick: str, after: str) -> str:
    """What association must give here: objects never meet, so a track is a given track from its first strong box on."""
    return f"""SELECT t.det_id, t.image_id, t.camera_id, t.frame_id, CASE WHEN t.frame_id {after}= s.f THEN concat('t', s.d) END AS track_id,
        CASE WHEN t.frame_id = s.f THEN 'start' WHEN t.frame_id {after} s.f THEN CASE WHEN t.score >= 0.5 THEN 'strong' ELSE 'weak' END END AS association
        FROM tracks t JOIN (SELECT track_id, {first}(frame_id) AS f, {pick}(det_id, frame_id) AS d FROM tracks WHERE score >= 0.5 GROUP BY track_id) s ON t.track_id = s.track_id"""


ORACLE_VIEWS["o_forward"] = passes_sql("min", "arg_min", ">")
ORACLE_VIEWS["o_backward"] = passes_sql("max", "arg_max", "<")


@query("SELECT det_id, camera_id, frame_id, track_id, association FROM o_forward")
def track(t: Inputs):
    return tr.track(lanes(t)).select("det_id", "camera_id", "frame_id", "track_id", "association")


@query("SELECT det_id, camera_id, frame_id, track_id, association FROM o_backward")
def track_backward(t: Inputs):
    return tr.track(lanes(t), reverse=True).select("det_id", "camera_id", "frame_id", "track_id", "association")


@query(f"""SELECT d.det_id, coalesce(bool_or(b.frame_id < d.frame_id), false) AS support_before, coalesce(bool_or(b.frame_id > d.frame_id), false) AS support_after
    FROM track_boxes d LEFT JOIN (SELECT a.det_id, b.frame_id FROM track_boxes a JOIN track_boxes b ON a.camera_id = b.camera_id AND b.frame_id IN (a.frame_id - 1, a.frame_id + 1)
        AND CAST((a.frame_id - a.frame_id % 50)/50 AS BIGINT) = CAST((b.frame_id - b.frame_id % 50)/50 AS BIGINT) AND {OVERLAP} WHERE {iou_sql()} >= 0.5) b ON b.det_id = d.det_id GROUP BY d.det_id""")
def adjacent_support(t: Inputs):
    rows = t.track_boxes.drop("capture_us").join(m.assign_sequences(t.images).select("image_id", "sequence_id"), "image_id")
    return pairs.adjacent_support(rows, 1, 0.5).select("det_id", "support_before", "support_after")


STEP = """SELECT *, frame_id - lag(frame_id) OVER w AS frame_step, lag(x1) OVER w AS px1, lag(y1) OVER w AS py1, lag(x2) OVER w AS px2, lag(y2) OVER w AS py2
    FROM tracks WINDOW w AS (PARTITION BY track_id ORDER BY frame_id)"""
SHIFT = "sqrt(pow((x1 + x2)/2 - (px1 + px2)/2, 2) + pow((y1 + y2)/2 - (py1 + py2)/2, 2))"
CHANGE = "abs(((x2 - x1)*(y2 - y1)) / ((px2 - px1)*(py2 - py1)) - 1)"


@query(f"SELECT det_id, frame_step, round({SHIFT}, 6) AS centre_shift, round({CHANGE}, 6) AS size_change FROM ({STEP}) z")
def jitter(t: Inputs):
    return rounded(tr.jitter(t.tracks), "centre_shift", "size_change").select("det_id", "frame_step", "centre_shift", "size_change")


@query(f"""SELECT track_id, min(frame_id) AS first_frame, max(frame_id) AS last_frame, max(frame_id) - min(frame_id) + 1 AS age, count(*) AS hits,
    count(*) FILTER (WHERE frame_step > 1) AS gaps, round(avg(score), 6) AS mean_score, round(avg({SHIFT}), 6) AS mean_shift, round(max({CHANGE}), 6) AS max_size_change
    FROM ({STEP}) z GROUP BY track_id""")
def track_stats(t: Inputs):
    return rounded(tr.track_stats(t.tracks), "mean_score", "mean_shift", "max_size_change")


@query("""SELECT t.det_id, t.score < 0.5 AND s.n >= 3 AND s.n >= 0.5 * (s.l - s.f + 1) AND t.frame_id > s.f AND t.frame_id < s.l AS recovered
    FROM tracks t JOIN (SELECT track_id, count(*) AS n, min(frame_id) AS f, max(frame_id) AS l FROM tracks GROUP BY track_id) s ON t.track_id = s.track_id""")
def recover_weak(t: Inputs):
    return tr.recover_weak(t.tracks, 0.5).select("det_id", "recovered")


@query("""SELECT det_id, count(*) OVER (PARTITION BY track_id ORDER BY frame_id RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) < 3 AS isolated FROM tracks""")
def suppress_isolated(t: Inputs):
    return tr.suppress_isolated(t.tracks, min_hits=3, window=1).select("det_id", "isolated")


SMOOTH = """SELECT *, n > 1 AND big <= 1.5 * little AS smoothed FROM (
    SELECT det_id, track_id, frame_id, class_id, score, x1, y1, x2, y2, avg(x1) OVER w AS m1, avg(y1) OVER w AS m2, avg(x2) OVER w AS m3, avg(y2) OVER w AS m4, count(*) OVER w AS n,
           max((x2 - x1)*(y2 - y1)) OVER w AS big, min((x2 - x1)*(y2 - y1)) OVER w AS little
    FROM tracks WINDOW w AS (PARTITION BY track_id ORDER BY frame_id RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)) z"""


@query(f"""SELECT det_id, smoothed, round(CASE WHEN smoothed THEN m1 ELSE x1 END, 6) AS s_x1, round(CASE WHEN smoothed THEN m2 ELSE y1 END, 6) AS s_y1,
    round(CASE WHEN smoothed THEN m3 ELSE x2 END, 6) AS s_x2, round(CASE WHEN smoothed THEN m4 ELSE y2 END, 6) AS s_y2 FROM ({SMOOTH}) y""")
def smooth(t: Inputs):
    return rounded(tr.smooth(t.tracks), "s_x1", "s_y1", "s_x2", "s_y2").select("det_id", "smoothed", "s_x1", "s_y1", "s_x2", "s_y2")


GAPS = """SELECT track_id, frame_id + i AS frame_id, 1 AS class_id, round(x1 + i * (nx1 - x1) / (nf - frame_id), 6) AS x1, round(y1 + i * (ny1 - y1) / (nf - frame_id), 6) AS y1,
    round(x2 + i * (nx2 - x2) / (nf - frame_id), 6) AS x2, round(y2 + i * (ny2 - y2) / (nf - frame_id), 6) AS y2
    FROM (SELECT *, lead(frame_id) OVER w AS nf, lead(x1) OVER w AS nx1, lead(y1) OVER w AS ny1, lead(x2) OVER w AS nx2, lead(y2) OVER w AS ny2 FROM tracks WINDOW w AS (PARTITION BY track_id ORDER BY frame_id)) z
    JOIN (SELECT unnest(range(1, 4)) AS i) r ON i < nf - frame_id WHERE nf - frame_id - 1 BETWEEN 1 AND 3"""


@query(GAPS)
def propose_gaps(t: Inputs):
    return rounded(tr.propose_gaps(t.tracks), *g.CORNERS).drop("source")


@query(f"""SELECT source, count(*) AS boxes, count(*) FILTER (WHERE smoothed) AS smoothed, round(sum(sx), 3) AS sum_x1 FROM (
    SELECT 'detector' AS source, smoothed, CASE WHEN smoothed THEN m1 ELSE x1 END AS sx FROM ({SMOOTH}) y UNION ALL SELECT 'tracker', false, x1 FROM ({GAPS}) g) z GROUP BY source""")
def refine(t: Inputs):
    out = tr.refine(t.tracks)
    return out.groupBy("source").agg(F.count(F.lit(1)).alias("boxes"), F.count_if("smoothed").alias("smoothed"), F.round(F.sum("s_x1"), 3).alias("sum_x1"))


@query(f"SELECT det_id, round(greatest(abs(m1 - x1), abs(m2 - y1), abs(m3 - x2), abs(m4 - y2)), 6) AS edge_move, false AS class_changed FROM ({SMOOTH}) y")
def refinement_audit(t: Inputs):
    return rounded(tr.refinement_audit(t.tracks, tr.refine(t.tracks)), "edge_move").select("det_id", "edge_move", "class_changed")


@query("SELECT det_id, 'tracker' AS source, 'unreviewed_prediction' AS review_status FROM tracks")
def mark_propagated(t: Inputs):
    return review.mark_propagated(t.tracks).select("det_id", "source", "review_status")


# backward boxes: some moved, some of another class, some absent
ORACLE_VIEWS["o_bwd"] = """SELECT det_id, image_id, CASE WHEN det_id % 17 = 0 THEN 3 ELSE class_id END AS class_id, x1 + det_id % 7 * 12 AS x1, y1, x2 + det_id % 7 * 12 AS x2, y2
    FROM tracks WHERE det_id % 19 <> 0"""
ORACLE_VIEWS["o_con_pairs"] = f"""SELECT a.image_id, a.det_id AS fwd_id, b.det_id AS bwd_id, a.class_id AS ca, b.class_id AS cb, {iou_sql()} AS iou
    FROM tracks a JOIN o_bwd b ON a.image_id = b.image_id AND {OVERLAP} WHERE {iou_sql()} >= 0.5"""
ORACLE_VIEWS.update(greedy("o_con_pairs", "image_id", "fwd_id", "bwd_id", "o_con", 3))


@query("""SELECT a.det_id AS fwd_id, b.det_id AS bwd_id, CASE WHEN a.class_id = b.class_id THEN 'trusted' ELSE 'review' END AS verdict, CASE WHEN a.class_id = b.class_id THEN 'normal' ELSE 'high' END AS priority
    FROM (SELECT t.det_id, t.class_id, m.bwd_id FROM tracks t LEFT JOIN o_con m ON t.det_id = m.fwd_id) a FULL JOIN o_bwd b ON a.bwd_id = b.det_id""")
def consensus(t: Inputs):
    back = t.tracks.filter("det_id % 19 <> 0").withColumns({
        "class_id": F.expr("CASE WHEN det_id % 17 = 0 THEN 3 ELSE class_id END"),
        "x1": F.expr("x1 + det_id % 7 * 12"), "x2": F.expr("x2 + det_id % 7 * 12"),
    })
    return tr.consensus(t.tracks, back).select("fwd_id", "bwd_id", "verdict", "priority")


@query("""SELECT f.det_id AS fwd_id, b.det_id AS bwd_id, CASE WHEN f.det_id = b.det_id THEN 'trusted' ELSE 'review' END AS verdict
    FROM (SELECT det_id FROM o_forward WHERE track_id IS NOT NULL) f FULL JOIN (SELECT det_id FROM o_backward WHERE track_id IS NOT NULL) b ON f.det_id = b.det_id""")
def consensus_of_passes(t: Inputs):
    """Forward and backward association of the same boxes, compared track by track."""
    rows = checkpointed(lanes(t))
    fwd, bwd = tr.track(rows), tr.track(rows, reverse=True)
    kept = [checkpointed(d.filter("track_id IS NOT NULL").select("image_id", "det_id", "class_id", *g.CORNERS)) for d in (fwd, bwd)]
    return tr.consensus(*kept).select("fwd_id", "bwd_id", "verdict")


CHANGES = """SELECT object_id, frame_id, track_id IS NOT NULL AND ptrack IS NOT NULL AND ptrack <> track_id AS id_switch,
    track_id IS NOT NULL AND NOT coalesce(phit, true) AND ptrack IS NOT NULL AS fragmented
    FROM (SELECT *, lag(track_id IS NOT NULL) OVER w AS phit, last_value(track_id IGNORE NULLS) OVER (PARTITION BY object_id ORDER BY frame_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ptrack
          FROM (SELECT track_id AS object_id, frame_id, CASE WHEN det_id % 23 = 0 THEN NULL ELSE track_id || '/' || CAST((frame_id - frame_id % 20)/20 AS BIGINT) END AS track_id FROM tracks) a
          WINDOW w AS (PARTITION BY object_id ORDER BY frame_id)) z"""


@query(f"SELECT * FROM ({CHANGES}) y")
def identity_changes(t: Inputs):
    rows = t.tracks.select(F.col("track_id").alias("object_id"), "frame_id", "class_id", F.expr(
        "CASE WHEN det_id % 23 = 0 THEN NULL ELSE concat(track_id, '/', CAST(CAST((frame_id - frame_id % 20)/20 AS BIGINT) AS STRING)) END").alias("track_id"))
    return tr.identity_changes(rows).select("object_id", "frame_id", "id_switch", "fragmented")


def objects(t: Inputs):
    return t.tracks.select("image_id", F.col("det_id").alias("annotation_id"), F.col("track_id").alias("object_id"), "frame_id", "class_id", *g.CORNERS)


ERRORS = """count(*) FILTER (WHERE association = 'weak') AS recovered, CAST(1 AS DOUBLE) AS recovery_precision, CAST(0 AS BIGINT) AS propagated,
    CAST(0 AS BIGINT) AS false_propagation, CAST(0 AS BIGINT) AS id_switches, CAST(0 AS BIGINT) AS fragmentations, CAST(0 AS BIGINT) AS class_changes"""


@query(f"SELECT {ERRORS} FROM o_forward")
def track_errors(t: Inputs):
    return tr.track_errors(checkpointed(tr.track(lanes(t)).filter("track_id IS NOT NULL")), objects(t))


@query(f"""SELECT method, count(track_id) AS boxes, (SELECT count(*) FROM tracks) AS truths, count(track_id) AS tp, any_value(m) AS mean_iou, {ERRORS}
    FROM o_forward CROSS JOIN (SELECT 'tracker' AS method, 1.0 AS m UNION ALL SELECT 'challenger', round(118.0 / 122.0, 6)) k GROUP BY method""")
def compare_propagation(t: Inputs):
    a = checkpointed(tr.track(lanes(t)).filter("track_id IS NOT NULL"))
    b = a.withColumns({"x1": F.col("x1") + 2, "x2": F.col("x2") + 2})
    return rounded(tr.compare_propagation(a, b, objects(t)), "mean_iou")


# boxes with planted faults: a class change, a jump over a cut, thin tracks
FAULTY = """SELECT track_id, frame_id, CASE WHEN det_id % 211 = 0 THEN 3 ELSE class_id END AS class_id, CASE WHEN frame_id % 50 >= 45 AND camera_id = 'back' THEN 1 ELSE 0 END AS segment_id,
    CASE WHEN det_id % 10 = 2 AND frame_id % 50 BETWEEN 10 AND 20 THEN 'tracker' ELSE 'detector' END AS source FROM tracks"""


@query(f"""
    SELECT track_id, NULL AS frame_id, 'class_change' AS violation FROM ({FAULTY}) f GROUP BY track_id HAVING count(DISTINCT class_id) > 1
    UNION ALL SELECT track_id, NULL, 'bridges_cut' FROM ({FAULTY}) f GROUP BY track_id HAVING count(DISTINCT segment_id) > 1
    UNION ALL SELECT track_id, NULL, 'few_hits' FROM ({FAULTY}) f GROUP BY track_id HAVING count(*) FILTER (WHERE source = 'detector') < 2
    UNION ALL SELECT track_id, frame_id, CASE WHEN source = 'detector' THEN 'long_gap' ELSE 'no_detector_support' END FROM (
        SELECT *, last_value(real IGNORE NULLS) OVER (PARTITION BY track_id ORDER BY frame_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
                  first_value(real IGNORE NULLS) OVER (PARTITION BY track_id ORDER BY frame_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n
        FROM (SELECT *, CASE WHEN source = 'detector' THEN frame_id END AS real FROM ({FAULTY}) f) g) h
    WHERE (source = 'detector' AND frame_id - b - 1 > 3) OR (source <> 'detector' AND NOT coalesce(frame_id - b <= 3 AND n - frame_id <= 3, false))""")
def temporal_guards(t: Inputs):
    rows = t.tracks.select(
        "track_id", "frame_id", F.expr("CASE WHEN det_id % 211 = 0 THEN 3 ELSE class_id END").alias("class_id"),
        F.expr("CASE WHEN frame_id % 50 >= 45 AND camera_id = 'back' THEN 1 ELSE 0 END").alias("segment_id"),
        F.expr("CASE WHEN det_id % 10 = 2 AND frame_id % 50 BETWEEN 10 AND 20 THEN 'tracker' ELSE 'detector' END").alias("source"),
    )
    return tr.temporal_guards(rows)


class GridModel:
    """A stand-in predictor: the box follows from the path, some paths fail."""

    model_version = "grid-1"

    def predict(self, image_path: str) -> dict:
        number = int(image_path.rsplit("/", 1)[1])
        if number % 101 == 0:
            raise ValueError("unreadable")
        left = float(number % 1500)
        box = {"x1": left, "y1": 10.0, "x2": left + 100.0, "y2": 90.0, "label": "Truck", "score": 0.5}
        return {"width": 1920, "height": 1080, "boxes": [box]}


@query("""SELECT CAST(image_id AS VARCHAR) AS image_id, 'grid-1' AS model_version, CASE WHEN image_id % 101 = 0 THEN 0 ELSE 1 END AS boxes,
    CASE WHEN image_id % 101 <> 0 THEN CAST(image_id % 1500 AS DOUBLE) END AS x1, image_id % 101 = 0 AS failed FROM images""")
def predict_with_user_model(t: Inputs):
    rows = t.images.withColumn("relative_path", F.concat_ws("/", "camera_id", F.col("image_id").cast("string")))
    out = predict_images(rows, GridModel)
    return out.select("image_id", "model_version", F.size("boxes").alias("boxes"), F.get("boxes", F.lit(0))["x1"].alias("x1"), F.col("error").isNotNull().alias("failed"))


@query("SELECT CAST(image_id AS VARCHAR) AS image_id, count(*) AS boxes, round(sum(x1), 3) AS sum_x1 FROM det GROUP BY image_id")
def nest_and_flatten(t: Inputs):
    from boxloom.sources.readers import flatten_predictions

    flat = t.det.select(F.col("image_id").cast("string").alias("image_id"), "width", "height", F.lit("m1").alias("model_version"), F.col("det_id").alias("box_no"),
                        *g.CORNERS, F.lit("Truck").alias("label"), "score", F.lit(None).cast("string").alias("track_id"))
    back = flatten_predictions(nest_predictions(flat))
    return back.groupBy("image_id").agg(F.count(F.lit(1)).alias("boxes"), F.round(F.sum("x1"), 3).alias("sum_x1"))
