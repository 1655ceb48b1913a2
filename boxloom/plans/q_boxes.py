"""Row-wise queries: checks, clipping, conversion, filters, tiles, expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.functions import geometry as g, scalars as s
from boxloom.constants import CAMERAS
from boxloom.operators import boxes as ob, checks, manifest, review
from boxloom.plans.oracle_parts import AREA, BAND, INTER, size_sql
from boxloom.plans.registry import Inputs, query
from boxloom.session import literal
from boxloom.sources import readers

R = "round({0}, 6) AS {0}"


def rounded(df, *names, digits=6):
    """Halves of the scaled double go up, as the checking engine rounds; `F.round` alone takes the decimal text of the value."""
    def near(n):
        scaled = F.round(F.col(n).cast("double") * float(10**digits), 0) / float(10**digits)
        return F.when(F.abs(F.col(n)) < 1e300, scaled).otherwise(F.col(n))

    return df.withColumns({n: near(n) for n in names})


def label_of(det):
    return det.withColumn("label", F.expr(
        "CASE WHEN det_id % 50 = 0 THEN 'Pedestrian' WHEN det_id % 50 = 1 THEN 'truck' WHEN class_id = 0 THEN 'Car' WHEN class_id = 1 THEN 'Truck' "
        "WHEN class_id = 2 THEN 'Bulldozer' WHEN class_id = 3 THEN 'Excavator' WHEN class_id = 4 THEN 'WaterTruck' ELSE 'Sign' END"))


@query("SELECT det_id, image_id, class_id, x1, y1, x2, y2 FROM o_det")
def clip_boxes(t: Inputs):
    return ob.clip_boxes(t.det).select("det_id", "image_id", "class_id", "x1", "y1", "x2", "y2")


@query("""SELECT (SELECT count(*) FROM det) AS boxes, (SELECT count(*) FROM det) - (SELECT count(*) FROM o_det) AS dropped""")
def clip_drop_counts(t: Inputs):
    return ob.clip_drop_counts(t.det)


BOX_REASONS = (
    "concat_ws(',', CASE WHEN NOT (x1 >= 0) THEN 'x1_range' END, CASE WHEN NOT (y1 >= 0) THEN 'y1_range' END, "
    "CASE WHEN NOT (x2 > 0) THEN 'x2_range' END, CASE WHEN NOT (y2 > 0) THEN 'y2_range' END, "
    "CASE WHEN isnan(score) OR NOT (score BETWEEN 0 AND 1) THEN 'score_range' END, CASE WHEN NOT (x2 > x1 AND y2 > y1) THEN 'corner_order' END)"
)
# some boxes are damaged on purpose: NaN scores and swapped corners
DAMAGED = """SELECT det_id, image_id, class_id, CASE WHEN det_id % 401 = 0 THEN x2 ELSE x1 END AS x1, y1, x2, y2,
    CASE WHEN det_id % 307 = 0 THEN CAST('NaN' AS DOUBLE) WHEN det_id % 307 = 1 THEN CAST(1.5 AS DOUBLE) ELSE score END AS score FROM det"""


def damaged(t: Inputs):
    nan = F.when(F.col("det_id") % 307 == 0, F.lit(float("nan"))).when(F.col("det_id") % 307 == 1, 1.5).otherwise(F.col("score"))
    return t.det.withColumns({"x1": F.when(F.col("det_id") % 401 == 0, F.col("x2")).otherwise(F.col("x1")), "score": nan})


@query(f"SELECT det_id, reasons, reasons = '' AS ok FROM (SELECT det_id, {BOX_REASONS} AS reasons FROM ({DAMAGED}) d) z")
def validate_boxes(t: Inputs):
    return checks.validate_boxes(damaged(t)).select("det_id", F.array_join("reasons", ",").alias("reasons"), "ok")


@query(f"""
    SELECT i.image_id, CAST(coalesce(n, 0) AS INTEGER) AS boxes, CAST(coalesce(bad, 0) AS INTEGER) AS reasons, coalesce(bad, 0) = 0 AS ok
    FROM images i LEFT JOIN (
        SELECT image_id, count(*) AS n, sum(len(list_filter(string_split(reasons, ','), lambda r: r <> ''))) AS bad
        FROM (SELECT image_id, {BOX_REASONS} AS reasons FROM ({DAMAGED}) d) z GROUP BY image_id) b ON i.image_id = b.image_id""")
def validate_predictions(t: Inputs):
    flat = label_of(damaged(t)).withColumns({"box_no": F.col("det_id"), "track_id": F.lit(None).cast("string")})
    boxes = flat.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("box_no", F.struct("x1", "y1", "x2", "y2", "label", "score", "track_id").alias("b")))).alias("_b"))
    nested = t.images.join(boxes.select("image_id", F.transform("_b", lambda b: b["b"]).alias("boxes")), "image_id", "left")
    nested = nested.withColumn("model_version", F.lit("m1"))
    out = checks.validate_predictions(nested)
    return out.select("image_id", F.size("boxes").alias("boxes"), F.size("reasons").alias("reasons"), "ok")


CLASS_SQL = (
    "CASE WHEN det_id % 50 = 0 THEN 'Pedestrian' WHEN det_id % 50 = 1 THEN 'truck' ELSE "
    "CASE class_id WHEN 0 THEN 'Car' WHEN 1 THEN 'Truck' WHEN 2 THEN 'Bulldozer' WHEN 3 THEN 'Excavator' WHEN 4 THEN 'WaterTruck' ELSE 'Sign' END END"
)


@query(f"""SELECT det_id, label, CASE WHEN label IN ('Pedestrian', 'truck') THEN NULL ELSE class_id END AS class_id,
    CASE label WHEN 'Pedestrian' THEN 'inactive' WHEN 'truck' THEN 'unknown' ELSE 'active' END AS class_status
    FROM (SELECT det_id, class_id, {CLASS_SQL} AS label FROM det) z""")
def map_classes(t: Inputs):
    return checks.map_classes(label_of(t.det).drop("class_id"), readers.taxonomy(t.spark)).select("det_id", "label", "class_id", "class_status")


def some_inactive(t: Inputs):
    return t.det.withColumn("class_id", F.expr("CASE WHEN det_id % 40 = 0 THEN 7 ELSE class_id END"))


@query("SELECT det_id, class_id FROM det WHERE det_id % 40 <> 0")
def active_only(t: Inputs):
    return checks.active_only(some_inactive(t), readers.taxonomy(t.spark)).select("det_id", "class_id")


@query("SELECT det_id, 7 AS class_id FROM det WHERE det_id % 40 = 0")
def inactive_boxes(t: Inputs):
    return checks.inactive_boxes(some_inactive(t), readers.taxonomy(t.spark)).select("det_id", "class_id")


THRESHOLDS = [(0, 0.2, 0.6), (1, 0.3, 0.8), (2, 0.1, 0.4), (3, 0.25, 0.7), (4, 0.15, 0.5), (5, 0.2, 0.55)]
THRESHOLD_SQL = "(VALUES " + ", ".join(f"({c}, CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for c, lo, hi in THRESHOLDS) + ") h(class_id, low, high)"


@query(f"SELECT d.det_id, d.score >= h.high AS strong FROM det d JOIN {THRESHOLD_SQL} ON d.class_id = h.class_id WHERE d.score >= h.low")
def filter_scores(t: Inputs):
    limits = literal(t.spark, THRESHOLDS, "class_id int, low double, high double")
    return ob.filter_scores(t.det, limits, ["class_id"]).select("det_id", "strong")


@query(f"""SELECT d.det_id, d.camera_id, h.low + 0.01 * c.camera_order AS low FROM det d JOIN {THRESHOLD_SQL} ON d.class_id = h.class_id
    JOIN (SELECT DISTINCT camera_id, camera_order FROM images) c ON d.camera_id = c.camera_id""")
def policy_lookup(t: Inputs):
    from boxloom.operators.scale import join_small

    rows = [(camera, cid, low + 0.01 * order) for cid, low, _ in THRESHOLDS for order, camera, *_ in CAMERAS]
    policy = literal(t.spark, rows, "camera_id string, class_id int, low double")
    return join_small(t.det, policy, ["camera_id", "class_id"]).select("det_id", "camera_id", "low")


def ignore_polygons(t: Inputs):
    """An L-shaped host-vehicle region per camera, moved down by the camera's order."""
    rows = []
    for order, name in enumerate(["front", "front_left", "front_right", "back", "back_left", "back_right"]):
        d = 20.0 * order
        shape = [(0.0, 1080.0), (0.0, 700.0 + d), (600.0, 700.0 + d), (600.0, 850.0 + d), (1920.0, 850.0 + d), (1920.0, 1080.0)]
        rows.append((name, [shape]))
    return literal(t.spark, rows, "camera_id string, ignore_polygons array<array<struct<x:double,y:double>>>")


IGNORE_SQL = f"""
    SELECT det_id, camera_id, (({INTER.format(a='d.', b='p.')}) + ({INTER.format(a='d.', b='q.')})) / {AREA.format(p='d.')} AS share
    FROM o_det d
    JOIN (SELECT DISTINCT camera_id AS cam, 0.0 AS x1, 700.0 + 20 * camera_order AS y1, 600.0 AS x2, 1080.0 AS y2 FROM images) p ON p.cam = d.camera_id
    JOIN (SELECT DISTINCT camera_id AS cam, 600.0 AS x1, 850.0 + 20 * camera_order AS y1, 1920.0 AS x2, 1080.0 AS y2 FROM images) q ON q.cam = d.camera_id"""


@query(f"SELECT det_id, round(share, 6) AS ignore_share, share >= 0.5 AS ignored FROM ({IGNORE_SQL}) z")
def mark_ignored(t: Inputs):
    out = ob.mark_ignored(ob.clip_boxes(t.det), ignore_polygons(t))
    return rounded(out, "ignore_share").select("det_id", "ignore_share", "ignored")


@query(f"SELECT camera_id, count(*) AS boxes, count(*) FILTER (WHERE share >= 0.5) AS ignored FROM ({IGNORE_SQL}) z GROUP BY camera_id")
def ignored_counts(t: Inputs):
    from boxloom.operators.metrics import ignored_counts as count

    return count(ob.mark_ignored(ob.clip_boxes(t.det), ignore_polygons(t)), ["camera_id"])


@query(f"SELECT det_id FROM ({IGNORE_SQL}) z WHERE share >= 0.5 OR camera_id NOT IN ('front', 'back')")
def in_road_region(t: Inputs):
    roads = ignore_polygons(t).filter(F.col("camera_id").isin("front", "back")).withColumnRenamed("ignore_polygons", "road_polygons")
    return ob.in_road_region(ob.clip_boxes(t.det), roads).select("det_id")


PCT_SQL = """SELECT det_id, x1 * 100 / width AS pct_x, y1 * 100 / height AS pct_y, (x2 - x1) * 100 / width AS pct_width,
    (y2 - y1) * 100 / height AS pct_height, score FROM o_det"""


@query(f"""SELECT det_id, 'label' AS from_name, 'image' AS to_name, 'rectanglelabels' AS type, 'prediction' AS origin, 1920 AS original_width,
    1080 AS original_height, 0 AS image_rotation, {', '.join(R.format(n) for n in ('pct_x', 'pct_y', 'pct_width', 'pct_height'))}, score FROM ({PCT_SQL}) z""")
def review_results(t: Inputs):
    flat = label_of(ob.clip_boxes(t.det))
    one = flat.select("det_id", "width", "height", F.array(F.struct("x1", "y1", "x2", "y2", "label", "score")).alias("boxes"))
    r = ob.prediction_results(one).select("det_id", F.inline("result"))
    return rounded(r.select(
        "det_id", "from_name", "to_name", "type", "origin", "original_width", "original_height", "image_rotation",
        *[F.col(f"value.{n}").alias(f"pct_{n}") for n in ("x", "y", "width", "height")], "score",
    ), "pct_x", "pct_y", "pct_width", "pct_height")


@query("SELECT det_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM o_det")
def percent_and_back(t: Inputs):
    there = ob.to_percent(ob.clip_boxes(t.det)).drop("x1", "y1", "x2", "y2")
    return rounded(ob.from_percent(there), *g.CORNERS).select("det_id", *g.CORNERS)


@query("SELECT count(*) AS boxes, count(*) AS within FROM o_det")
def round_trip_error(t: Inputs):
    return ob.round_trip_error(t.det).agg(F.count(F.lit(1)).alias("boxes"), F.count_if("ok").alias("within"))


@query("SELECT det_id, x1 AS x, y1 AS y, x2 - x1 AS w, y2 - y1 AS h FROM o_det")
def to_xywh(t: Inputs):
    return ob.to_xywh(ob.clip_boxes(t.det)).select("det_id", "x", "y", "w", "h")


@query("SELECT det_id, x1, y1, x2, y2 FROM o_det")
def from_xywh(t: Inputs):
    return ob.from_xywh(ob.to_xywh(ob.clip_boxes(t.det))).select("det_id", *g.CORNERS)


@query("SELECT image_id, CASE WHEN is_keyframe THEN 'keyframe' ELSE 'temporal_context' END AS role FROM images")
def assign_role(t: Inputs):
    return manifest.assign_role(t.images).select("image_id", "role")


@query("SELECT image_id FROM images WHERE is_keyframe")
def supervised(t: Inputs):
    return manifest.supervised(t.images).select("image_id")


@query(f"SELECT det_id, {size_sql(AREA.format(p=''))} AS size_bucket FROM o_det")
def size_bucket(t: Inputs):
    return ob.size_bucket(ob.clip_boxes(t.det)).select("det_id", "size_bucket")


@query(f"SELECT det_id, {BAND} AS score_band FROM det")
def score_band(t: Inputs):
    return ob.score_band(t.det).select("det_id", "score_band")


def policy_inputs(t: Inputs):
    d = F.col("det_id")
    return t.det.select(
        "det_id", F.col("score").alias("calibrated"), (d % 5).cast("int").alias("track_hits"), (d % 4 == 0).alias("teacher_evidence"),
        (d % 9 == 0).alias("ignored"), (d % 8 == 0).alias("disagreement"), (d % 13 == 0).alias("truncated"), F.col("class_id").isin(0, 2).alias("rare"),
    )


@query("""SELECT det_id, CASE
        WHEN score < 0.3 AND (det_id % 4 = 0 OR det_id % 5 >= 3) THEN 'manual_search'
        WHEN score >= 0.9 AND det_id % 5 >= 3 AND det_id % 9 <> 0 AND det_id % 8 <> 0 AND det_id % 13 <> 0 AND class_id NOT IN (0, 2) THEN 'auto_accept_candidate'
        ELSE 'review' END AS band, true AS requires_human FROM det""")
def policy_band(t: Inputs):
    return review.policy_band(policy_inputs(t), low=0.3, high=0.9).select("det_id", "band", "requires_human")


@query("""SELECT image_id, CASE WHEN image_id IN (SELECT image_id FROM det) THEN 'unreviewed_prediction' ELSE 'unreviewed' END AS annotation_status FROM images""")
def absence_status(t: Inputs):
    return review.absence_status(t.images, t.det).select("image_id", "annotation_status")


TILES = "(SELECT unnest([0, 512, 1024, 1280]) AS tile_x) a CROSS JOIN (SELECT unnest([0, 440]) AS tile_y) b"


@query(f"SELECT image_id, tile_x, tile_y, 640 AS tile_width, 640 AS tile_height FROM images CROSS JOIN {TILES}")
def make_tiles(t: Inputs):
    return ob.make_tiles(t.images).select("image_id", "tile_x", "tile_y", "tile_width", "tile_height")


@query(f"""SELECT det_id, tile_x, tile_y, greatest(x1, tile_x) AS x1, greatest(y1, tile_y) AS y1, least(x2, tile_x + 640) AS x2, least(y2, tile_y + 640) AS y2
    FROM o_det CROSS JOIN {TILES} WHERE x1 < tile_x + 640 AND x2 > tile_x AND y1 < tile_y + 640 AND y2 > tile_y""")
def untile(t: Inputs):
    return ob.untile(ob.cut_to_tiles(ob.clip_boxes(t.det))).select("det_id", "tile_x", "tile_y", *g.CORNERS)


@query(f"""SELECT det_id, tile_x, tile_y FROM o_det CROSS JOIN {TILES}
    WHERE x1 < tile_x + 640 AND x2 > tile_x AND y1 < tile_y + 640 AND y2 > tile_y""")
def tile_function(t: Inputs):
    """The table function form, called once per image size, its tiles joined to the boxes."""
    from boxloom.functions.user import TileBoxes

    t.spark.udtf.register("tile_boxes", TileBoxes)
    ob.clip_boxes(t.det).createOrReplaceTempView("clipped_boxes")
    return t.spark.sql("""SELECT d.det_id, t.tile_x, t.tile_y FROM clipped_boxes d
        JOIN (SELECT s.width, s.height, u.* FROM (SELECT DISTINCT width, height FROM clipped_boxes) s, LATERAL tile_boxes(s.width, s.height, 640, 128) u) t
          ON d.width = t.width AND d.height = t.height
        WHERE d.x1 < t.tile_x + 640 AND d.x2 > t.tile_x AND d.y1 < t.tile_y + 640 AND d.y2 > t.tile_y""")


@query(f"""SELECT det_id, tile_x, tile_y FROM o_det CROSS JOIN {TILES}
    WHERE x1 < tile_x + 640 AND x2 > tile_x AND y1 < tile_y + 640 AND y2 > tile_y AND x2 > x1 AND y2 > y1""")
def tile_table_function(t: Inputs):
    """The table function over whole Arrow batches of boxes."""
    from boxloom.functions.user import TileCuts

    t.spark.udtf.register("tile_cuts", TileCuts)
    ob.clip_boxes(t.det).select("det_id", *g.CORNERS, "width", "height").createOrReplaceTempView("boxes_to_cut")
    return t.spark.sql("SELECT * FROM tile_cuts(TABLE(SELECT * FROM boxes_to_cut), 640, 128)")


@query(f"SELECT det_id FROM o_det WHERE {AREA.format(p='')} >= 10000")
def min_area(t: Inputs):
    return ob.min_area(ob.clip_boxes(t.det), 10_000.0).select("det_id")


@query("SELECT det_id, x1 <= 2 OR y1 <= 2 OR x2 >= 1918 OR y2 >= 1078 AS touches_border FROM o_det")
def touches_border(t: Inputs):
    return ob.touches_border(ob.clip_boxes(t.det), 2.0).select("det_id", "touches_border")


@query("""SELECT image_id, camera_id, width, CASE WHEN width <> 1920 OR height <> 1080 THEN 'image_size' ELSE '' END AS reasons, width = 1920 AND height = 1080 AS ok
    FROM images_dirty""")
def check_camera_policy(t: Inputs):
    out = checks.check_camera_policy(t.images_dirty, readers.cameras(t.spark))
    return out.select("image_id", "camera_id", "width", F.array_join("reasons", ",").alias("reasons"), "ok")


@query("""SELECT det_id, det_id % 31 <> 0 AND det_id % 37 <> 0 AS ok,
    concat_ws(',', CASE WHEN det_id % 31 = 0 THEN 'source' END, CASE WHEN det_id % 37 = 0 THEN 'review_status' END) AS reasons FROM det""")
def check_enums(t: Inputs):
    rows = t.det.select(
        "det_id", F.when(F.col("det_id") % 31 == 0, "robot").otherwise("detector").alias("source"),
        F.when(F.col("det_id") % 37 == 0, "skipped").otherwise("unreviewed_prediction").alias("review_status"),
    )
    return checks.check_enums(rows).select("det_id", "ok", F.array_join("reasons", ",").alias("reasons"))


@query("SELECT det_id, CASE class_id WHEN 5 THEN 10 ELSE class_id END AS class_id FROM det")
def migrate_taxonomy(t: Inputs):
    mapping = literal(t.spark, [(i, 10 if i == 5 else i) for i in range(6)], "class_id int, new_class_id int")
    return ob.migrate_taxonomy(t.det, mapping).select("det_id", "class_id")


# --- scalar expressions ---------------------------------------------------------------

@query("SELECT image_id, capture_us AS parsed_us FROM images")
def stem_timestamp(t: Inputs):
    stem = F.date_format(F.timestamp_micros("capture_us"), "yyyyMMdd_HHmmss_SSSSSS")
    return t.images.select("image_id", F.unix_micros(s.stem_timestamp(stem)).alias("parsed_us"))


@query("SELECT image_id, camera_id, strftime(make_timestamp(capture_us), '%Y%m%d_%H%M%S_%f') AS stem FROM images")
def path_parts(t: Inputs):
    stem = F.date_format(F.timestamp_micros("capture_us"), "yyyyMMdd_HHmmss_SSSSSS")
    path = F.concat(F.lit("/data/run.1/"), F.col("camera_id"), F.lit("/"), stem, F.lit(".jpg"))
    return t.images.select("image_id", s.path_camera(path).alias("camera_id"), s.path_stem(path).alias("stem"))


@query("SELECT image_id, sha256(concat_ws('|', dataset_id, CAST(capture_us AS VARCHAR), camera_id)) AS stable_id FROM images")
def image_identity(t: Inputs):
    return t.images.select("image_id", s.image_identity("dataset_id", "capture_us", "camera_id").alias("stable_id"))


@query(f"""SELECT det_id, {AREA.format(p='')} AS area, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, round((x2 - x1) / (y2 - y1), 6) AS aspect FROM o_det""")
def box_measures(t: Inputs):
    box = g.corners()
    cx, cy = g.centre(box)
    return ob.clip_boxes(t.det).select("det_id", g.area(box).alias("area"), cx.alias("cx"), cy.alias("cy"), F.round(g.aspect(box), 6).alias("aspect"))


@query("""SELECT det_id, round(1/(1 + exp(-ln(p/(1 - p))/1.7)), 6) AS scaled, round(1 - score, 6) AS least_confidence,
    round(-(p*log2(p) + (1 - p)*log2(1 - p)), 6) AS entropy FROM (SELECT det_id, score, least(greatest(score, 0.000001), 0.999999) AS p FROM det) z""")
def score_expressions(t: Inputs):
    return t.det.select(
        "det_id", F.round(s.temperature_scaled("score", F.lit(1.7)), 6).alias("scaled"),
        F.round(s.least_confidence("score"), 6).alias("least_confidence"), F.round(s.binary_entropy("score"), 6).alias("entropy"),
    )


WILSON = "round((k/n + {z2}/(2*n) - {z}*sqrt((k/n)*(1 - k/n)/n + {z2}/(4*n*n)))/(1 + {z2}/n), 6)".format(z=1.959963984540054, z2=1.959963984540054**2)


@query(f"SELECT image_id, CASE WHEN n > 0 THEN {WILSON} END AS bound FROM (SELECT image_id, CAST(count(*) FILTER (WHERE score >= 0.5) AS DOUBLE) AS k, CAST(count(*) AS DOUBLE) AS n FROM det GROUP BY image_id) z")
def wilson_lower(t: Inputs):
    rows = t.det.groupBy("image_id").agg(F.count_if(F.col("score") >= 0.5).alias("k"), F.count(F.lit(1)).alias("n"))
    return rows.select("image_id", F.round(s.wilson_lower("k", "n"), 6).alias("bound"))


@query("""SELECT z.vec_id, CAST(bit_count(xor(p.h, q.h)) AS INTEGER) AS hamming, cosine FROM (
    SELECT a.vec_id, round(sum(a.v*b.v)/(sqrt(sum(a.v*a.v))*sqrt(sum(b.v*b.v))), 5) AS cosine
    FROM (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM vectors) a
    JOIN (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM vectors) b ON b.vec_id = a.vec_id + 1 AND a.i = b.i
    GROUP BY a.vec_id) z JOIN o_signs p ON p.vec_id = z.vec_id JOIN o_signs q ON q.vec_id = z.vec_id + 1""")
def vector_distances(t: Inputs):
    v = t.vectors.withColumn("hash", s.sign_hash("embedding"))
    b = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"), F.col("hash").alias("other_hash"))
    return v.join(b, "vec_id").select("vec_id", s.hamming("hash", "other_hash").alias("hamming"), F.round(s.cosine("embedding", "other"), 5).alias("cosine"))


@query("""SELECT det_id, CASE class_id WHEN 0 THEN 'Car' WHEN 1 THEN 'Truck' WHEN 2 THEN 'Bulldozer' WHEN 3 THEN 'Excavator' WHEN 4 THEN 'WaterTruck' ELSE 'Sign' END AS class,
    class_id AS class_back FROM det""")
def class_names(t: Inputs):
    name = s.class_name("class_id")
    return t.det.select("det_id", name.alias("class"), s.class_number(name).alias("class_back"))


@query("""SELECT image_id, sha256('{"dataset_id":"d0","image_id":' || image_id || ',"camera_order":' || camera_order || ',"note":null}') AS config_hash FROM images""")
def canonical_json_hash(t: Inputs):
    return t.images.select("image_id", s.config_hash("dataset_id", "image_id", "camera_order", F.lit(None).cast("string").alias("note")).alias("config_hash"))


@query("SELECT det_id, class_id, score FROM det")
def result_json_round_trip(t: Inputs):
    """Result objects to canonical JSON text and back through the given schema."""
    from boxloom.schemas import RESULT

    flat = label_of(t.det).withColumn("label", s.class_name("class_id"))
    box = F.struct("x1", "y1", "x2", "y2", "label", "score")
    text = F.to_json(ob.result_struct(box, F.col("width"), F.col("height"), F.col("det_id")), {"ignoreNullFields": "false"})
    back = flat.select(F.from_json(text, RESULT).alias("r"))
    return back.select(
        F.col("r.id").cast("bigint").alias("det_id"), s.class_number(F.col("r.value.rectanglelabels")[0]).alias("class_id"), F.col("r.score").alias("score"),
    )


@query("SELECT image_id, CAST(frame_id * 100 + CAST((frame_id - frame_id % 50)/50 AS BIGINT) * 9900 AS DOUBLE) AS ms FROM images")
def time_delta_ms(t: Inputs):
    return t.images.select("image_id", s.delta_ms("capture_us", F.lit(1781196690000000)).alias("ms"))


@query("SELECT det_id, round(share, 6) AS share FROM (SELECT det_id, ({0}) / {1} AS share FROM (SELECT d.*, 0.0 AS qx1, 0.0 AS qy1, 960.0 AS qx2, 540.0 AS qy2 FROM o_det d) z) y".format(
    INTER.format(a="", b="q"), AREA.format(p="")))
def overlap_ratio(t: Inputs):
    window = [F.lit(0.0), F.lit(0.0), F.lit(960.0), F.lit(540.0)]
    return ob.clip_boxes(t.det).select("det_id", F.round(g.overlap_ratio(g.corners(), window), 6).alias("share"))
