"""Queries over readers and writers: derived tables are written to the shared folder, read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from boxloom.functions import geometry as g
from boxloom.operators import boxes as ob, release, review as rv, sketches as sk
from boxloom.plans.oracle_parts import ORACLE_VIEWS
from boxloom.plans.q_boxes import rounded
from boxloom.plans.q_manifest import _tree_sql, sequenced
from boxloom.plans.q_review import GOLD_SAMPLE, gold_rows
from boxloom.plans.registry import Inputs, query
from boxloom.session import ensure_checkpoint_dir, freeing, stored
from boxloom.sources import readers, results, writers

LABELS = "CASE class_id WHEN 0 THEN 'Car' WHEN 1 THEN 'Truck' WHEN 2 THEN 'Bulldozer' WHEN 3 THEN 'Excavator' WHEN 4 THEN 'WaterTruck' ELSE 'Sign' END"


def folder(t: Inputs) -> str:
    ensure_checkpoint_dir(t.spark)
    return f"{t.spark.sparkContext.getCheckpointDir()}/source-{uuid.uuid4().hex}"


def flat_predictions(t: Inputs):
    boxes = ob.clip_boxes(t.det).withColumn("label", F.expr(LABELS))
    return boxes.select(F.col("image_id").cast("string").alias("image_id"), "width", "height", F.lit("m1").alias("model_version"),
                        F.col("det_id").alias("box_no"), *g.CORNERS, "label", "score", F.lit(None).cast("string").alias("track_id"))


@query(f"SELECT CAST(image_id AS VARCHAR) AS image_id, row_number() OVER (PARTITION BY image_id ORDER BY det_id) - 1 AS box_no, x1, y1, x2, y2, {LABELS} AS label, score FROM o_det")
def predictions_read_back(t: Inputs):
    """S5: nested predictions as JSON Lines, read with the given schema and flattened."""
    path = folder(t)
    readers.nest_predictions(flat_predictions(t)).write.json(path)
    return readers.flatten_predictions(readers.read_predictions(t.spark, path)).select("image_id", "box_no", *g.CORNERS, "label", "score")


ORACLE_VIEWS["o_exported"] = f"""SELECT CAST(image_id AS VARCHAR) AS image_id, 'p' || det_id AS result_id, {LABELS} AS label, x1, y1, x2, y2 FROM o_det"""


@query("""SELECT image_id, result_id, label, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2, false AS was_cancelled FROM o_exported
    UNION ALL SELECT CAST(image_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, false FROM images WHERE image_id NOT IN (SELECT image_id FROM o_det)""")
def review_export_read_back(t: Inputs):
    """S4: an export with percent rectangles, tasks without boxes included."""
    path = folder(t)
    boxes = stored(ob.clip_boxes(t.det).withColumn("label", F.expr(LABELS)))
    box = F.struct(*g.CORNERS, "label", "score")
    results = boxes.groupBy("image_id").agg(F.collect_list(ob.result_struct(box, F.col("width"), F.col("height"), F.concat(F.lit("p"), F.col("det_id").cast("string")))).alias("result"))
    rows = t.images.select("image_id").join(results, "image_id", "left")
    none = F.array().cast(results.schema["result"].dataType)
    tasks = rows.select(
        F.col("image_id").cast("long").alias("id"), F.struct(F.col("image_id").cast("string").alias("image_id")).alias("data"),
        F.array(F.struct(F.lit(1).cast("long").alias("id"), F.lit(False).alias("was_cancelled"), F.lit("a1").alias("completed_by"), F.lit(1.5).alias("lead_time"), F.coalesce("result", none).alias("result"))).alias("annotations"),
    )
    with freeing(t.spark):
        tasks.select("*").write.option("compression", "gzip").json(path)
    back = readers.read_review_export(t.spark, path).filter("_corrupt_record IS NULL")
    return rounded(back, *g.CORNERS).select("image_id", "result_id", "label", *g.CORNERS, "was_cancelled")


@query("SELECT CAST(annotation_id AS VARCHAR) AS annotation_id, CAST(image_id AS VARCHAR) AS image_id, class_id, x1, y1, x2, y2 FROM truth")
def coco_read_back(t: Inputs):
    """S6, S11: COCO documents of small shards, written one per line and read as such."""
    from boxloom.schemas import COCO

    path = folder(t)
    images = sequenced(t).withColumn("relative_path", F.concat_ws("/", "camera_id", F.col("image_id").cast("string")))
    truth = stored(t.truth.select("annotation_id", "image_id", "class_id", *g.CORNERS))  # documents read it twice
    writers.write_coco(images, truth, path, compression="gzip", frames_per_shard=40, boxes_per_shard=200)
    docs = t.spark.read.text(path).select(F.from_json("value", COCO).alias("d")).select(F.explode("d.annotations").alias("a"))
    flat = docs.select(F.col("a.id").alias("annotation_id"), F.col("a.image_id").alias("image_id"), F.col("a.category_id").alias("class_id"),
                       *[F.get("a.bbox", F.lit(i)).alias(n) for i, n in enumerate("xywh")])
    return ob.from_xywh(flat).select("annotation_id", "image_id", "class_id", *g.CORNERS)


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(image_id AS VARCHAR) AS image_id, CAST(annotator_id AS VARCHAR) AS annotator_id, assisted, round(seconds, 6) AS seconds, event FROM review")
def review_log_read_back(t: Inputs):
    """S8: the review log as JSON Lines."""
    path = folder(t)
    ids = {c: F.col(c).cast("string") for c in ("event_id", "image_id", "annotator_id")}
    t.review.withColumns(ids).withColumn("ts", F.col("ts").cast("timestamp")).write.json(path)
    return rounded(readers.read_review_log(t.spark, path), "seconds").select("event_id", "image_id", "annotator_id", "assisted", "seconds", "event")


@query("SELECT CAST(image_id AS VARCHAR) AS image_id, count(*) AS boxes, 'm1' AS model_version FROM o_det GROUP BY image_id")
def review_tasks_read_back(t: Inputs):
    """S10: import tasks."""
    path = folder(t)
    writers.write_review_tasks(readers.nest_predictions(stored(flat_predictions(t))), path, compression="gzip")
    back = t.spark.read.json(path)
    first = F.col("predictions")[0]
    return back.select(F.col("data.image_id").alias("image_id"), F.size(first["result"]).cast("long").alias("boxes"), first["model_version"].alias("model_version"))


MANIFEST_ROW = """sha256('{"camera_id":"' || camera_id || '","frame_id":' || frame_id || ',"image_id":' || image_id || '}')"""
TRUTH_ROW = """sha256('{"annotation_id":' || annotation_id || ',"class_id":' || class_id || ',"image_id":' || image_id || '}')"""


@query(f"""SELECT left(a.content_hash, 16) AS manifest_id, a.content_hash AS manifest_sha256, b.content_hash AS annotation_sha256, 'v1' AS taxonomy_version, '{{"boxes": 1}}' AS report
    FROM ({_tree_sql(f"SELECT {MANIFEST_ROW} AS h FROM images")}) a CROSS JOIN ({_tree_sql(f"SELECT {TRUTH_ROW} AS h FROM truth")}) b""")
def release_record_read_back(t: Inputs):
    """S14: the record of a release."""
    path = folder(t)
    record = release.release_record(
        t.spark, t.images.select("image_id", "frame_id", "camera_id"), t.truth.select("annotation_id", "image_id", "class_id"),
        taxonomy_version="v1", camera_policy_version="c1", split_version="s1", command="build", git_commit="0", report={"boxes": 1},
    )
    writers.write_record(record, path)
    return t.spark.read.schema(record.schema).json(path).select("manifest_id", "manifest_sha256", "annotation_sha256", "taxonomy_version", "report")


@query(f"""SELECT s.image_id, sha256(CAST(s.image_id AS VARCHAR)) AS sha256, s.sampling_reason,
    CASE WHEN t.outcome <> 'submitted' THEN 'unreviewed' WHEN s.image_id IN (SELECT image_id FROM submitted) THEN 'reviewed' ELSE 'verified_empty' END AS review_state, 'r1' AS dataset_release_id
    FROM ({GOLD_SAMPLE}) s JOIN tasks t ON t.image_id = s.image_id""")
def gold_manifest(t: Inputs):
    """S15: the gold sample's rows carry checksums, reasons and states, no image content."""
    states = rv.image_status(t.tasks, t.submitted).select("image_id", "annotation_status")
    images = t.images.join(states, "image_id").withColumn("sha256", F.sha2(F.col("image_id").cast("string"), 256))
    return release.gold_manifest(gold_rows(t), images, "r1")


#: One result of each known kind, one that no schema here knows, and one that is no object, in spaced and unsorted text.
_RESULTS = """'{{"id":"r' || {i} || '", "type":"rectanglelabels", "original_width":1920,"original_height":1080,"value":{{"y":' || ({i} % 50) || '.5,"x":10.0,"width":20,"height":25.00,"rotation":0,"rectanglelabels":["Car"]}}}}'
    || ',{{"type":"polygonlabels","original_width":1920,"original_height":1080,"id":"p","value":{{"points":[[10,10],[' || ({i} % 90) || ',50.50],[10,5e1]],"polygonlabels":["Road"]}}}}'
    || ',{{"value":{{"keypointlabels":["Head"],"x":50,"y":' || ({i} % 100) || ',"width":1}},"type":"keypointlabels","id":"k","original_width":1920,"original_height":1080}}'
    || ',{{"id":"c","from_name":"quality","type":"choices","value":{{"choices":["Good","' || CASE WHEN {i} % 2 = 0 THEN 'Bright' ELSE 'Dark' END || '"]}}}}'
    || ',{{"z":[1,{{"b":null,"a":"\\u00e9 \\"q\\""}}], "type" : "wavelet' || ({i} % 3) || '","level":1.50,"a":{{}} }}' || CASE WHEN {i} % 5 = 0 THEN ',"only text"' ELSE '' END"""
ORACLE_VIEWS["o_lines"] = f"""SELECT image_id, CASE WHEN image_id % 11 = 0 THEN '{{"id":' || image_id || ', broken' ELSE
    '{{"id":' || image_id || ',"data":{{"image_id":"' || image_id || '", "extra":[1, 2.0]}},"annotations":[' || CASE WHEN image_id % 7 = 0 THEN '' ELSE
    '{{"id":1,"was_cancelled":false,"completed_by":"a1","lead_time":1.50,"result":[' || CASE WHEN image_id % 6 = 0 THEN '' ELSE {_RESULTS.format(i="image_id")} END || ']}}' END || ']}}' END AS line FROM images"""
_WHOLE = "image_id % 11 <> 0 AND image_id % 7 <> 0 AND image_id % 6 <> 0"


def exported(t: Inputs):
    """The lines of an export with results of every kind, written and read as such."""
    path = folder(t)
    view = f"exported_{uuid.uuid4().hex}"
    t.images.select("image_id").createOrReplaceTempView(view)
    t.spark.sql(ORACLE_VIEWS["o_lines"].replace("FROM images", f"FROM {view}").replace("\\", "\\\\")).select("line").write.text(path)
    t.spark.catalog.dropTempView(view)
    return results.read_results(t.spark, path)


@query(f"""SELECT type, known, sum(n) AS results, sum(images) AS images, CASE WHEN type IS NULL THEN sum(n) ELSE 0 END AS unreadable FROM (
    SELECT unnest(['rectanglelabels', 'polygonlabels', 'keypointlabels', 'choices', 'wavelet0', 'wavelet1', 'wavelet2', NULL]) AS type,
           unnest([true, true, true, true, false, false, false, false]) AS known,
           unnest([count(*), count(*), count(*), count(*), count(*) FILTER (image_id % 3 = 0), count(*) FILTER (image_id % 3 = 1), count(*) FILTER (image_id % 3 = 2), count(*) FILTER (image_id % 5 = 0)]) AS n,
           unnest([count(*), count(*), count(*), count(*), count(*) FILTER (image_id % 3 = 0), count(*) FILTER (image_id % 3 = 1), count(*) FILTER (image_id % 3 = 2), count(*) FILTER (image_id % 5 = 0)]) AS images
    FROM images WHERE {_WHOLE}) z WHERE n > 0 GROUP BY type, known""")
def result_types(t: Inputs):
    """E15: kinds of results, unknown ones among them, counted."""
    return results.result_types(exported(t)).drop("schema")


@query("SELECT line FROM o_lines")
def results_rewritten(t: Inputs):
    """E15: results of every kind survive reading and writing byte for byte."""
    path = folder(t)
    results.write_results(exported(t), path)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


@query(f"""SELECT image_id, kind, detail FROM (
    SELECT CAST(image_id AS VARCHAR) AS image_id, unnest(['box', 'polygon', 'keypoint', 'choice', 'choice']) AS kind, unnest([
        'Car ' || CAST(round(0.1 * 1920) AS BIGINT) || ' ' || CAST(round((image_id % 50 + 0.5) * 10.8 * 10) AS BIGINT) || ' ' || CAST(round(0.3 * 1920) AS BIGINT) || ' ' || CAST(round((image_id % 50 + 25.5) * 10.8 * 10) AS BIGINT),
        'Road 3 ' || CAST(round((image_id % 90) * 19.2) AS BIGINT), 'Head 960 ' || CAST(round((image_id % 100) * 10.8) AS BIGINT), 'Good', CASE WHEN image_id % 2 = 0 THEN 'Bright' ELSE 'Dark' END]) AS detail
    FROM images WHERE {_WHOLE}) z""")
def result_values(t: Inputs):
    """E15: what the known kinds of results say, read from their variants."""
    from boxloom.session import checkpointed

    rows = checkpointed(exported(t).select("image_id", "result_id", "type", "raw", "known")).withColumn("result", F.try_parse_json("raw"))
    whole = lambda x: F.round(x).cast("long").cast("string")
    box = results.result_boxes(rows).select("image_id", F.lit("box").alias("kind"), F.concat_ws(" ", "label", whole(F.col("x1")), whole(F.col("y1") * 10), whole(F.col("x2")), whole(F.col("y2") * 10)).alias("detail"))
    polygon = results.result_polygons(rows).select("image_id", F.lit("polygon").alias("kind"), F.concat_ws(" ", "label", F.size("points").cast("string"), whole(F.col("points")[1]["x"])).alias("detail"))
    point = results.result_keypoints(rows).select("image_id", F.lit("keypoint").alias("kind"), F.concat_ws(" ", "label", whole(F.col("x")), whole(F.col("y"))).alias("detail"))
    choice = results.result_choices(rows).select("image_id", F.lit("choice").alias("kind"), F.col("choice").alias("detail"))
    return box.unionByName(polygon).unionByName(point).unionByName(choice)


@query("""SELECT image_id, row_number() OVER (ORDER BY CAST(substr(s.sequence_id, 2) AS BIGINT), frame_id, camera_order, image_id) - 1 AS place FROM images JOIN o_seq s USING (image_id)""")
def manifest_read_back(t: Inputs):
    """S9: the written manifest keeps canonical order over its parts."""
    path = folder(t)
    columns = ["dataset_id", "image_id", "sequence_id", "frame_id", "camera_order"]
    writers.write_lines(sequenced(t), path, columns)
    lines = t.spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("n"))
    back = lines.select("file", "n", F.from_json("value", "image_id bigint").alias("v")).select("file", "n", "v.image_id")
    from boxloom.operators.scale import part_running_sum, range_parts

    order = [F.col("file").asc(), F.col("n").asc()]
    ranked = part_running_sum(range_parts(back, [], order), [], order, {"place": F.lit(1).cast("bigint")})
    return ranked.select("image_id", (F.col("place") - 1).alias("place"))


# --- sketches kept per release --------------------------------------------------------

#: Five releases that overlap: each holds two of five frames, so that every image is in two of them.
LISTED = """SELECT i.image_id, i.frame_id, i.camera_id, r.n AS release FROM images i JOIN (SELECT 0 AS n UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) r
    ON i.frame_id % 5 = r.n OR (i.frame_id + 1) % 5 = r.n"""


def listed(t: Inputs):
    frame = F.col("frame_id") % 5
    number = F.explode(F.array(frame, (frame + 1) % 5))
    rows = t.images.withColumn("_r", number)
    return rows.withColumn("dataset_id", F.concat(F.lit("r"), F.col("_r").cast("string"))).drop("_r")


def kept_sketches(t: Inputs):
    path = folder(t)
    sk.store_sketches(sk.audit_sketches(listed(t), t.review), path)
    return sk.stored_sketches(t.spark, path)


@query(f"""SELECT camera_id, count(*) AS rows, count(DISTINCT image_id) AS images, count(DISTINCT (release, frame_id)) AS frames,
    true AS images_close, true AS frames_close, true AS median_close FROM ({LISTED}) z GROUP BY camera_id""")
def release_sketches(t: Inputs):
    """A34 over releases: stored sketches merged per camera, beside the exact values (counts within 4 %, the median's rank within 2 %)."""
    guess = sk.sketch_audit(sk.merge_sketches(kept_sketches(t), ("camera_id",)), (0.5,)).withColumnsRenamed({"images": "near_images", "frames": "near_frames"})
    images = listed(t)
    exact = images.groupBy("camera_id").agg(F.count_distinct("image_id").alias("images"), F.count_distinct("dataset_id", "frame_id").alias("frames"))
    cameras = guess.select("camera_id", F.col("seconds_50").alias("m"))
    timed = t.review.join(t.images.select("image_id", "camera_id"), "image_id").join(cameras, "camera_id")
    ranks = timed.groupBy("camera_id").agg((F.count_if(F.col("seconds") <= F.col("m")) / F.count("seconds")).alias("upto"), (F.count_if(F.col("seconds") < F.col("m")) / F.count("seconds")).alias("under"))
    rows = exact.join(guess, "camera_id").join(ranks, "camera_id", "left")

    def close(a: str, b: str):
        return F.abs(F.col(a) - F.col(b)) <= 0.04 * F.col(b)

    median = F.coalesce((F.col("upto") >= 0.48) & (F.col("under") <= 0.52), F.lit(True))
    return rows.select("camera_id", "rows", "images", "frames", close("near_images", "images").alias("images_close"), close("near_frames", "frames").alias("frames_close"), median.alias("median_close"))


@query(f"""SELECT camera_id, count(*) FILTER (WHERE a AND b) AS shared, count(*) FILTER (WHERE b AND NOT a) AS added, count(*) FILTER (WHERE a AND NOT b) AS dropped
    FROM (SELECT camera_id, image_id, bool_or(release = 0) AS a, bool_or(release = 1) AS b FROM ({LISTED}) z GROUP BY ALL) y GROUP BY camera_id""")
def release_overlap(t: Inputs):
    """What two releases share, from their stored sketches alone, cut into shares that hold every image."""
    path = folder(t)
    sk.store_sketches(sk.overlap_sketches(listed(t)), path)
    return sk.release_overlap(sk.stored_sketches(t.spark, path), "r0", "r1")
