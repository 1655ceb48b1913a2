"""Box tables derived from the order, line and event tables.

One SQL text serves Spark and the checking engine: `with_views` puts the views a statement names
in front of it, each after the views it reads.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ["orders", "lineitem", "events", "embeddings"]

CAMERA_CASE = (
    "CASE camera_order WHEN 0 THEN 'front' WHEN 1 THEN 'front_left' WHEN 2 THEN 'front_right' "
    "WHEN 3 THEN 'back' WHEN 4 THEN 'back_left' ELSE 'back_right' END"
)

VIEWS: dict[str, str] = {
    "fx_images": """
        SELECT image_key, frame, camera_order, seq_truth, 1781196690000000 + frame*100000 + seq_truth*9900000 AS capture_us,
               frame % 5 = 0 AS is_keyframe, 1920 AS width, 1080 AS height
        FROM (SELECT image_key, frame, camera_order, CAST((frame - frame % 50)/50 AS BIGINT) AS seq_truth
              FROM (SELECT o_orderkey AS image_key, CAST((o_orderkey - o_orderkey % 6)/6 AS BIGINT) AS frame,
                           CAST(o_orderkey % 6 AS INT) AS camera_order FROM orders) a) b""",
    "fx_images_dirty": """
        SELECT image_key, frame, camera_order, capture_us, is_keyframe,
               CASE WHEN image_key % 983 = 3 THEN 1280 ELSE width END AS width, height
        FROM fx_images WHERE image_key % 997 <> 5
        UNION ALL
        SELECT image_key, frame, camera_order, capture_us, is_keyframe, width, height
        FROM fx_images WHERE image_key % 991 = 7""",
    "fx_gt": """
        SELECT l_orderkey*100 + box_no AS annotation_id, l_orderkey AS image_key,
               CASE WHEN l_partkey % 100 < 1 THEN 0 WHEN l_partkey % 100 < 75 THEN 1 WHEN l_partkey % 100 < 76 THEN 2
                    WHEN l_partkey % 100 < 96 THEN 3 WHEN l_partkey % 100 < 98 THEN 4 ELSE 5 END AS class_id,
               x1, y1, x1 + w AS x2, y1 + h AS y2, l_returnflag = 'A' AS occluded, l_linestatus = 'F' AS truncated,
               l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln, CAST(l_quantity AS BIGINT) AS q
        FROM (SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                       l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS box_no,
                     (l_partkey*37 + l_suppkey*101) % 1500 AS x1, (l_partkey*7 + l_suppkey*13) % 800 AS y1,
                     20 + (l_suppkey*31 + l_partkey) % 380 AS w, 20 + (CAST(l_quantity AS BIGINT)*5) % 260 AS h
              FROM lineitem l) t""",
    "fx_det_raw": """
        SELECT annotation_id*10 AS det_id, image_key,
               CASE WHEN (pk*3 + sk) % 23 = 0 THEN (class_id + 1) % 6 ELSE class_id END AS class_id,
               x1 + pk % 13 - 6 AS x1, y1 + sk % 9 - 4 AS y1, x2 + pk % 11 - 5 AS x2, y2 + sk % 7 - 3 AS y2,
               CAST(2*q - 1 AS DOUBLE)/CAST(100 AS DOUBLE) AS score
        FROM fx_gt WHERE (pk + ln) % 10 <> 0
        UNION ALL
        SELECT annotation_id*10 + 1, image_key, class_id, x1 + 3, y1 + 2, x2 + 3, y2 + 2, CAST(2*q AS DOUBLE)/CAST(200 AS DOUBLE)
        FROM fx_gt WHERE (pk + sk) % 12 = 0
        UNION ALL
        SELECT annotation_id*10 + 2, image_key, class_id, (x1 + 700) % 1500, y1, (x1 + 700) % 1500 + (x2 - x1), y2, CAST(q AS DOUBLE)/CAST(100 AS DOUBLE)
        FROM fx_gt WHERE (pk*5 + ln) % 14 = 0""",
    "fx_track_det": """
        SELECT (image_key*10 + obj) AS det_id, image_key, frame, camera_order, seq_truth, obj AS obj_truth,
               50 + 550*obj + 8*(frame % 50) AS x1, 300 + 20*camera_order AS y1,
               170 + 550*obj + 8*(frame % 50) AS x2, 390 + 20*camera_order AS y2,
               CASE WHEN (frame + obj) % 4 = 0 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.8 AS DOUBLE) END AS score
        FROM fx_images CROSS JOIN (SELECT 0 AS obj UNION ALL SELECT 1 UNION ALL SELECT 2) o
        WHERE (frame*7 + obj*3 + camera_order) % 11 <> 0""",
    "fx_review": """
        SELECT event_id, ts, event_id % (SELECT count(*) FROM orders) AS image_key, user_id AS annotator_id,
               user_id % 2 = 0 AS assisted, value AS seconds,
               CASE event_type WHEN 'view' THEN 'displayed' WHEN 'click' THEN 'submit_unchanged' WHEN 'signup' THEN 'submit_modified'
                    WHEN 'purchase' THEN 'submit_created' ELSE 'skipped' END AS event
        FROM events""",
    # the same tables under the package's column names
    "images": f"""
        SELECT 'd0' AS dataset_id, image_key AS image_id, frame AS frame_id, camera_order, {CAMERA_CASE} AS camera_id,
               capture_us, is_keyframe, width, height FROM fx_images""",
    "images_dirty": f"""
        SELECT 'd0' AS dataset_id, image_key AS image_id, frame AS frame_id, camera_order, {CAMERA_CASE} AS camera_id,
               capture_us, is_keyframe, width, height FROM fx_images_dirty""",
    "truth": """
        SELECT annotation_id, image_key AS image_id, class_id, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
               CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2, occluded, truncated, 1920 AS width, 1080 AS height FROM fx_gt""",
    "truth_seen": f"""
        SELECT *, {CAMERA_CASE} AS camera_id FROM (SELECT *, CAST(image_id % 6 AS INT) AS camera_order FROM truth) c""",
    "det": f"""
        SELECT det_id, image_key AS image_id, class_id, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
               CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2, score, 1920 AS width, 1080 AS height,
               {CAMERA_CASE} AS camera_id
        FROM (SELECT *, CAST(image_key % 6 AS INT) AS camera_order FROM fx_det_raw) d""",
    # a second model: every second prediction moved, one in seven of another class
    "det_b": """
        SELECT det_id + 5 AS det_id, image_id, CASE WHEN det_id % 7 = 0 THEN (class_id + 2) % 6 ELSE class_id END AS class_id,
               x1 + det_id % 40 AS x1, y1, x2 + det_id % 40 AS x2, y2, score, width, height
        FROM det WHERE image_id % 2 = 0 OR det_id % 3 = 0""",
    # boxes a reviewer sent back: some deleted, moved, relabelled, a few new
    "submitted": """
        SELECT image_id, concat('p', CAST(det_id AS VARCHAR(20))) AS result_id,
               CASE WHEN det_id % 7 = 2 THEN (class_id + 1) % 6 ELSE class_id END AS class_id,
               x1 + CASE WHEN det_id % 7 = 1 THEN 5 WHEN det_id % 7 = 3 THEN CAST(0.5 AS DOUBLE) ELSE 0 END AS x1, y1, x2, y2
        FROM det WHERE det_id % 7 <> 4
        UNION ALL
        SELECT image_id, CAST(NULL AS VARCHAR(20)) AS result_id, class_id, x1, y1, x2, y2 FROM truth WHERE annotation_id % 9 = 0""",
    "predicted": """
        SELECT image_id, concat('p', CAST(det_id AS VARCHAR(20))) AS result_id, class_id, x1, y1, x2, y2 FROM det""",
    # outcome of every image's task
    "tasks": """
        SELECT image_id, CASE WHEN image_id % 11 = 0 THEN 'skipped' WHEN image_id % 11 = 1 THEN 'displayed' ELSE 'submitted' END AS outcome
        FROM images""",
    # boxes over frames with given tracks; the track id comes from the box id and the 50-frame block
    "track_boxes": f"""
        SELECT det_id, image_key AS image_id, frame AS frame_id, {CAMERA_CASE} AS camera_id, 1 AS class_id,
               CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2, score,
               1781196690000000 + frame*100000 + CAST((frame - frame % 50)/50 AS BIGINT)*9900000 AS capture_us
        FROM fx_track_det""",
    "tracks": """
        SELECT det_id, image_id, frame_id, camera_id, class_id, x1, y1, x2, y2, score,
               concat(camera_id, '-', CAST(CAST((frame_id - frame_id % 50)/50 AS BIGINT) AS VARCHAR(20)), '-', CAST(det_id % 10 AS VARCHAR(20))) AS track_id
        FROM track_boxes""",
    "review": """
        SELECT event_id, ts, image_key AS image_id, annotator_id, assisted, seconds, event FROM fx_review""",
    "vectors": "SELECT vec_id, embedding, label FROM embeddings",
}


def closure(text: str, views: dict[str, str]) -> list[str]:
    """Views a text names, directly or through others, in order of definition."""
    names: set[str] = set()
    queue = [text]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in views:
            if name in words and name not in names:
                names.add(name)
                queue.append(views[name])
    return [n for n in views if n in names]


def with_views(sql: str, views: dict[str, str] = VIEWS, once: str | None = None) -> str:
    """`once`: prefix of the views that the checking engine should compute a single time."""
    names = closure(sql, views)
    if not names:
        return sql
    kept = {n: " MATERIALIZED" if once and n.startswith(once) else "" for n in names}
    head = ",\n".join(f"{n} AS{kept[n]} ({views[n]})" for n in names)
    return f"WITH {head}\n{sql}"


def register(spark: SparkSession, sf_dir: str) -> None:
    for name in BASE:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def table(spark: SparkSession, sf_dir: str, name: str, columns: str = "*") -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(with_views(f"SELECT {columns} FROM {name}"))
