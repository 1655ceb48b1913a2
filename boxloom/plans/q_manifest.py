"""Queries over manifests: matching, sequences, folds, audits, ordering, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.constants import CAMERAS
from boxloom.operators import manifest as m, release
from boxloom.plans.registry import Inputs, query
from boxloom.sources import readers, writers

CAMERA_IDS = [name for _, name, *_ in CAMERAS]
STEM = "strftime(make_timestamp(capture_us), '%Y%m%d_%H%M%S_%f')"


def stems(df):
    return df.withColumn("stem", F.date_format(F.timestamp_micros("capture_us"), "yyyyMMdd_HHmmss_SSSSSS"))


def label_stems(t: Inputs):
    return stems(t.images.filter("is_keyframe")).select("stem").distinct()


def sequenced(t: Inputs):
    return m.assign_sequences(t.images)


def folded(t: Inputs):
    return m.build_folds(sequenced(t))


@query("SELECT image_id, camera_id FROM images WHERE is_keyframe")
def match_keyframes(t: Inputs):
    return m.match_keyframes(label_stems(t), stems(t.images)).select("image_id", "camera_id")


@query(f"""SELECT {STEM} AS stem, camera_id FROM images i WHERE is_keyframe AND NOT EXISTS (SELECT 1 FROM images_dirty d WHERE d.image_id = i.image_id)""")
def missing_images(t: Inputs):
    return m.missing_images(label_stems(t), readers.cameras(t.spark), stems(t.images_dirty)).select("stem", "camera_id")


@query("SELECT image_id FROM images_dirty WHERE NOT is_keyframe")
def extra_images(t: Inputs):
    return m.extra_images(label_stems(t), stems(t.images_dirty)).select("image_id")


@query("""
    SELECT image_id, CASE WHEN past IS NOT NULL AND (nxt IS NULL OR capture_us - past <= nxt - capture_us) THEN past_id ELSE nxt_id END AS keyframe_image_id,
           CASE WHEN past IS NOT NULL AND (nxt IS NULL OR capture_us - past <= nxt - capture_us) THEN capture_us - past ELSE nxt - capture_us END / 1000.0 AS sync_delta_ms
    FROM (SELECT c.image_id, c.capture_us, p.capture_us AS past, p.image_id AS past_id, n.capture_us AS nxt, n.image_id AS nxt_id
          FROM (SELECT * FROM images WHERE NOT is_keyframe) c
          ASOF LEFT JOIN (SELECT * FROM images WHERE is_keyframe) p ON p.camera_id = c.camera_id AND c.capture_us >= p.capture_us
          ASOF LEFT JOIN (SELECT * FROM images WHERE is_keyframe) n ON n.camera_id = c.camera_id AND c.capture_us <= n.capture_us) z""")
def match_context(t: Inputs):
    return m.match_context(t.images).select("image_id", "keyframe_image_id", "sync_delta_ms")


@query("""
    SELECT image_id, CASE WHEN past IS NOT NULL AND (nxt IS NULL OR capture_us - past <= nxt - capture_us) THEN past_id ELSE nxt_id END AS keyframe_image_id,
           CASE WHEN past IS NOT NULL AND (nxt IS NULL OR capture_us - past <= nxt - capture_us) THEN capture_us - past ELSE nxt - capture_us END / 1000.0 AS sync_delta_ms
    FROM (SELECT c.image_id, c.capture_us, p.capture_us AS past, p.last_id AS past_id, n.capture_us AS nxt, n.first_id AS nxt_id
          FROM (SELECT * FROM images WHERE NOT is_keyframe) c
          ASOF LEFT JOIN (SELECT camera_id, capture_us, max(image_id) + 1000000000 AS last_id FROM images WHERE is_keyframe GROUP BY ALL) p ON p.camera_id = c.camera_id AND c.capture_us >= p.capture_us
          ASOF LEFT JOIN (SELECT camera_id, capture_us, min(image_id) AS first_id FROM images WHERE is_keyframe GROUP BY ALL) n ON n.camera_id = c.camera_id AND c.capture_us <= n.capture_us) z""")
def match_context_ties(t: Inputs):
    """Every keyframe twice at its time, under another id."""
    twins = t.images.filter("is_keyframe").withColumn("image_id", F.col("image_id") + 1000000000)
    return m.match_context(t.images.unionByName(twins)).select("image_id", "keyframe_image_id", "sync_delta_ms")


@query("SELECT image_id, sequence_id FROM o_seq")
def assign_sequences(t: Inputs):
    return sequenced(t).select("image_id", "sequence_id")


@query("SELECT image_id, sequence_id, true AS cut_ok FROM o_seq")
def inherit_sequence(t: Inputs):
    return m.inherit_sequence(t.images, m.keyframe_sequences(t.images)).select("image_id", "sequence_id", "cut_ok")


@query("SELECT image_id, row_number() OVER (PARTITION BY camera_id ORDER BY capture_us, image_id) - 1 AS raw_sequence_index FROM images")
def raw_index(t: Inputs):
    return m.raw_index(t.images).select("image_id", "raw_sequence_index")


@query("""
    SELECT camera_id, count(*) AS keyframes, min(di) AS min_index_delta, max(di) AS max_index_delta, median(dt) AS median_time_delta_us
    FROM (SELECT camera_id, i - lag(i) OVER w AS di, capture_us - lag(capture_us) OVER w AS dt
          FROM (SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY capture_us) AS i FROM images) a WHERE is_keyframe
          WINDOW w AS (PARTITION BY camera_id ORDER BY capture_us)) b GROUP BY camera_id""")
def cadence(t: Inputs):
    return m.cadence(t.images).drop("dataset_id")


SEGMENTS = """
    SELECT *, CAST(sum(CASE WHEN reset_reason IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY camera_id ORDER BY capture_us ROWS UNBOUNDED PRECEDING) AS BIGINT) - 1 AS segment_id
    FROM (SELECT *, CASE WHEN pf IS NULL THEN 'start' WHEN ps <> sequence_id THEN 'sequence' WHEN frame_id - pf > 1 THEN 'missing_context' WHEN image_id % 211 = 3 THEN 'scene_cut' END AS reset_reason
          FROM (SELECT i.image_id, i.camera_id, i.frame_id, i.capture_us, s.sequence_id, lag(s.sequence_id) OVER w AS ps, lag(i.frame_id) OVER w AS pf
                FROM (SELECT DISTINCT * FROM images_dirty) i JOIN o_seq s ON i.image_id = s.image_id WINDOW w AS (PARTITION BY i.camera_id ORDER BY i.capture_us)) a) b"""


def segments(t: Inputs):
    clean = t.images_dirty.distinct().join(sequenced(t).select("image_id", "sequence_id"), "image_id")
    cuts = t.images.filter("image_id % 211 = 3").select("image_id")
    return m.continuity_segments(clean, cuts)


@query(f"SELECT image_id, reset_reason, segment_id FROM ({SEGMENTS}) z")
def continuity_segments(t: Inputs):
    return segments(t).select("image_id", "reset_reason", "segment_id")




@query("""
    SELECT image_id, round(score, 6) AS change_score, coalesce(score > 0.4, false) AS scene_cut FROM (
        SELECT image_id, (abs(a - lag(a) OVER w) + abs(b - lag(b) OVER w) + abs(c - lag(c) OVER w)) / 3 AS score
        FROM (SELECT image_id, camera_id, frame_id, CAST(image_id * 7 % 11 AS DOUBLE)/10 AS a, CAST((frame_id - frame_id % 25)/25 % 4 AS DOUBLE) AS b, CAST(camera_order AS DOUBLE) AS c FROM images) f
        WINDOW w AS (PARTITION BY camera_id ORDER BY frame_id)) z""")
def scene_cuts(t: Inputs):
    d = "double"
    features = F.array((F.col("image_id") * 7 % 11).cast(d) / 10, ((F.col("frame_id") - F.col("frame_id") % 25) / 25 % 4).cast(d), F.col("camera_order").cast(d))
    out = m.scene_cuts(t.images.withColumn("features", features), 0.4)
    return out.select("image_id", F.round("change_score", 6).alias("change_score"), "scene_cut")


# --- roles, folds, sets ---------------------------------------------------------------

@query("""SELECT count(*) FILTER (WHERE is_keyframe) AS keyframes, count(*) FILTER (WHERE NOT is_keyframe) AS context,
    CAST(0 AS BIGINT) AS in_both, count(*) AS images FROM images""")
def partition_roles(t: Inputs):
    return m.partition_roles(t.images)


@query("SELECT image_id, sequence_id, fold_id FROM o_seq")
def build_folds(t: Inputs):
    return folded(t).select("image_id", "sequence_id", "fold_id")


@query("""SELECT g.frame_id, k.fold, CASE WHEN g.fold_id = k.fold THEN 'validation' ELSE 'train' END AS side
    FROM (SELECT DISTINCT i.frame_id, s.fold_id FROM images i JOIN o_seq s ON i.image_id = s.image_id) g CROSS JOIN (SELECT DISTINCT fold_id AS fold FROM o_seq) k""")
def expand_folds(t: Inputs):
    rows = folded(t)
    return m.expand_folds(rows, rows).select("frame_id", "fold", "side")


@query("""SELECT image_id, fold_id + 1 AS fold_id, 'second' AS only_in FROM o_seq WHERE image_id % 499 = 4
    UNION ALL SELECT image_id, fold_id, 'first' FROM o_seq WHERE image_id % 499 = 4""")
def same_folds(t: Inputs):
    a = folded(t).select("image_id", "fold_id")
    b = a.withColumn("fold_id", F.expr("CASE WHEN image_id % 499 = 4 THEN fold_id + 1 ELSE fold_id END"))
    return m.same_folds(a, b, ["image_id", "fold_id"])


@query("""SELECT frame_id, count(DISTINCT fold) AS folds, count(*) AS images FROM (
        SELECT i.frame_id, CASE WHEN i.image_id % 499 = 4 THEN s.fold_id + 1 ELSE s.fold_id END AS fold FROM images i JOIN o_seq s ON i.image_id = s.image_id) z
    GROUP BY frame_id HAVING count(DISTINCT fold) > 1""")
def split_violations(t: Inputs):
    bad = folded(t).withColumn("fold_id", F.expr("CASE WHEN image_id % 499 = 4 THEN fold_id + 1 ELSE fold_id END"))
    return m.split_violations(bad).drop("dataset_id")


@query("""SELECT det_id, 'detector' AS source, score FROM det UNION ALL SELECT det_id, 'foundation_teacher', score FROM det_b
    UNION ALL SELECT annotation_id, 'human', NULL FROM truth""")
def union_proposals(t: Inputs):
    human = t.truth.withColumnRenamed("annotation_id", "det_id")
    return m.union_proposals(detector=t.det, foundation_teacher=t.det_b, human=human).select("det_id", "source", "score")


@query("""SELECT annotation_id, CASE WHEN annotation_id % 5 = 0 THEN 'removed' ELSE 'changed' END AS change FROM truth WHERE annotation_id % 5 = 0 OR annotation_id % 7 = 0
    UNION ALL SELECT annotation_id + 1000000000, 'added' FROM truth WHERE annotation_id % 9 = 0""")
def release_diff(t: Inputs):
    old = t.truth
    new = old.filter("annotation_id % 5 <> 0").withColumn("x2", F.expr("CASE WHEN annotation_id % 7 = 0 THEN x2 + 1 ELSE x2 END"))
    more = old.filter("annotation_id % 9 = 0").withColumn("annotation_id", F.col("annotation_id") + 1000000000)
    return m.release_diff(old, new.unionByName(more), "annotation_id", ["class_id", "x1", "y1", "x2", "y2"])


@query("""SELECT i.image_id, row_number() OVER (ORDER BY CAST(substr(s.sequence_id, 2) AS BIGINT), i.frame_id, i.camera_order, i.image_id) AS place
    FROM images i JOIN o_seq s ON i.image_id = s.image_id""")
def canonical_order(t: Inputs):
    """Places in canonical order, numbered without moving all rows to one task."""
    from boxloom.operators.scale import part_running_sum, range_parts

    order = [m.sequence_number().asc(), *[F.col(c).asc() for c in ("frame_id", "camera_order", "image_id")]]
    rows = range_parts(m.canonical_order(sequenced(t)), [], order)
    return part_running_sum(rows, [], order, {"place": F.lit(1).cast("bigint")}).select("image_id", "place")


# --- reconciliation and audits --------------------------------------------------------

@query("""SELECT image_id, coalesce(a, 0) AS in_manifest, coalesce(b, 0) AS in_export,
    CASE WHEN a IS NULL THEN 'extra' WHEN b IS NULL THEN 'missing' WHEN a > 1 OR b > 1 THEN 'duplicate' ELSE 'ok' END AS status
    FROM (SELECT image_id, count(*) AS a FROM images GROUP BY image_id) m
    FULL JOIN (SELECT CASE WHEN image_id % 900 = 8 THEN image_id + 100000000 ELSE image_id END AS image_id, count(*) AS b FROM images_dirty GROUP BY 1) e USING (image_id)""")
def reconcile(t: Inputs):
    export = t.images_dirty.withColumn("image_id", F.expr("CASE WHEN image_id % 900 = 8 THEN image_id + 100000000 ELSE image_id END"))
    return m.reconcile(t.images, export)


@query("SELECT image_id FROM images WHERE image_id NOT IN (SELECT image_id FROM det)")
def pending_inputs(t: Inputs):
    return writers.pending(t.images, t.det, ["image_id"]).select("image_id")


@query("SELECT image_id FROM images WHERE image_id IN (SELECT image_id FROM truth)")
def non_empty_images(t: Inputs):
    return m.non_empty(t.images, t.truth).select("image_id")


@query("SELECT image_id FROM images WHERE image_id NOT IN (SELECT image_id FROM truth)")
def empty_images(t: Inputs):
    return m.empty(t.images, t.truth).select("image_id")


@query("""SELECT frame_id, count(*) AS images, 6 AS expected, CAST(count(DISTINCT camera_id) AS INTEGER) AS actual,
    concat_ws(',', CASE WHEN NOT bool_or(camera_id = 'back') THEN 'back' END, CASE WHEN NOT bool_or(camera_id = 'back_left') THEN 'back_left' END,
        CASE WHEN NOT bool_or(camera_id = 'back_right') THEN 'back_right' END, CASE WHEN NOT bool_or(camera_id = 'front') THEN 'front' END,
        CASE WHEN NOT bool_or(camera_id = 'front_left') THEN 'front_left' END, CASE WHEN NOT bool_or(camera_id = 'front_right') THEN 'front_right' END) AS missing
    FROM images_dirty GROUP BY frame_id""")
def camera_coverage(t: Inputs):
    return m.camera_coverage(t.images_dirty, CAMERA_IDS).drop("dataset_id")


@query("""SELECT camera_id, CAST(sum(copies) AS BIGINT) AS tasks, count(*) AS unique_keys, CAST(sum(copies - 1) AS BIGINT) AS duplicates,
    count(*) FILTER (WHERE b = 0) AS empty, count(*) FILTER (WHERE b > 0) AS non_empty, CAST(sum(b) AS BIGINT) AS boxes
    FROM (SELECT u.camera_id, u.copies, coalesce(n.b, 0) AS b FROM (SELECT camera_id, frame_id, image_id, count(*) AS copies FROM images_dirty GROUP BY ALL) u
          LEFT JOIN (SELECT image_id, count(*) AS b FROM truth GROUP BY image_id) n ON u.image_id = n.image_id) z GROUP BY ROLLUP (camera_id)""")
def population_audit(t: Inputs):
    return m.population_audit(t.images_dirty, t.truth)


@query("""SELECT i.camera_id, b.class_id, count(*) AS boxes FROM truth b JOIN images i ON b.image_id = i.image_id GROUP BY ROLLUP (i.camera_id, b.class_id)""")
def class_audit(t: Inputs):
    return m.class_audit(t.images, t.truth)


@query("SELECT count(DISTINCT image_id) AS images, count(DISTINCT frame_id) AS frames, true AS images_close, true AS frames_close, true AS median_close FROM images")
def approx_audit(t: Inputs):
    """The sketches against the exact values: counts within 6 %, the median's rank within 1 %."""
    out = m.approx_audit(t.images, t.review)
    exact = t.images.agg(F.count_distinct("image_id").alias("images"), F.count_distinct("frame_id").alias("frames"))
    guess = out.select("approx_median_seconds").scalar()
    share = t.review.agg((F.count_if(F.col("seconds") <= guess) / F.count("seconds")).alias("s"), (F.count_if(F.col("seconds") < guess) / F.count("seconds")).alias("r")).select((F.col("s") >= 0.49) & (F.col("r") <= 0.51)).scalar()
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.06 * F.col(b)
    rows = exact.withColumns({"approx_images": out.select("approx_images").scalar(), "approx_frames": out.select("approx_frames").scalar()})
    return rows.select("images", "frames", near("approx_images", "images").alias("images_close"), near("approx_frames", "frames").alias("frames_close"), share.alias("median_close"))


@query("""SELECT 'image_id' AS key, CAST(image_id AS VARCHAR) AS value, count(*) AS rows FROM images_dirty GROUP BY image_id HAVING count(*) > 1
    UNION ALL SELECT 'frame_camera', frame_id || '|' || camera_id, count(*) FROM images_dirty GROUP BY frame_id, camera_id HAVING count(*) > 1
    UNION ALL SELECT 'source', dataset_id || '|' || capture_us || '|' || camera_id, count(*) FROM images_dirty GROUP BY dataset_id, capture_us, camera_id HAVING count(*) > 1""")
def duplicates(t: Inputs):
    return m.duplicates(t.images_dirty, {"image_id": ["image_id"], "frame_camera": ["frame_id", "camera_id"], "source": ["dataset_id", "capture_us", "camera_id"]})


@query("""SELECT count(*) AS frames, count(*) FILTER (WHERE f <> l) AS unsynchronised_frames, count(*) FILTER (WHERE o <> c) AS camera_order_conflicts,
    count(*) FILTER (WHERE f <= p) AS time_not_rising, median(f - p) AS median_step_us
    FROM (SELECT *, lag(l) OVER (ORDER BY frame_id) AS p FROM (SELECT frame_id, min(capture_us) AS f, max(capture_us) AS l, count(DISTINCT camera_order) AS o, count(DISTINCT camera_id) AS c
          FROM images_dirty GROUP BY frame_id) g) z""")
def ordering_report(t: Inputs):
    return m.ordering_report(t.images_dirty).drop("dataset_id")


@query("""SELECT s.sequence_id, min(frame_id) AS first_frame, max(frame_id) AS last_frame, count(*) AS images, count(*) FILTER (WHERE is_keyframe) AS keyframe_images,
    min(capture_us) AS first_us, max(capture_us) AS last_us FROM images i JOIN o_seq s ON i.image_id = s.image_id GROUP BY s.sequence_id""")
def sequence_summary(t: Inputs):
    return m.sequence_summary(sequenced(t)).drop("dataset_id")


@query("""SELECT f.fold_id, k.class_id, coalesce(v.n, 0) AS validation, coalesce(a.n, 0) - coalesce(v.n, 0) AS train,
    CASE WHEN coalesce(v.n, 0) = 0 OR coalesce(a.n, 0) = coalesce(v.n, 0) THEN 'not_evaluable' ELSE 'evaluable' END AS status
    FROM (SELECT DISTINCT fold_id FROM o_seq) f CROSS JOIN (SELECT CAST(unnest(range(0, 6)) AS INTEGER) AS class_id) k
    LEFT JOIN (SELECT s.fold_id, class_id, count(*) AS n FROM truth b JOIN o_seq s ON b.image_id = s.image_id GROUP BY ALL) v ON v.fold_id = f.fold_id AND v.class_id = k.class_id
    LEFT JOIN (SELECT class_id, count(*) AS n FROM truth GROUP BY class_id) a ON a.class_id = k.class_id""")
def fold_support(t: Inputs):
    return m.fold_support(t.truth, folded(t)).drop("dataset_id")


@query("""SELECT d.dataset_id, f.fold_id, k.class_id, coalesce(v.n, 0) AS validation, coalesce(a.n, 0) - coalesce(v.n, 0) AS train,
    CASE WHEN coalesce(v.n, 0) = 0 OR coalesce(a.n, 0) = coalesce(v.n, 0) THEN 'not_evaluable' ELSE 'evaluable' END AS status
    FROM (SELECT 'd0' AS dataset_id UNION ALL SELECT 'd1') d CROSS JOIN (SELECT DISTINCT fold_id FROM o_seq) f
    CROSS JOIN (SELECT CAST(unnest([0, 1, 2, 3, 4, 5, 10]) AS INTEGER) AS class_id) k
    LEFT JOIN (SELECT 'd0' AS dataset_id, s.fold_id, class_id, count(*) AS n FROM truth b JOIN o_seq s ON b.image_id = s.image_id GROUP BY ALL
               UNION ALL SELECT 'd1', s.fold_id, CASE WHEN class_id = 3 THEN 10 ELSE class_id END AS c, count(*) FROM truth b JOIN o_seq s ON b.image_id = s.image_id
               WHERE annotation_id % 3 = 0 GROUP BY ALL) v ON v.dataset_id = d.dataset_id AND v.fold_id = f.fold_id AND v.class_id = k.class_id
    LEFT JOIN (SELECT 'd0' AS dataset_id, class_id, count(*) AS n FROM truth GROUP BY class_id
               UNION ALL SELECT 'd1', CASE WHEN class_id = 3 THEN 10 ELSE class_id END AS c, count(*) FROM truth WHERE annotation_id % 3 = 0 GROUP BY c) a
      ON a.dataset_id = d.dataset_id AND a.class_id = k.class_id""")
def fold_support_two_sets(t: Inputs):
    """Two data sets whose folds have the same numbers, the second with a class outside the taxonomy."""
    images = folded(t)
    more = images.withColumns({"dataset_id": F.lit("d1"), "image_id": -F.col("image_id") - 1})
    boxes = t.truth.filter("annotation_id % 3 = 0").withColumns({"image_id": -F.col("image_id") - 1, "class_id": F.expr("CASE WHEN class_id = 3 THEN 10 ELSE class_id END")})
    return m.fold_support(t.truth.unionByName(boxes), images.unionByName(more))


@query("""SELECT object_id, count(*) AS folds, CAST(sum(n) AS BIGINT) AS rows, min(fold_id) AS first_fold, max(fold_id) AS last_fold
    FROM (SELECT g.pk AS object_id, s.fold_id, count(*) AS n FROM fx_gt g JOIN o_seq s ON g.image_key = s.image_id GROUP BY ALL) z GROUP BY object_id HAVING count(*) > 1""")
def leakage_report(t: Inputs):
    objects = t.fx_gt.select(F.col("image_key").alias("image_id"), F.col("pk").alias("object_id"))
    return m.leakage_report(objects, folded(t), "object_id")


@query("""
    SELECT 'duplicate_image_id' AS "check", CAST(image_id AS VARCHAR) AS detail FROM images_dirty GROUP BY image_id HAVING count(*) > 1
    UNION ALL SELECT 'duplicate_frame_camera', dataset_id || '|' || frame_id || '|' || camera_id FROM images_dirty GROUP BY dataset_id, frame_id, camera_id HAVING count(*) > 1
    UNION ALL SELECT 'missing_camera', frame_id || '|' || string_agg(cam, ',' ORDER BY cam) FROM (
        SELECT i.frame_id, i.camera_id AS cam FROM images i WHERE is_keyframe AND image_id NOT IN (SELECT image_id FROM images_dirty)) z GROUP BY frame_id
    UNION ALL SELECT 'image_size', CAST(image_id AS VARCHAR) FROM images_dirty WHERE is_keyframe AND width <> 1920
    UNION ALL SELECT 'unknown_image', CAST(annotation_id AS VARCHAR) FROM truth WHERE image_id NOT IN (SELECT image_id FROM images_dirty)""")
def validate_release(t: Inputs):
    return m.validate_release(t.images_dirty, t.truth, CAMERA_IDS)


@query("""SELECT class_id, camera_id, boxes, boxes / CAST((SELECT count(*) FROM truth) AS DOUBLE) AS share FROM (
    SELECT b.class_id, i.camera_id, count(*) AS boxes FROM truth b JOIN images i ON b.image_id = i.image_id GROUP BY CUBE (b.class_id, i.camera_id)) z""")
def balance(t: Inputs):
    return m.balance(t.truth, t.images)


def _tree_sql(rows: str) -> str:
    sql = f"SELECT h AS key, h || ':' || n AS entry, n FROM (SELECT h, count(*) AS n FROM ({rows}) r GROUP BY h) z"
    for digits in (6, 3, 0):
        sql = f"""SELECT key, key || ':' || hash AS entry, hash, n FROM (
            SELECT key, sha256(string_agg(entry, ';' ORDER BY entry)) AS hash, CAST(sum(n) AS BIGINT) AS n FROM (SELECT left(key, {digits}) AS key, entry, n FROM ({sql}) s{digits}) a{digits} GROUP BY key) b{digits}"""
    return f"SELECT hash AS content_hash, n AS rows FROM ({sql}) z"


ROW_JSON = """sha256('{"camera_id":"' || camera_id || '","capture_us":' || capture_us || ',"frame_id":' || frame_id || ',"image_id":' || image_id || ',"is_keyframe":' || is_keyframe || '}')"""


@query(_tree_sql(f"SELECT {ROW_JSON} AS h FROM images_dirty"))
def content_hash(t: Inputs):
    return release.content_hash(t.images_dirty.select("image_id", "frame_id", "camera_id", "capture_us", "is_keyframe"))


LINE = """'{"dataset_id":"d0","image_id":' || i.image_id || ',"width":' || width || ',"height":' || height || ',"sequence_id":"' || sequence_id || '","frame_id":' || frame_id
    || ',"is_keyframe":' || is_keyframe || ',"camera_id":"' || camera_id || '","camera_order":' || camera_order || '}'"""


@query(f"SELECT {LINE} AS value FROM images i JOIN o_seq s ON i.image_id = s.image_id")
def manifest_lines(t: Inputs):
    """The canonical text a manifest is written as."""
    columns = ["dataset_id", "image_id", "width", "height", "sequence_id", "frame_id", "is_keyframe", "camera_id", "camera_order"]
    return writers.canonical_lines(sequenced(t), columns)


@query("SELECT det_id, 'm1' AS model_version, 'r1' AS dataset_release_id, '1.23.0' AS ui_version, class_id FROM det")
def with_provenance(t: Inputs):
    from boxloom.operators.review import with_provenance as add

    return add(t.det.select("det_id", "class_id"), model_version="m1", dataset_release_id="r1", ui_version="1.23.0")


@query("""SELECT concat(i.sequence_id, '/', CAST(floor(i.frame_id / 1000) AS BIGINT)) AS shard, count(DISTINCT i.image_id) AS images, count(b.annotation_id) AS annotations,
    coalesce(sum((b.x2 - b.x1) * (b.y2 - b.y1)), 0) AS area
    FROM (SELECT images.*, o_seq.sequence_id FROM images JOIN o_seq ON images.image_id = o_seq.image_id) i LEFT JOIN truth b ON b.image_id = i.image_id GROUP BY 1""")
def coco_documents(t: Inputs):
    """COCO documents parsed back and counted per shard."""
    from boxloom.schemas import COCO

    images = sequenced(t).withColumn("relative_path", F.concat_ws("/", "camera_id", F.col("image_id").cast("string")))
    docs = writers.coco_documents(images, t.truth)
    back = docs.select("sequence_id", "block", F.from_json("value", COCO).alias("d"))
    total = F.aggregate("d.annotations", F.lit(0.0), lambda a, x: a + x["area"])
    return back.groupBy(F.concat_ws("/", "sequence_id", F.col("block").cast("string")).alias("shard")).agg(
        F.sum(F.size("d.images")).alias("images"), F.sum(F.size("d.annotations")).alias("annotations"), F.sum(total).alias("area"),
    )
