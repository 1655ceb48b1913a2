"""Queries over overlaps, matches, suppression and detection metrics."""

import pandas as pd
from pyspark.sql import functions as F

from boxloom.functions import geometry as g
from boxloom.operators.auction import assignment_gap, auction
from boxloom.operators import boxes as ob, matching, metrics as mt, pairs, review, suppression
from boxloom.plans.oracle_parts import ORACLE_VIEWS, greedy, iou_sql, scored_sql, suppression as suppress_sql
from boxloom.plans.q_boxes import ignore_polygons, rounded
from boxloom.plans.q_manifest import folded
from boxloom.plans.registry import Inputs, query
from boxloom.session import checkpointed, stored

OVERLAP = "a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2"


def clipped(t: Inputs):
    """Predictions and truth that are scored: clipped, and without those in ignore regions."""
    regions = ignore_polygons(t)
    return tuple(stored(ob.without_ignored(ob.clip_boxes(df), regions)) for df in (t.det, t.truth_seen))


def matched(t: Inputs):
    pred, truth = clipped(t)
    return pred, truth, matching.match_boxes(pred, truth, 0.5, "greedy")


def settled(t: Inputs):
    """The same with the matches frozen, so that the disk of the pairs is free before the joins that follow."""
    pred, truth, hits = matched(t)
    return pred, truth, stored(hits)


def outcomes(t: Inputs):
    return mt.detection_outcomes(*settled(t))


@query("SELECT image_id, class_id, det_id, annotation_id, round(iou, 6) AS iou FROM o_pairs")
def iou_pairs(t: Inputs):
    return rounded(pairs.iou_pairs(*clipped(t)), "iou")


@query(f"""SELECT a.det_id AS det_id_a, b.det_id AS det_id_b, round({iou_sql()}, 6) AS iou FROM o_det a JOIN o_det b
    ON a.image_id = b.image_id AND a.class_id = b.class_id AND a.det_id < b.det_id AND {OVERLAP} WHERE {iou_sql()} >= 0.3""")
def self_pairs(t: Inputs):
    return rounded(pairs.self_pairs(checkpointed(ob.clip_boxes(t.det)), 0.3), "iou").drop("image_id", "class_id")


@query(f"""SELECT a.camera_id, a.class_id, a.det_id AS det_id_a, b.det_id AS det_id_b, round({iou_sql()}, 6) AS iou FROM o_det a JOIN o_det b
    ON a.camera_id = b.camera_id AND a.class_id = b.class_id AND a.det_id < b.det_id AND {OVERLAP} WHERE {iou_sql()} >= 0.9""")
def standing_pairs(t: Inputs):
    """Boxes that stand at the same place in any two frames of a camera: groups of a camera's whole boxes, joined over levels of cells."""
    return rounded(pairs.self_pairs(checkpointed(ob.clip_boxes(t.det)), 0.9, ("camera_id", "class_id")), "iou")


ORACLE_VIEWS["o_dis_pairs"] = f"""SELECT a.image_id, a.det_id AS a_id, b.det_id AS b_id, {iou_sql()} AS iou
    FROM o_det a JOIN o_det_b b ON a.image_id = b.image_id AND {OVERLAP} WHERE {iou_sql()} >= 0.5"""
ORACLE_VIEWS.update(greedy("o_dis_pairs", "image_id", "a_id", "b_id", "o_dis", 5))
ORACLE_VIEWS["o_disagree"] = """SELECT coalesce(a.image_id, b.image_id) AS image_id, a.det_id AS a_id, b.det_id AS b_id, a.score AS a_score, a.iou,
    CASE WHEN b.det_id IS NULL THEN 'a_only' WHEN a.det_id IS NULL THEN 'b_only' WHEN a.class_id <> b.class_id THEN 'class'
         WHEN a.iou < 0.75 THEN 'location' ELSE 'agree' END AS kind
    FROM (SELECT d.*, m.b_id, m.iou FROM o_det d LEFT JOIN o_dis m ON d.det_id = m.a_id) a FULL JOIN o_det_b b ON a.b_id = b.det_id"""


def compared(t: Inputs):
    return matching.disagreements(stored(ob.clip_boxes(t.det)), stored(ob.clip_boxes(t.det_b)))


@query("SELECT image_id, a_id, b_id, kind FROM o_disagree")
def disagreements(t: Inputs):
    return compared(t).select("image_id", "a_id", "b_id", "kind")


@query("""SELECT image_id, round(max(CASE WHEN kind IN ('a_only', 'class') THEN a_score WHEN kind = 'location' THEN a_score * (1 - iou) ELSE 0 END), 6) AS mistake
    FROM o_disagree GROUP BY image_id""")
def mistake_score(t: Inputs):
    from boxloom.operators.queue import mistake_score as score

    return rounded(score(compared(t)), "mistake")


ORACLE_VIEWS["o_strong_pairs"] = "SELECT * FROM o_pairs WHERE score >= 0.8"
ORACLE_VIEWS.update(greedy("o_strong_pairs", "image_id, class_id", "det_id", "annotation_id", "o_strong", 3))


@query("SELECT det_id, image_id, class_id FROM o_pred WHERE score >= 0.8 AND det_id NOT IN (SELECT det_id FROM o_strong)")
def missing_labels(t: Inputs):
    return matching.missing_labels(*clipped(t)).select("det_id", "image_id", "class_id")


ORACLE_VIEWS["o_second"] = """SELECT annotation_id AS det_id, image_id, CASE WHEN annotation_id % 13 = 0 THEN (class_id + 1) % 6 ELSE class_id END AS class_id,
    least(x1 + annotation_id % 9, 1919) AS x1, y1, x2, y2 FROM o_truth WHERE annotation_id % 17 <> 0"""
ORACLE_VIEWS["o_rev_pairs"] = f"""SELECT a.image_id, a.annotation_id AS a_id, b.det_id AS b_id, a.class_id AS ca, b.class_id AS cb, {iou_sql()} AS iou
    FROM o_truth a JOIN o_second b ON a.image_id = b.image_id AND {OVERLAP} WHERE {iou_sql()} >= 0.5"""
ORACLE_VIEWS.update(greedy("o_rev_pairs", "image_id", "a_id", "b_id", "o_rev", 5))


@query("""SELECT decisions, agree, "class", location, na - n AS a_only, nb - n AS b_only, round(agree / CAST(decisions AS DOUBLE), 6) AS agreement,
    agree / CAST(decisions AS DOUBLE) >= 0.98 AS meets_target FROM (
    SELECT n, na, nb, na + nb - n AS decisions, (SELECT count(*) FROM o_rev WHERE ca = cb AND iou >= 0.75) AS agree, (SELECT count(*) FROM o_rev WHERE ca = cb AND iou < 0.75) AS location, (SELECT count(*) FROM o_rev WHERE ca <> cb) AS "class"
    FROM (SELECT (SELECT count(*) FROM o_rev) AS n, (SELECT count(*) FROM o_truth) AS na, (SELECT count(*) FROM o_second) AS nb) y) z""")
def double_review_agreement(t: Inputs):
    a = checkpointed(ob.clip_boxes(t.truth)).withColumnRenamed("annotation_id", "det_id").withColumn("score", F.lit(1.0))
    b = a.filter("det_id % 17 <> 0").withColumns({
        "class_id": F.expr("CASE WHEN det_id % 13 = 0 THEN (class_id + 1) % 6 ELSE class_id END"), "x1": F.expr("least(x1 + det_id % 9, 1919)"),
    })
    return rounded(review.agreement(matching.double_review(a, b)), "agreement")


# --- matching and suppression ---------------------------------------------------------

@query("SELECT image_id, class_id, det_id, annotation_id, round(iou, 6) AS iou FROM o_match")
def match_greedy(t: Inputs):
    return rounded(matched(t)[2], "iou")


# every one-to-one choice of a group's pairs, prediction by prediction; `used` holds one bit per truth
ORACLE_VIEWS["o_numbered"] = """SELECT image_id, class_id, iou, det_id, annotation_id, dense_rank() OVER (PARTITION BY image_id, class_id ORDER BY det_id) AS l,
        CAST(1 AS HUGEINT) << CAST(dense_rank() OVER (PARTITION BY image_id, class_id ORDER BY annotation_id) AS INTEGER) AS r FROM o_pairs"""


ORACLE_VIEWS["o_best"] = """SELECT image_id, class_id, total, pairs FROM (
    WITH RECURSIVE choice(image_id, class_id, l, used, total, pairs) AS (
        SELECT DISTINCT image_id, class_id, CAST(0 AS BIGINT), CAST(0 AS HUGEINT), CAST(0 AS DOUBLE), CAST([] AS STRUCT(d BIGINT, a BIGINT, v DOUBLE)[]) FROM o_numbered
        UNION ALL
        SELECT c.image_id, c.class_id, c.l + 1, c.used | coalesce(n.r, CAST(0 AS HUGEINT)), c.total + coalesce(n.iou, 0),
            CASE WHEN n.r IS NULL THEN c.pairs ELSE list_append(c.pairs, {'d': n.det_id, 'a': n.annotation_id, 'v': n.iou}) END
        FROM choice c JOIN (SELECT image_id, class_id, l, r, iou, det_id, annotation_id FROM o_numbered
                            UNION ALL SELECT DISTINCT image_id, class_id, l, CAST(NULL AS HUGEINT), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM o_numbered) n
          ON n.image_id = c.image_id AND n.class_id = c.class_id AND n.l = c.l + 1 AND (n.r IS NULL OR (c.used & n.r) = 0))
    SELECT *, row_number() OVER (PARTITION BY image_id, class_id ORDER BY round(total, 9) DESC, pairs) AS n FROM choice) z WHERE n = 1"""


@query("""SELECT image_id, class_id, p.d AS det_id, p.a AS annotation_id, round(p.v, 6) AS iou FROM (SELECT image_id, class_id, unnest(pairs) AS p FROM o_best) z""")
def match_optimal(t: Inputs):
    """Pairs of the optimal assignment per image and class."""
    return rounded(matching.match_boxes(*clipped(t), 0.5, "optimal"), "iou").select("image_id", "class_id", "det_id", "annotation_id", "iou")


# every box on a chain of 3,000 overlaps, taken in turn as prediction and truth: one component of 1,501 predictions each
LINKS = """SELECT CAST((n - n % 3000) / 3000 AS BIGINT) AS chain, n % 3000 AS k, CAST((annotation_id * 37 + class_id * 11) % 50 + 1 AS DOUBLE) / 64 AS iou
    FROM (SELECT annotation_id, class_id, row_number() OVER (ORDER BY annotation_id) - 1 AS n FROM truth) r"""
ORACLE_VIEWS["o_links"] = LINKS


@query("""SELECT chain, max(greatest(without, with_it)) AS total, true AS proved FROM (
    WITH RECURSIVE best(chain, k, without, with_it) AS (
        SELECT DISTINCT chain, CAST(-1 AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM o_links
        UNION ALL SELECT b.chain, l.k, greatest(b.without, b.with_it), b.without + l.iou FROM best b JOIN o_links l ON l.chain = b.chain AND l.k = b.k + 1)
    SELECT * FROM best) z GROUP BY chain""")
def match_auction(t: Inputs):
    """Totals of large components, auctioned in blocks; epsilon is small enough for the optimum, and the prices prove it."""
    from boxloom.operators.scale import part_running_sum, range_parts

    order = [F.col("annotation_id").asc()]
    rows = part_running_sum(range_parts(t.truth.select("annotation_id", "class_id"), [], order), [], order, {"n": F.lit(1).cast("bigint")})
    n, k = F.col("n") - 1, F.col("k")
    links = rows.select(F.floor(n / 3000).alias("chain"), (n % 3000).alias("k"), (((F.col("annotation_id") * 37 + F.col("class_id") * 11) % 50 + 1).cast("double") / 64).alias("iou"))
    pairs = links.select("chain", (k + k % 2).alias("det_id"), (k + 1 - k % 2).alias("annotation_id"), "iou")
    pairs = checkpointed(pairs)
    epsilon = 1 / 64 / 2_000
    matched, prices = auction(pairs, ["chain"], "det_id", "annotation_id", epsilon, block=256, patience=None)
    gap = assignment_gap(pairs, checkpointed(matched), prices, ["chain"], "det_id", "annotation_id")
    return gap.select("chain", "total", (F.col("gap") < 1 / 64).alias("proved"))


@query("SELECT image_id, class_id, level, det_id, annotation_id FROM o_coco_match")
def match_coco(t: Inputs):
    rows = matching.match_coco(*clipped(t)).select("image_id", "class_id", "det_id", F.posexplode("hits").alias("i", "annotation_id"))
    levels = F.array(*[F.lit(x) for x in mt.IOU_LEVELS])
    return rows.filter("annotation_id IS NOT NULL").select("image_id", "class_id", F.get(levels, F.col("i")).alias("level"), "det_id", "annotation_id")


@query("SELECT det_id, image_id, class_id FROM o_nms")
def nms(t: Inputs):
    return suppression.nms(ob.clip_boxes(t.det)).select("det_id", "image_id", "class_id")


CHAIN = """SELECT annotation_id AS det_id, CAST((n - n % 500) / 500 AS BIGINT) AS image_id, 1 AS class_id, CAST(n % 500 AS BIGINT) AS place
    FROM (SELECT annotation_id, row_number() OVER (ORDER BY annotation_id) - 1 AS n FROM truth) r"""


@query(f"SELECT det_id, image_id FROM ({CHAIN}) c WHERE place % 2 = 0")
def nms_chain(t: Inputs):
    """Chains of 500 boxes in which each overlaps the next: every second one stays."""
    from boxloom.operators.scale import part_running_sum, range_parts

    order = [F.col("annotation_id").asc()]
    rows = part_running_sum(range_parts(t.truth.select("annotation_id"), [], order), [], order, {"n": F.lit(1).cast("bigint")})
    n = F.col("n") - 1
    place = (n % 500).cast("double")
    boxes = rows.select(
        F.col("annotation_id").alias("det_id"), F.floor(n / 500).alias("image_id"), F.lit(1).alias("class_id"), (place * 3).alias("x1"), F.lit(0.0).alias("y1"),
        (place * 3 + 10).alias("x2"), F.lit(10.0).alias("y2"), (1.0 - place / 1000).alias("score"),
    )
    return suppression.nms(boxes).select("det_id", "image_id")


@query("""SELECT min(det_id) AS det_id, image_id FROM (SELECT annotation_id AS det_id, CAST((n - n % 2000) / 2000 AS BIGINT) AS image_id
    FROM (SELECT annotation_id, row_number() OVER (ORDER BY annotation_id) - 1 AS n FROM truth) r) c GROUP BY image_id""")
def nms_pile(t: Inputs):
    """Piles of 2,000 boxes in one place, no two alike: the best one stays."""
    from boxloom.operators.scale import part_running_sum, range_parts

    order = [F.col("annotation_id").asc()]
    rows = part_running_sum(range_parts(t.truth.select("annotation_id"), [], order), [], order, {"n": F.lit(1).cast("bigint")})
    n = F.col("n") - 1
    place = (n % 2000).cast("double")
    boxes = rows.select(
        F.col("annotation_id").alias("det_id"), F.floor(n / 2000).alias("image_id"), F.lit(1).alias("class_id"), (place / 1000).alias("x1"), F.lit(0.0).alias("y1"),
        (100 + place / 500).alias("x2"), F.lit(100.0).alias("y2"), (1.0 - place / 4000).alias("score"),
    )
    return suppression.nms(boxes).select("det_id", "image_id")


def fuse_sql(source: str, kept: str) -> str:
    mean = ", ".join(f"round(sum({n} * score) / sum(score) + 0.000000123, 6) AS {n}" for n in ("x1", "y1", "x2", "y2"))
    return f"""
    SELECT keeper AS det_id, {mean}, round(avg(score) + 0.000000123, 6) AS score, count(*) AS members
    FROM (SELECT det_id AS keeper, x1, y1, x2, y2, score FROM {kept}
          UNION ALL
          SELECT winner, x1, y1, x2, y2, score FROM (
              SELECT d.*, e.winner, row_number() OVER (PARTITION BY d.det_id ORDER BY e.iou DESC, e.winner) AS rn
              FROM {source} d JOIN {kept}_better e ON e.loser = d.det_id
              WHERE e.winner IN (SELECT det_id FROM {kept}) AND d.det_id NOT IN (SELECT det_id FROM {kept})) c WHERE rn = 1) z
    GROUP BY keeper"""


@query(fuse_sql("o_det", "o_nms"))
def fuse_boxes(t: Inputs):
    return fused(suppression.fuse_boxes(ob.clip_boxes(t.det)))


def fused(out):
    """Means rounded after a small shift: exact halves would depend on the order of summation."""
    return out.withColumns({n: F.round(F.col(n) + 0.000000123, 6) for n in ("x1", "y1", "x2", "y2", "score")}).drop("image_id", "class_id")


def tiled(t: Inputs):
    """Predictions as a tiled detector would give them: one box per tile reached, ids by tile."""
    cut = ob.cut_to_tiles(ob.clip_boxes(t.det))
    return cut.withColumn("det_id", F.col("det_id") * 100 + F.col("tile_x") / 512 * 10 + F.col("tile_y") / 440).withColumn("det_id", F.col("det_id").cast("bigint"))




ORACLE_VIEWS["o_tiled"] = """SELECT CAST(det_id * 100 + tile_x / 512 * 10 + tile_y / 440 AS BIGINT) AS det_id, image_id, class_id, score,
        greatest(x1, tile_x) AS x1, greatest(y1, tile_y) AS y1, least(x2, tile_x + 640) AS x2, least(y2, tile_y + 640) AS y2
    FROM o_det CROSS JOIN (SELECT unnest([0, 512, 1024, 1280]) AS tile_x) a CROSS JOIN (SELECT unnest([0, 440]) AS tile_y) b
    WHERE x1 < tile_x + 640 AND x2 > tile_x AND y1 < tile_y + 640 AND y2 > tile_y"""
ORACLE_VIEWS.update(suppress_sql("o_tiled", "o_merged", 5))


@query("SELECT det_id, image_id, class_id, x1, y1, x2, y2 FROM o_merged")
def merge_tiles(t: Inputs):
    return suppression.merge_tiles(tiled(t)).select("det_id", "image_id", "class_id", "x1", "y1", "x2", "y2")


@query(fuse_sql("o_tiled", "o_merged"))
def merge_tiles_fused(t: Inputs):
    return fused(suppression.merge_tiles(tiled(t), method="fuse"))


@query("""SELECT camera_id, tiled_boxes, merged_boxes, round((tiled_boxes - merged_boxes) / CAST(tiled_boxes AS DOUBLE), 6) AS duplicate_rate FROM (
    SELECT i.camera_id, count(*) AS tiled_boxes, count(*) FILTER (WHERE d.det_id IN (SELECT det_id FROM o_merged)) AS merged_boxes
    FROM o_tiled d JOIN images i ON d.image_id = i.image_id GROUP BY i.camera_id) z""")
def tile_duplicate_rate(t: Inputs):
    before = checkpointed(tiled(t))
    return rounded(suppression.tile_duplicate_rate(before, suppression.merge_tiles(before), ["camera_id"]), "duplicate_rate")


# --- metrics --------------------------------------------------------------------------

RATES = """count(*) FILTER (WHERE outcome = 'TP') AS tp, count(*) FILTER (WHERE outcome = 'FP') AS fp, count(*) FILTER (WHERE outcome = 'FN') AS fn,
    count(*) FILTER (WHERE outcome <> 'FP') AS n_truth,
    round(count(*) FILTER (WHERE outcome = 'TP') / CAST(nullif(count(*) FILTER (WHERE outcome <> 'FN'), 0) AS DOUBLE), 6) AS precision,
    round(count(*) FILTER (WHERE outcome = 'TP') / CAST(nullif(count(*) FILTER (WHERE outcome <> 'FP'), 0) AS DOUBLE), 6) AS recall"""


@query(f"SELECT class_id, {RATES} FROM o_outcomes GROUP BY class_id")
def detection_counts(t: Inputs):
    return rounded(mt.detection_counts(outcomes(t), ["class_id"]), "precision", "recall")


def slices(t: Inputs):
    images = folded(t).select("image_id", "camera_id", "sequence_id")
    rows = outcomes(t).join(images, "image_id")
    return mt.slice_metrics(rows, [["class_id", "size_bucket"], ["class_id"], ["camera_id"], ["size_bucket"], ["score_band"], ["occluded"], ["truncated"], ["sequence_id"], []])


SLICES = """FROM (SELECT o.*, i.camera_id, s.sequence_id FROM o_outcomes o JOIN images i ON o.image_id = i.image_id JOIN o_seq s ON o.image_id = s.image_id) z
    GROUP BY GROUPING SETS ((class_id, size_bucket), (class_id), (camera_id), (size_bucket), (score_band), (occluded), (truncated), (sequence_id), ())"""
SLICE_NAME = """CASE WHEN GROUPING(class_id) = 0 AND GROUPING(size_bucket) = 0 THEN 'class_id*size_bucket' WHEN GROUPING(class_id) = 0 THEN 'class_id'
    WHEN GROUPING(camera_id) = 0 THEN 'camera_id' WHEN GROUPING(size_bucket) = 0 THEN 'size_bucket' WHEN GROUPING(score_band) = 0 THEN 'score_band'
    WHEN GROUPING(occluded) = 0 THEN 'occluded' WHEN GROUPING(truncated) = 0 THEN 'truncated' WHEN GROUPING(sequence_id) = 0 THEN 'sequence_id' ELSE 'all' END AS slice"""


@query(f"""SELECT *, CASE WHEN n_truth < 50 THEN 'insufficient_evidence' ELSE 'supported' END AS support FROM (
    SELECT class_id, size_bucket, camera_id, score_band, occluded, truncated, sequence_id, {SLICE_NAME}, {RATES} {SLICES}) y""")
def slice_metrics(t: Inputs):
    return mt.label_support(rounded(slices(t), "precision", "recall"))


def run_counts(run: str, pred, truth, hits):
    """Counts of one run by class, frozen, so that the disk of its joins is free before the next run."""
    rows = mt.detection_outcomes(pred, truth, hits).withColumn("run", F.lit(run))
    return checkpointed(rounded(mt.detection_counts(rows, ["run", "class_id"]), "precision", "recall"))


def variants(t: Inputs):
    """Counts of two runs side by side: as detected, and after suppression."""
    pred, truth, hits = settled(t)
    first = run_counts("native", pred, truth, hits)
    kept = stored(suppression.nms(pred.select(*mt.KEYS, "det_id", "score", *g.CORNERS)))
    again = run_counts("suppressed", kept, truth, stored(matching.match_boxes(kept, truth, 0.5, "greedy")))
    return first.unionByName(again)


ORACLE_VIEWS["o_kept_pairs"] = "SELECT * FROM o_pairs WHERE det_id IN (SELECT det_id FROM o_pnms)"
ORACLE_VIEWS.update(greedy("o_kept_pairs", "image_id, class_id", "det_id", "annotation_id", "o_kept", 3))
ORACLE_VIEWS["o_runs"] = """
    SELECT 'native' AS run, class_id, outcome FROM o_outcomes
    UNION ALL SELECT 'suppressed', class_id, CASE WHEN det_id IN (SELECT det_id FROM o_kept) THEN 'TP' ELSE 'FP' END FROM o_pnms
    UNION ALL SELECT 'suppressed', class_id, 'FN' FROM o_true WHERE annotation_id NOT IN (SELECT annotation_id FROM o_kept)"""


@query(f"SELECT run, class_id, {RATES} FROM o_runs GROUP BY run, class_id")
def run_variants(t: Inputs):
    """Slice by run: detector only against suppressed output."""
    return variants(t)


ORACLE_VIEWS["o_tile_pred"] = scored_sql("o_merged")
ORACLE_VIEWS["o_tile_pairs"] = f"""SELECT * FROM (SELECT a.image_id, a.class_id, a.det_id, b.annotation_id, {iou_sql()} AS iou
    FROM o_tile_pred a JOIN o_true b ON a.image_id = b.image_id AND a.class_id = b.class_id AND {OVERLAP}) p WHERE iou >= 0.5"""
ORACLE_VIEWS.update(greedy("o_tile_pairs", "image_id, class_id", "det_id", "annotation_id", "o_tile", 4))
ORACLE_VIEWS["o_tile_runs"] = """
    SELECT 'native' AS run, class_id, outcome FROM o_outcomes
    UNION ALL SELECT 'tiled', class_id, CASE WHEN det_id IN (SELECT det_id FROM o_tile) THEN 'TP' ELSE 'FP' END FROM o_tile_pred
    UNION ALL SELECT 'tiled', class_id, 'FN' FROM o_true WHERE annotation_id NOT IN (SELECT annotation_id FROM o_tile)"""


@query(f"SELECT run, class_id, {RATES} FROM o_tile_runs GROUP BY run, class_id")
def run_tiled(t: Inputs):
    """Slice by run: native against tiled inference, tiles merged."""
    pred, truth, hits = settled(t)
    first = run_counts("native", pred, truth, hits)
    tiles = tiled(t).drop("width", "height", "tile_width", "tile_height")  # nothing after this reads them
    merged = stored(ob.without_ignored(suppression.merge_tiles(tiles), ignore_polygons(t)).drop("tile_x", "tile_y", "camera_id"))
    return first.unionByName(run_counts("tiled", merged, truth, stored(matching.match_boxes(merged, truth, 0.5, "greedy"))))


@query(f"""SELECT class_id, max(CASE WHEN run = 'native' THEN precision END) AS native_precision, max(CASE WHEN run = 'native' THEN recall END) AS native_recall,
    max(CASE WHEN run = 'suppressed' THEN precision END) AS suppressed_precision, max(CASE WHEN run = 'suppressed' THEN recall END) AS suppressed_recall
    FROM (SELECT run, class_id, {RATES} FROM o_runs GROUP BY run, class_id) z GROUP BY class_id""")
def scorecard(t: Inputs):
    rows = variants(t).withColumnRenamed("run", "model")
    return mt.scorecard(rows, "class_id", ["native", "suppressed"], ["precision", "recall"])


@query(f"""SELECT a.class_id, round(a.recall - coalesce(b.recall, 0), 6) AS drop,
    CASE WHEN a.n_truth < 50 THEN 'insufficient_evidence' WHEN a.recall - coalesce(b.recall, 0) > 0.01 + 1e-12 THEN 'fail' ELSE 'pass' END AS verdict
    FROM (SELECT class_id, {RATES} FROM o_runs WHERE run = 'native' GROUP BY class_id) a LEFT JOIN (SELECT class_id, {RATES} FROM o_runs WHERE run = 'suppressed' GROUP BY class_id) b ON a.class_id = b.class_id""")
def regression_gate(t: Inputs):
    rows = variants(t)
    out = mt.regression_gate(rows.filter("run = 'native'"), rows.filter("run = 'suppressed'"), ["class_id"])
    return rounded(out, "drop").select("class_id", "drop", "verdict")


@query("""SELECT class_id, count(*) AS matched, round(avg(1 - iou), 6) AS mean_iou_loss, round(avg(e), 6) AS mean_edge_error, max(e) AS max_edge_error, median(e) AS median_edge_error
    FROM (SELECT m.class_id, m.iou, greatest(abs(d.x1 - t.x1), abs(d.y1 - t.y1), abs(d.x2 - t.x2), abs(d.y2 - t.y2)) AS e
          FROM o_match m JOIN o_det d ON m.det_id = d.det_id JOIN o_truth t ON m.annotation_id = t.annotation_id) z GROUP BY class_id""")
def localization_error(t: Inputs):
    return rounded(mt.localization_error(*settled(t), ["class_id"]), "mean_iou_loss", "mean_edge_error")


@query("""SELECT f.fold_id, f.class_id, tp + fn AS n_truth, round(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 6) AS recall,
    CASE WHEN tp + fn < 50 THEN 'insufficient_evidence' WHEN tp / CAST(tp + fn AS DOUBLE) >= r THEN 'pass' ELSE 'fail' END AS verdict
    FROM (SELECT k.fold_id, k.class_id, coalesce(c.tp, 0) AS tp, coalesce(c.fn, 0) AS fn, CASE WHEN k.class_id IS NULL OR k.class_id IN (0, 1) THEN 0.95 ELSE 0.90 END AS r
          FROM (SELECT * FROM (SELECT DISTINCT s.fold_id FROM o_outcomes o JOIN o_seq s ON o.image_id = s.image_id) f
                CROSS JOIN (SELECT CAST(unnest(range(0, 6)) AS INTEGER) AS class_id UNION ALL SELECT NULL) c) k
          LEFT JOIN (SELECT s.fold_id, o.class_id, count(*) FILTER (WHERE outcome = 'TP') AS tp, count(*) FILTER (WHERE outcome = 'FN') AS fn
                     FROM o_outcomes o JOIN o_seq s ON o.image_id = s.image_id GROUP BY GROUPING SETS ((s.fold_id, o.class_id), (s.fold_id))) c
            ON c.fold_id = k.fold_id AND c.class_id IS NOT DISTINCT FROM k.class_id) f""")
def development_gate(t: Inputs):
    rows = outcomes(t).join(folded(t).select("image_id", "fold_id"), "image_id")
    counts = mt.detection_counts(rows, ["fold_id", "class_id"])
    out = mt.development_gate(counts, mt.default_recall_rules(t.spark))
    return rounded(out, "recall").select("fold_id", "class_id", "n_truth", "recall", "verdict")


@query(f"""SELECT class_id, camera_id, size_bucket, n, round(p, 6) AS precision, round((p + z2/(2*n) - z*sqrt(p*(1 - p)/n + z2/(4*n*n)))/(1 + z2/n), 6) AS wilson_lower,
    coalesce(n >= 200 AND p >= 0.98 AND (p + z2/(2*n) - z*sqrt(p*(1 - p)/n + z2/(4*n*n)))/(1 + z2/n) >= 0.98 AND recall >= 0.9 AND class_id <> 3, false) AS eligible
    FROM (SELECT *, tp + fp AS n, CAST(tp AS DOUBLE)/nullif(tp + fp, 0) AS p, 1.959963984540054 AS z, 1.959963984540054*1.959963984540054 AS z2 FROM (
        SELECT o.class_id, i.camera_id, o.size_bucket, {RATES} FROM o_outcomes o JOIN images i ON o.image_id = i.image_id GROUP BY ALL) y) x""")
def acceptance_gate(t: Inputs):
    keys = ["class_id", "camera_id", "size_bucket"]
    rows = outcomes(t).join(t.images.select("image_id", "camera_id"), "image_id")
    counts = mt.detection_counts(rows, keys).withColumn("min_recall", F.lit(0.9))
    flags = counts.select(*keys, F.expr("CASE WHEN class_id = 3 THEN 1 ELSE 0 END").alias("open_flags"), F.lit(True).alias("approved"))
    out = mt.acceptance_gate(counts, flags, keys)
    return rounded(out, "precision", "wilson_lower").select(*keys, "n", "precision", "wilson_lower", "eligible")


@query("""SELECT class_id, round(fn * 1000.0 / (SELECT count(*) FROM images), 6) AS missed_per_1000, round(fp * 1000.0 / (SELECT count(*) FROM images), 6) AS false_per_1000
    FROM (SELECT class_id, count(*) FILTER (WHERE outcome = 'FN') AS fn, count(*) FILTER (WHERE outcome = 'FP') AS fp FROM o_outcomes GROUP BY class_id) z""")
def per_thousand(t: Inputs):
    counts = mt.detection_counts(outcomes(t), ["class_id"])
    out = mt.per_thousand(counts, t.images.agg(F.count(F.lit(1))).scalar())
    return rounded(out, "missed_per_1000", "false_per_1000").select("class_id", "missed_per_1000", "false_per_1000")


# --- COCO -----------------------------------------------------------------------------

def scored(t: Inputs):
    return matching.match_coco(*clipped(t))


def scored_with_counts(t: Inputs):
    """The scored predictions, and the number of truth boxes per class, from one pass over the inputs."""
    pred, truth = clipped(t)
    return matching.match_coco(pred, truth), truth.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_truth"))


@query("SELECT class_id, level, det_id, cum_tp, cum_fp FROM o_cum")
def cumulative_tp_fp(t: Inputs):
    return mt.cumulative_tp_fp(scored(t)).select("class_id", "level", "det_id", "cum_tp", "cum_fp")


# quotients of counts can be exact halves of the last digit, which two engines round apart: shift them a little
HALF = 0.000000001


@query(f"SELECT class_id, level, det_id, round(precision + {HALF}, 6) AS precision, round(recall + {HALF}, 6) AS recall FROM o_curve")
def pr_curve(t: Inputs):
    out = mt.pr_curve(*scored_with_counts(t))
    out = out.withColumns({c: F.col(c) + HALF for c in ("precision", "recall")})
    return rounded(out, "precision", "recall").select("class_id", "level", "det_id", "precision", "recall")


@query(f"""SELECT class_id, level, cum_tp, round(max(max(precision)) OVER (PARTITION BY class_id, level ORDER BY cum_tp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) + {HALF}, 6) AS envelope
    FROM o_curve GROUP BY class_id, level, cum_tp""")
def precision_envelope(t: Inputs):
    keys = ["class_id", "level"]
    out = mt.precision_envelope(mt.pr_curve(*scored_with_counts(t)), keys)
    return rounded(out.withColumn("envelope", F.col("envelope") + HALF), "envelope").select(*keys, "cum_tp", "envelope")


@query("""SELECT k.class_id, coalesce(t.n_truth, 0) AS n_truth,
    CASE WHEN t.n_truth > 0 THEN round(coalesce(max(ap) FILTER (WHERE level = 0.5), 0), 6) END AS ap50, CASE WHEN t.n_truth > 0 THEN round(coalesce(sum(ap), 0) / 10, 6) END AS ap50_95
    FROM (SELECT class_id FROM o_pred UNION SELECT class_id FROM o_true) k LEFT JOIN o_truth_counts t ON k.class_id = t.class_id LEFT JOIN o_ap a ON k.class_id = a.class_id
    GROUP BY k.class_id, t.n_truth""")
def average_precision(t: Inputs):
    return rounded(mt.coco_summary(*scored_with_counts(t)), "ap50", "ap50_95")


@query("SELECT class_id, round(sqrt(avg(score * score)), 6) AS rms FROM det GROUP BY class_id")
def user_metric(t: Inputs):
    """A user metric as additive parts: root mean square score per class."""
    parts = {"sq": (_sum_squares, ["score"]), "n": (_count, ["score"])}
    return rounded(mt.slice_metric(t.det, ["class_id"], parts, F.sqrt(F.col("sq") / F.col("n")), ident="det_id", name="rms"), "rms")


def _sum_squares(score: pd.Series) -> float:
    return float((score * score).sum())


def _count(score: pd.Series) -> float:
    return float(len(score))
