"""Queries over review events, corrections, samples, calibration and the review queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.constants import SMALL_AREA
from boxloom.functions import geometry as g, scalars as s
from boxloom.operators import calibration as cal, queue as qu, review as rv, similarity as si
from boxloom.plans.q_boxes import rounded
from boxloom.plans.q_detection import compared, matched, outcomes
from boxloom.plans.oracle_parts import AREA, ORACLE_VIEWS
from boxloom.plans.registry import Inputs, query
from boxloom.session import checkpointed, stored

ORACLE_VIEWS["o_diff"] = """
    SELECT coalesce(a.image_id, b.image_id) AS image_id, coalesce(a.result_id, b.result_id) AS result_id,
        CASE WHEN a.image_id IS NULL THEN 'created' WHEN b.image_id IS NULL THEN 'deleted' WHEN a.class_id <> b.class_id THEN 'relabelled'
             WHEN greatest(abs(a.x1 - b.x1), abs(a.y1 - b.y1), abs(a.x2 - b.x2), abs(a.y2 - b.y2)) > 1 THEN 'resized' ELSE 'unchanged' END AS action,
        coalesce(a.class_id, b.class_id) AS class_id
    FROM predicted a FULL JOIN submitted b ON a.result_id = b.result_id AND a.image_id = b.image_id"""


def diff(t: Inputs):
    return rv.review_diff(t.predicted, t.submitted)


@query("SELECT image_id, result_id, action FROM o_diff")
def review_diff(t: Inputs):
    return diff(t).select("image_id", "result_id", "action")


@query("""SELECT d.image_id, d.result_id, CASE WHEN t.outcome <> 'submitted' THEN 'unreviewed_prediction' WHEN action = 'unchanged' THEN 'human_verified'
    WHEN action IN ('resized', 'relabelled') THEN 'human_modified' WHEN action = 'created' THEN 'human_created' ELSE 'rejected_prediction' END AS review_status
    FROM o_diff d JOIN tasks t ON d.image_id = t.image_id""")
def map_review_state(t: Inputs):
    return rv.map_review_state(diff(t), t.tasks).select("image_id", "result_id", "review_status")


@query("""SELECT image_id, CASE WHEN outcome <> 'submitted' THEN 'unreviewed' WHEN image_id IN (SELECT image_id FROM submitted) THEN 'reviewed' ELSE 'verified_empty' END AS annotation_status FROM tasks""")
def image_status(t: Inputs):
    return rv.image_status(t.tasks, t.submitted).select("image_id", "annotation_status")


@query("""SELECT event_id, CASE event WHEN 'displayed' THEN 'unreviewed_prediction' WHEN 'submit_unchanged' THEN 'human_verified' WHEN 'submit_modified' THEN 'human_modified'
    WHEN 'submit_created' THEN 'human_created' END AS state FROM review""")
def event_state(t: Inputs):
    return t.review.select("event_id", rv.event_state(F.col("event")).alias("state"))


@query("""SELECT class_id, count(*) FILTER (WHERE action = 'unchanged') AS unchanged, count(*) FILTER (WHERE action = 'resized') AS resized,
    count(*) FILTER (WHERE action = 'relabelled') AS relabelled, count(*) FILTER (WHERE action = 'deleted') AS deleted, count(*) FILTER (WHERE action = 'created') AS created
    FROM o_diff GROUP BY class_id""")
def correction_counts(t: Inputs):
    rows = diff(t).withColumn("class_id", F.coalesce("before.class_id", "after.class_id"))
    return rv.correction_counts(rows, ["class_id"])


@query("""SELECT image_id, event, event_id FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY ts DESC, event_id DESC) AS n FROM review) z WHERE n = 1""")
def latest_state(t: Inputs):
    return rv.latest_state(t.review, ["image_id"], ["ts", "event_id"]).select("image_id", "event", "event_id")


USED = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY annotator_id ORDER BY ts, event_id) AS n FROM review) w WHERE n > 5)"


@query(f"""SELECT annotator_id, manual_tasks, round(manual_median_seconds, 6) AS manual_median_seconds, assisted_tasks, round(assisted_median_seconds, 6) AS assisted_median_seconds,
    round(1 - assisted_median_seconds / manual_median_seconds, 6) AS reduction, 1 - assisted_median_seconds / manual_median_seconds >= 0.6 AS meets_target
    FROM (SELECT annotator_id, nullif(count(*) FILTER (WHERE NOT assisted), 0) AS manual_tasks, median(seconds) FILTER (WHERE NOT assisted) AS manual_median_seconds,
                 nullif(count(*) FILTER (WHERE assisted), 0) AS assisted_tasks, median(seconds) FILTER (WHERE assisted) AS assisted_median_seconds
          FROM {USED} u GROUP BY ROLLUP (annotator_id)) z""")
def review_time(t: Inputs):
    return rounded(rv.review_time(t.review), "manual_median_seconds", "assisted_median_seconds", "reduction")


@query("""SELECT annotator_id, count(*) AS images, count(*) FILTER (WHERE event = 'skipped') AS failures,
    round(count(*) * 1000000.0 / nullif(epoch_us(max(ts)) - epoch_us(min(ts)), 0), 6) AS images_per_second, round(count(*) FILTER (WHERE event = 'skipped') / CAST(count(*) AS DOUBLE), 6) AS failure_rate
    FROM review GROUP BY annotator_id""")
def run_throughput(t: Inputs):
    log = t.review.withColumns({"ts": F.col("ts").cast("timestamp"), "failed": F.col("event") == "skipped"})
    return rounded(rv.run_throughput(log, ["annotator_id"]).drop("span_us"), "images_per_second", "failure_rate")


# --- samples --------------------------------------------------------------------------

def for_gold(t: Inputs):
    rare = t.truth.groupBy("image_id").agg(F.max(F.col("class_id").isin(0, 2)).alias("rare"), F.max("truncated").alias("cut"))
    rows = t.images.join(rare, "image_id", "left").fillna(False, ["rare", "cut"])
    return rows.join(t.tasks.select("image_id", "outcome"), "image_id").withColumn("verified_empty", F.col("outcome") == "submitted")


HASH = "sha256('7|d0|' || frame_id || '|' || camera_id)"
GOLD = f"""
    (SELECT i.*, coalesce(b.rare, false) AS rare, coalesce(b.cut, false) AS cut, t.outcome = 'submitted' AS verified_empty, {HASH} AS h, sha256('7|d0|' || frame_id) AS gh
     FROM images i JOIN tasks t ON i.image_id = t.image_id
     LEFT JOIN (SELECT image_id, bool_or(class_id IN (0, 2)) AS rare, bool_or(truncated) AS cut FROM truth GROUP BY image_id) b ON i.image_id = b.image_id)"""


GOLD_SAMPLE = f"""SELECT image_id, string_agg(reason, ',' ORDER BY reason) AS sampling_reason FROM (
    SELECT image_id, 'representative' AS reason FROM images WHERE frame_id IN (SELECT frame_id FROM (SELECT DISTINCT frame_id, gh FROM {GOLD} g) f ORDER BY gh, frame_id LIMIT 20)
    UNION ALL SELECT image_id, 'rare_class' FROM (SELECT *, row_number() OVER (ORDER BY h, image_id) AS n FROM {GOLD} g WHERE rare) r WHERE n <= 30
    UNION ALL SELECT image_id, 'truncated' FROM (SELECT *, row_number() OVER (ORDER BY h, image_id) AS n FROM {GOLD} g WHERE cut) r WHERE n <= 30
    UNION ALL SELECT image_id, 'verified_empty' FROM (SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY h, image_id) AS n FROM {GOLD} g WHERE verified_empty) r WHERE n <= 5) z
    GROUP BY image_id"""


@query(GOLD_SAMPLE)
def gold_sample(t: Inputs):
    return gold_rows(t)


def gold_rows(t: Inputs):
    strata = {"rare_class": F.col("rare"), "truncated": F.col("cut")}
    return rv.gold_sample(for_gold(t), strata, "7", groups=20, per_stratum=30, empty_per_camera=5)


@query(f"""SELECT annotators, round(reduction, 6) AS reduction, round(mr, 6) AS manual_recall, round(ar, 6) AS assisted_recall,
    CASE WHEN annotators < 2 THEN 'insufficient_evidence' WHEN reduction >= 0.01 AND mr - ar <= 0.01 THEN 'pass' ELSE 'fail' END AS verdict FROM (
    SELECT (SELECT count(*) FROM (SELECT annotator_id FROM {USED} u GROUP BY annotator_id HAVING least(count(*) FILTER (WHERE assisted), count(*) FILTER (WHERE NOT assisted)) >= 1) z) AS annotators,
           (SELECT 1 - median(seconds) FILTER (WHERE assisted) / median(seconds) FILTER (WHERE NOT assisted) FROM {USED} u) AS reduction,
           (SELECT count(*) FILTER (WHERE outcome = 'TP') / CAST(count(*) FILTER (WHERE outcome <> 'FP') AS DOUBLE) FROM o_outcomes WHERE image_id % 2 = 1) AS mr,
           (SELECT count(*) FILTER (WHERE outcome = 'TP') / CAST(count(*) FILTER (WHERE outcome <> 'FP') AS DOUBLE) FROM o_outcomes WHERE image_id % 2 = 0) AS ar) y""")
def human_time_result(t: Inputs):
    """Even images stand for the assisted arm; an annotator works in one arm here, so none is in both."""
    counts = outcomes(t).groupBy((F.col("image_id") % 2 == 0).alias("assisted")).agg(F.count_if(F.col("outcome") == "TP").alias("tp"), F.count_if(F.col("outcome") == "FN").alias("fn"))
    out = rv.human_time_result(rv.review_time(t.review), counts, target=0.01, min_tasks=1)
    return rounded(out, "reduction", "manual_recall", "assisted_recall")


@query("""SELECT i.image_id, round(1 - n / CAST(max(n) OVER () AS DOUBLE), 6) AS under_represented, round(t.temporal, 6) AS temporal FROM images i
    JOIN (SELECT camera_id, hour(make_timestamp(capture_us)) AS h, count(*) AS n FROM images GROUP BY ALL) c ON c.camera_id = i.camera_id AND c.h = hour(make_timestamp(i.capture_us))
    LEFT JOIN (SELECT image_id, avg(CASE WHEN isolated THEN 1.0 ELSE 0.0 END) AS temporal FROM (
        SELECT image_id, count(*) OVER (PARTITION BY track_id ORDER BY frame_id RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) < 3 AS isolated FROM tracks) s GROUP BY image_id) t ON t.image_id = i.image_id""")
def queue_signals(t: Inputs):
    """Rarity of camera and hour, and boxes that stand alone in time."""
    from boxloom.operators.tracking import suppress_isolated

    images = t.images.withColumn("hour", F.hour(F.timestamp_micros("capture_us")))
    rare = qu.under_represented(images, ["camera_id", "hour"])
    lone = qu.temporal_inconsistency(suppress_isolated(t.tracks, min_hits=3, window=1))
    return rounded(rare.join(lone, "image_id", "left"), "under_represented", "temporal")


@query("""SELECT vec_id, round(1.0 / count(*) OVER (PARTITION BY label), 6) AS diversity FROM vectors""")
def diversity_signal(t: Inputs):
    return rounded(qu.diversity(t.vectors), "diversity")


@query("""SELECT annotator_id, image_id, CASE WHEN 2*n <= c + 1 THEN 'manual_first' ELSE 'assisted_first' END AS arm FROM (
    SELECT *, row_number() OVER (PARTITION BY annotator_id ORDER BY sha256('7|' || annotator_id || '|' || image_id), image_id) AS n, count(*) OVER (PARTITION BY annotator_id) AS c
    FROM (SELECT DISTINCT annotator_id, image_id FROM review) u) z""")
def crossover(t: Inputs):
    return rv.crossover(t.review.select("annotator_id", "image_id").distinct(), "7")


# --- calibration ----------------------------------------------------------------------

def scored(t: Inputs):
    """Predictions and whether they hit: the truth itself is not met again."""
    pred, _, hits = matched(t)
    keys = ["image_id", "class_id", "det_id"]
    rows = pred.select(*keys, "score").join(hits.select(*keys, F.lit(True).alias("tp")), keys, "left")
    return rows.withColumn("tp", F.coalesce("tp", F.lit(False)))


ORACLE_VIEWS["o_hits"] = "SELECT image_id, class_id, det_id, score, outcome = 'TP' AS tp FROM o_outcomes WHERE det_id IS NOT NULL"


@query("""SELECT class_id, n, round(t, 6) AS temperature, round(nll, 4) AS nll FROM (
    SELECT class_id, t, count(*) AS n, sum(ln(1 + exp(-(CASE WHEN tp THEN l ELSE -l END) / t))) AS nll, row_number() OVER (PARTITION BY class_id ORDER BY sum(ln(1 + exp(-(CASE WHEN tp THEN l ELSE -l END) / t))), t) AS rn
    FROM (SELECT class_id, tp, ln(p / (1 - p)) AS l FROM (SELECT class_id, tp, least(greatest(score, 0.000001), 0.999999) AS p FROM o_hits) a) b
    CROSS JOIN (SELECT 0.05 * pow(pow(400.0, 1.0 / 24), i) AS t FROM (SELECT unnest(range(0, 25)) AS i) r) g GROUP BY class_id, t) z WHERE rn = 1""")
def temperature_grid(t: Inputs):
    return cal.fit_temperature(scored(t), refine=0).withColumns({"temperature": F.round("temperature", 6), "nll": F.round("nll", 4)})


ORACLE_VIEWS["o_signed"] = """SELECT i.image_id AS vec_id, CASE WHEN i.image_id % 3 = 0 THEN h WHEN i.image_id % 3 = 1 THEN xor(h, CAST(1 AS UBIGINT) << CAST(i.image_id % 64 AS INTEGER))
    ELSE xor(xor(h, CAST(1 AS UBIGINT) << CAST(i.image_id % 61 AS INTEGER)), CAST(1 AS UBIGINT) << 63) END AS h FROM images i JOIN o_signs g ON g.vec_id = i.image_id % 211"""


@query("""SELECT p.id_a, p.id_b, p.distance, a.fold_id AS fold_a, b.fold_id AS fold_b FROM (
    SELECT r.vec_id AS id_a, h.vec_id AS id_b, 0 AS distance FROM o_signed h JOIN (SELECT h, min(vec_id) AS vec_id FROM o_signed GROUP BY h) r ON h.h = r.h WHERE h.vec_id <> r.vec_id
    UNION ALL SELECT a.vec_id, b.vec_id, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) FROM (SELECT h, min(vec_id) AS vec_id FROM o_signed GROUP BY h) a
    JOIN (SELECT h, min(vec_id) AS vec_id FROM o_signed GROUP BY h) b ON a.vec_id < b.vec_id AND bit_count(xor(a.h, b.h)) <= 3) p
    JOIN o_seq a ON a.image_id = p.id_a JOIN o_seq b ON b.image_id = p.id_b WHERE a.fold_id <> b.fold_id""")
def near_leakage(t: Inputs):
    """Near duplicates over folds: images carry the hash of a vector, some with one or two bits turned."""
    from boxloom.plans.q_manifest import folded
    from boxloom.operators.manifest import near_leakage as leaked

    hashes = checkpointed(t.vectors.select("vec_id", s.sign_hash("embedding").alias("hash")))
    images = folded(t).withColumn("vec_id", F.col("image_id") % 211)
    flip = "CASE WHEN image_id % 3 = 0 THEN hash WHEN image_id % 3 = 1 THEN hash ^ shiftleft(1L, cast(image_id % 64 AS int)) ELSE hash ^ shiftleft(1L, cast(image_id % 61 AS int)) ^ shiftleft(1L, 63) END"
    rows = images.join(hashes, "vec_id").select("image_id", F.expr(flip).alias("hash"))
    return leaked(qu.near_duplicates(rows, 3), images)


@query()
def fit_temperature(t: Inputs):
    rows = checkpointed(scored(t))
    return cal.apply_temperature(rows, cal.fit_temperature(rows)).select("det_id", "class_id", "score", "calibrated")


# the isotonic fit at a score is the largest, over what starts at or before it, of the least mean up to what ends at or after it
ORACLE_VIEWS["o_iso_points"] = """SELECT class_id, score, row_number() OVER w AS i, sum(y) OVER w AS cy, sum(n) OVER w AS cn, y, n
    FROM (SELECT class_id, score, sum(CASE WHEN tp THEN 1.0 ELSE 0.0 END) AS y, count(*) AS n FROM o_hits GROUP BY ALL) p
    WINDOW w AS (PARTITION BY class_id ORDER BY score ROWS UNBOUNDED PRECEDING)"""
ORACLE_VIEWS["o_iso"] = """SELECT class_id, score, max(least_mean) AS calibrated FROM (
        SELECT k.class_id, k.score, a.i, min((b.cy - a.cy + a.y) / CAST(b.cn - a.cn + a.n AS DOUBLE)) AS least_mean
        FROM o_iso_points k JOIN o_iso_points a ON a.class_id = k.class_id AND a.i <= k.i JOIN o_iso_points b ON b.class_id = k.class_id AND b.i >= k.i
        GROUP BY k.class_id, k.score, a.i) z GROUP BY class_id, score"""


@query("""SELECT h.det_id, h.class_id, h.score, CASE WHEN c.n >= 50 THEN round(o.calibrated, 5) END AS calibrated FROM o_hits h JOIN o_iso o ON o.class_id = h.class_id AND o.score = h.score
    JOIN (SELECT class_id, count(*) AS n FROM o_hits GROUP BY class_id) c ON c.class_id = h.class_id""")
def fit_isotonic(t: Inputs):
    rows = checkpointed(scored(t))
    out = cal.apply_isotonic(rows, cal.fit_isotonic(rows, list(range(6)), min_n=50))
    return out.select("det_id", "class_id", "score", F.round("calibrated", 5).alias("calibrated"))


BINS = "SELECT class_id, least(CAST(floor(score * 10) AS INTEGER), 9) AS bin, count(*) AS n, avg(score) AS mean_score, avg(CASE WHEN tp THEN 1.0 ELSE 0.0 END) AS tp_rate FROM o_hits GROUP BY ALL"


@query(f"SELECT class_id, bin, n, round(mean_score, 6) AS mean_score, round(tp_rate, 6) AS tp_rate FROM ({BINS}) z")
def reliability(t: Inputs):
    return rounded(cal.reliability(scored(t), ["class_id"]), "mean_score", "tp_rate")


@query(f"SELECT class_id, CAST(sum(n) AS BIGINT) AS n, round(sum(n * abs(mean_score - tp_rate)) / sum(n), 6) AS ece FROM ({BINS}) z GROUP BY class_id")
def calibration_error(t: Inputs):
    return rounded(cal.calibration_error(scored(t), ["class_id"]), "ece")


# --- queue ----------------------------------------------------------------------------

ORACLE_VIEWS["o_margin"] = """SELECT image_id, arg_min(class_id, rn) AS class_id, max(CASE WHEN rn = 1 THEN score END) - coalesce(max(CASE WHEN rn = 2 THEN score END), 0) AS margin
    FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, class_id) AS rn FROM (SELECT image_id, class_id, max(score) AS score FROM det GROUP BY ALL) a) b
    WHERE rn <= 2 GROUP BY image_id"""


@query("SELECT image_id, class_id, round(margin, 6) AS margin FROM o_margin")
def class_margin(t: Inputs):
    return rounded(qu.class_margin(t.det, ["image_id"]), "margin")


@query("SELECT det_id, score, round(percent_rank() OVER (ORDER BY score), 6) AS score_rank FROM det")
def rank_signal(t: Inputs):
    return rounded(qu.rank_signal(t.det.select("det_id", "score"), "score"), "score_rank")


def signals(t: Inputs):
    """Signals of every image that has a prediction, from the operators that make them."""
    boxes = t.det.groupBy("image_id", "camera_id").agg(
        F.max(s.binary_entropy("score")).alias("uncertainty"),
        F.max(((F.col("class_id").isin(0, 2)) | (g.area(g.corners()) < SMALL_AREA)).cast("double")).alias("rare_small"),
        F.min("class_id").alias("class_id"),
    )
    margin = qu.class_margin(t.det, ["image_id"]).select("image_id", (1.0 - F.col("margin")).alias("low_margin"))
    apart = stored(compared(t))
    doubt = apart.groupBy("image_id").agg(F.avg((F.col("kind") != "agree").cast("double")).alias("disagreement"))
    wrong = qu.mistake_score(apart)
    return boxes.join(margin, "image_id", "left").join(doubt, "image_id", "left").join(wrong, "image_id", "left")


WEIGHTS = {"uncertainty": 1.0, "low_margin": 0.5, "disagreement": 2.0, "rare_small": 0.7, "mistake": 1.5}
ORACLE_VIEWS["o_signals"] = f"""
    SELECT b.*, round(uncertainty + 0.5 * (1 - margin) + 2.0 * coalesce(disagreement, 0) + 0.7 * rare_small + 1.5 * coalesce(mistake, 0), 6) AS priority
    FROM (SELECT image_id, camera_id, max(-(p*log2(p) + (1 - p)*log2(1 - p))) AS uncertainty, CAST(max(CASE WHEN class_id IN (0, 2) OR {AREA.format(p='')} < 1024 THEN 1 ELSE 0 END) AS DOUBLE) AS rare_small, min(class_id) AS class_id
          FROM (SELECT *, least(greatest(score, 0.000001), 0.999999) AS p FROM det) d GROUP BY ALL) b
    JOIN o_margin m ON b.image_id = m.image_id
    LEFT JOIN (SELECT image_id, avg(CASE WHEN kind <> 'agree' THEN 1.0 ELSE 0.0 END) AS disagreement,
                 max(CASE WHEN kind IN ('a_only', 'class') THEN a_score WHEN kind = 'location' THEN a_score * (1 - iou) ELSE 0 END) AS mistake FROM o_disagree GROUP BY image_id) w ON b.image_id = w.image_id"""


def prioritised(t: Inputs):
    return rounded(qu.review_priority(signals(t), WEIGHTS), "priority")


@query("SELECT image_id, priority FROM o_signals")
def review_priority(t: Inputs):
    return prioritised(t).select("image_id", "priority")


@query("SELECT image_id, priority FROM o_signals ORDER BY priority DESC, image_id LIMIT 100")
def top_queue(t: Inputs):
    return qu.top_queue(prioritised(t), 100).select("image_id", "priority")


@query("SELECT image_id, class_id, camera_id, row_number() OVER (PARTITION BY class_id, camera_id ORDER BY priority DESC, image_id) AS quota_rank FROM o_signals")
def quota_rank(t: Inputs):
    rows = prioritised(t)
    return qu.quota_rank(rows, ["class_id", "camera_id"]).select("image_id", "class_id", "camera_id", "quota_rank")


@query("""SELECT image_id, CASE WHEN q <= 5 THEN 'quota' ELSE 'fill' END AS picked_by FROM (
    SELECT *, row_number() OVER (PARTITION BY class_id, camera_id ORDER BY priority DESC, image_id) AS q FROM o_signals) z
    ORDER BY CASE WHEN q <= 5 THEN 0 ELSE 1 END, priority DESC, image_id LIMIT 250""")
def quota_batch(t: Inputs):
    rows = prioritised(t)
    return qu.quota_batch(rows, ["class_id", "camera_id"], 5, 250).select("image_id", "picked_by")


ORACLE_VIEWS["o_hashed"] = """SELECT vec_id, h FROM o_signs UNION ALL SELECT vec_id + 1000000, xor(h, CASE vec_id % 3 WHEN 0 THEN CAST(0 AS UBIGINT) WHEN 1 THEN CAST(1 AS UBIGINT) << (vec_id % 64)
    ELSE (CAST(1 AS UBIGINT) << (vec_id % 64)) | (CAST(1 AS UBIGINT) << ((vec_id + 9) % 64)) END) FROM o_signs"""


@query("""SELECT r.vec_id AS id_a, h.vec_id AS id_b, 0 AS distance FROM o_hashed h JOIN (SELECT h, min(vec_id) AS vec_id FROM o_hashed GROUP BY h) r ON h.h = r.h WHERE h.vec_id <> r.vec_id
    UNION ALL SELECT a.vec_id, b.vec_id, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) FROM (SELECT h, min(vec_id) AS vec_id FROM o_hashed GROUP BY h) a
    JOIN (SELECT h, min(vec_id) AS vec_id FROM o_hashed GROUP BY h) b ON a.vec_id < b.vec_id AND bit_count(xor(a.h, b.h)) <= 3""")
def near_duplicates(t: Inputs):
    """Sign hashes of the vectors, each with a further row that is a copy or differs in one or two bits."""
    rows = checkpointed(t.vectors.select("vec_id", s.sign_hash("embedding").alias("hash")))
    flip = "hash ^ CASE WHEN vec_id % 3 = 0 THEN 0L WHEN vec_id % 3 = 1 THEN shiftleft(1L, cast(vec_id % 64 AS int)) ELSE shiftleft(1L, cast(vec_id % 64 AS int)) | shiftleft(1L, cast((vec_id + 9) % 64 AS int)) END"
    more = rows.select((F.col("vec_id") + 1000000).alias("vec_id"), F.expr(flip).alias("hash"))
    return qu.near_duplicates(rows.unionByName(more), 3, ident="vec_id")


@query()
def diverse_pick(t: Inputs):
    """Best vector of each cluster, none a near duplicate of a better pick, over all vectors and their near copies."""
    return qu.diverse_pick(near_copies(t), 20, 7, min_cosine=0.9).select("cluster", "cluster_size", "vec_id")


#: How strongly the copies of a vector are moved: not at all, and to cosines on both sides of 0.9.
SHIFTS = (0.0, 0.0, 0.008, 0.013, 0.019)
SHIFTED = "list_transform(embedding, lambda x, j: CAST(x AS DOUBLE) + {e} * ((j * 31 + {k} * 17) % 13 - 6))"
ORACLE_VIEWS["o_near"] = f"""SELECT vec_id * {len(SHIFTS)} + c AS vec_id, {SHIFTED.format(e="e", k="vec_id")} AS v
    FROM vectors CROSS JOIN (SELECT unnest(range(0, {len(SHIFTS)})) AS c, unnest([{", ".join(f"CAST({x} AS DOUBLE)" for x in SHIFTS)}]) AS e) s"""
ORACLE_VIEWS["o_imaged"] = f"""SELECT image_id AS vec_id, {SHIFTED.format(e="e", k="vec_id")} AS v
    FROM (SELECT i.image_id, v.vec_id, v.embedding, list_extract([{", ".join(f"CAST({x} AS DOUBLE)" for x in SHIFTS)}], CAST((i.image_id - i.image_id % 211) / 211 AS BIGINT) % {len(SHIFTS)} + 1) AS e
          FROM images i JOIN vectors v ON v.vec_id = i.image_id % 211) z"""


def pairs_sql(view: str) -> str:
    """Copies against the smallest id of their vector, and pairs of different vectors at a cosine of 0.9."""
    firsts = f"SELECT v, min(vec_id) AS vec_id FROM {view} GROUP BY v"
    return f"""SELECT r.vec_id AS id_a, n.vec_id AS id_b, CAST(1 AS DOUBLE) AS cosine FROM {view} n JOIN ({firsts}) r ON n.v = r.v WHERE n.vec_id <> r.vec_id
    UNION ALL SELECT a.vec_id, b.vec_id, list_cosine_similarity(a.v, b.v) FROM ({firsts}) a JOIN ({firsts}) b ON a.vec_id < b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9"""


def shifted(e, k: str):
    return F.transform("embedding", lambda x, j: x.cast("double") + e * (((j + 1).cast("bigint") * 31 + F.col(k) * 17) % 13 - 6).cast("double"))


def near_copies(t: Inputs):
    """Every vector five times: itself, a copy, and three that are moved."""
    each = F.posexplode(F.array(*[F.lit(x) for x in SHIFTS])).alias("c", "e")
    rows = t.vectors.select(F.col("vec_id").alias("own"), "embedding", each)
    return rows.select((F.col("own") * len(SHIFTS) + F.col("c")).alias("vec_id"), shifted(F.col("e"), "own").alias("embedding"))


@query(f"SELECT id_a, id_b, round(cosine, 6) AS cosine FROM ({pairs_sql('o_near')}) p")
def embedding_pairs(t: Inputs):
    return rounded(si.embedding_pairs(near_copies(t), 0.9), "cosine")


@query(f"""SELECT p.id_a, p.id_b, round(p.cosine, 6) AS cosine, a.fold_id AS fold_a, b.fold_id AS fold_b FROM ({pairs_sql('o_imaged')}) p
    JOIN o_seq a ON a.image_id = p.id_a JOIN o_seq b ON b.image_id = p.id_b WHERE a.fold_id <> b.fold_id""")
def embedding_leakage(t: Inputs):
    """Near duplicates over folds by embedding: each image carries a vector, moved by the number of its group."""
    from boxloom.plans.q_manifest import folded
    from boxloom.operators.manifest import near_leakage as leaked

    images = checkpointed(folded(t))
    group = F.floor(F.col("image_id") / 211) % len(SHIFTS)
    rows = images.select("image_id", (F.col("image_id") % 211).alias("vec_id"), F.element_at(F.array(*[F.lit(x) for x in SHIFTS]), (group + 1).cast("int")).alias("e"))
    rows = rows.join(t.vectors.select("vec_id", "embedding"), "vec_id").select("image_id", shifted(F.col("e"), "vec_id").alias("embedding"))
    return rounded(leaked(si.embedding_pairs(rows, 0.9, ident="image_id"), images), "cosine")
