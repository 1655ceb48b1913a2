"""Review round trip: box differences, states, corrections, time, gold set, policy bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from boxloom.functions import geometry as g
from boxloom.operators.scale import exact_quantile, part_running_sum, range_parts


# --- states ---------------------------------------------------------------------------

def event_state(event: Column) -> Column:
    """Canonical state of a review event. A skip has none: it is neither empty nor verified."""
    return (
        F.when(event == "displayed", "unreviewed_prediction")
        .when(event == "submit_unchanged", "human_verified")
        .when(event == "submit_modified", "human_modified")
        .when(event == "submit_created", "human_created")
        .when(event == "submit_deleted", "rejected_prediction")
        .when(event == "submit_empty", "verified_empty")
    )


def review_diff(pred: DataFrame, submitted: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Predictions against submitted boxes by result id: unchanged, resized, relabelled, deleted, created.

    A submitted box without a result id is new. A box both moved and relabelled counts as relabelled.
    """
    box = F.struct("class_id", *g.CORNERS)
    a = pred.select("image_id", "result_id", box.alias("before"))
    b = submitted.select("image_id", "result_id", box.alias("after"))
    # rows without an id can match nothing; keeping them out of the join also avoids a null hot key
    rows = a.join(b.filter(F.col("result_id").isNotNull()), ["image_id", "result_id"], "full_outer")
    new = b.filter(F.col("result_id").isNull()).select("image_id", "result_id", F.lit(None).cast(a.schema["before"].dataType).alias("before"), "after")
    rows = rows.unionByName(new)
    moved = F.greatest(*[F.abs(F.col(f"before.{n}") - F.col(f"after.{n}")) for n in g.CORNERS]) > tolerance
    action = (
        F.when(F.col("before").isNull(), "created")
        .when(F.col("after").isNull(), "deleted")
        .when(F.col("before.class_id") != F.col("after.class_id"), "relabelled")
        .when(moved, "resized")
        .otherwise("unchanged")
    )
    return rows.withColumn("action", action)


def map_review_state(diff: DataFrame, tasks: DataFrame) -> DataFrame:
    """Box states. `tasks`: image_id, outcome (submitted, displayed or skipped).

    Only a submit says anything about a box; otherwise predictions stay unreviewed.
    """
    rows = diff.join(tasks.select("image_id", "outcome"), "image_id", "left")
    submitted = F.coalesce(F.col("outcome") == "submitted", F.lit(False))
    state = (
        F.when(~submitted, "unreviewed_prediction")
        .when(F.col("action") == "unchanged", "human_verified")
        .when(F.col("action").isin("resized", "relabelled"), "human_modified")
        .when(F.col("action") == "created", "human_created")
        .when(F.col("action") == "deleted", "rejected_prediction")
    )
    return rows.withColumn("review_status", state)


def image_status(tasks: DataFrame, submitted: DataFrame) -> DataFrame:
    """Image-level status: a submit without boxes is `verified_empty`; a skip stays unreviewed."""
    boxes = submitted.groupBy("image_id").agg(F.count(F.lit(1)).alias("boxes"))
    rows = tasks.join(boxes, "image_id", "left").fillna(0, ["boxes"])
    done = F.col("outcome") == "submitted"
    status = F.when(done & (F.col("boxes") == 0), "verified_empty").when(done, "reviewed").otherwise("unreviewed")
    return rows.withColumn("annotation_status", status)


def absence_status(images: DataFrame, pred: DataFrame) -> DataFrame:
    """No predicted box never means an empty image: such images are unreviewed."""
    boxes = pred.groupBy("image_id").agg(F.count(F.lit(1)).alias("boxes"))
    rows = images.join(boxes, "image_id", "left").fillna(0, ["boxes"])
    status = F.when(F.col("boxes") == 0, "unreviewed").otherwise("unreviewed_prediction")
    return rows.withColumn("annotation_status", status)


def latest_state(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last event of each key; an aggregation, so a hot key is combined before the shuffle."""
    rest = [c for c in events.columns if c not in keys]
    last = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*keys, "_last.*")


def without_warmup(log: DataFrame, warmup: int, keys: list[str], order: list[str]) -> DataFrame:
    """Drop the first `warmup` tasks of each key. Only those few rows pass the window."""
    first = W.partitionBy(*keys).orderBy(*order)
    early = log.select(*dict.fromkeys([*keys, *order])).withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= warmup)
    return log.join(early.drop("_n"), list(dict.fromkeys([*keys, *order])), "left_anti")


# --- corrections, time, agreement -----------------------------------------------------

ACTIONS = ["unchanged", "resized", "relabelled", "deleted", "created"]


def correction_counts(diff: DataFrame, keys: list[str]) -> DataFrame:
    return diff.groupBy(*keys).agg(*[F.count_if(F.col("action") == a).alias(a) for a in ACTIONS])


def median_seconds(log: DataFrame, keys: list[str]) -> DataFrame:
    """Exact median seconds per key with the number of tasks."""
    n = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("tasks"))
    return n.join(exact_quantile(log, keys, "seconds", 0.5, "median_seconds"), keys)


def review_time(log: DataFrame, warmup: int = 5, target: float = 0.60) -> DataFrame:
    """Median seconds by annotator and arm and over all (annotator null), warm-up excluded."""
    used = without_warmup(log, warmup, ["annotator_id"], ["ts", "event_id"])
    per = median_seconds(used, ["annotator_id", "assisted"])
    every = median_seconds(used, ["assisted"]).withColumn("annotator_id", F.lit(None).cast(per.schema["annotator_id"].dataType))
    rows = per.unionByName(every)
    wide = rows.groupBy("annotator_id").agg(
        *[F.max(F.when(F.col("assisted") == flag, F.col(c))).alias(f"{arm}_{c}")
          for flag, arm in ((False, "manual"), (True, "assisted")) for c in ("tasks", "median_seconds")],
    )
    reduction = 1.0 - F.try_divide(F.col("assisted_median_seconds"), F.col("manual_median_seconds"))
    return wide.withColumn("reduction", reduction).withColumn("meets_target", F.col("reduction") >= target)


def human_time_result(
    times: DataFrame, recall: DataFrame, *, target: float = 0.60, tolerance: float = 0.01, min_tasks: int = 200, min_annotators: int = 2
) -> DataFrame:
    """One verdict from `review_time` and the recall of both arms (columns assisted, tp, fn).

    Passes if the overall median falls by `target` and assisted recall drops by `tolerance` at most, on at least
    `min_annotators` annotators with `min_tasks` tasks in both arms each; with fewer it is `insufficient_evidence`.
    """
    full = F.least(F.coalesce("manual_tasks", F.lit(0)), F.coalesce("assisted_tasks", F.lit(0))) >= min_tasks
    people = times.agg(
        F.count_if(F.col("annotator_id").isNotNull() & full).alias("annotators"),
        F.max(F.when(F.col("annotator_id").isNull(), F.col("reduction"))).alias("reduction"),
    )

    def of(flag: bool) -> Column:
        rate = F.try_divide(F.sum(F.when(F.col("assisted") == flag, F.col("tp"))).cast("double"), F.sum(F.when(F.col("assisted") == flag, F.col("tp") + F.col("fn"))))
        return rate

    rates = recall.agg(of(False).alias("manual_recall"), of(True).alias("assisted_recall"))
    rows = people.withColumns({c: rates.select(c).scalar() for c in rates.columns})
    drop = F.col("manual_recall") - F.col("assisted_recall")
    verdict = (
        F.when(F.col("annotators") < min_annotators, "insufficient_evidence")
        .when((F.col("reduction") >= target) & (drop <= tolerance), "pass").otherwise("fail")
    )
    return rows.withColumn("verdict", verdict)


def agreement(double: DataFrame, target: float = 0.98) -> DataFrame:
    """Share of box decisions both reviewers agree on, with each kind of disagreement."""
    kinds = ["agree", "class", "location", "a_only", "b_only"]
    rows = double.agg(
        F.count(F.lit(1)).alias("decisions"), *[F.count_if(F.col("kind") == k).alias(k) for k in kinds]
    )
    rate = F.try_divide(F.col("agree").cast("double"), F.col("decisions"))
    return rows.withColumn("agreement", rate).withColumn("meets_target", F.col("agreement") >= target)


def run_throughput(log: DataFrame, keys: list[str]) -> DataFrame:
    """Images per second and failure rate of a run. `log`: keys, ts (timestamp), failed."""
    rows = log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("images"),
        F.count_if("failed").alias("failures"),
        (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))).alias("span_us"),
    )
    return rows.withColumns({
        "images_per_second": F.try_divide(F.col("images") * 1_000_000.0, F.col("span_us")),
        "failure_rate": F.try_divide(F.col("failures").cast("double"), F.col("images")),
    })


# --- sampling -------------------------------------------------------------------------

def hash_order(seed: str, *ids: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(seed), *[F.col(i).cast("string") for i in ids]), 256)


def gold_sample(
    images: DataFrame, strata: dict[str, Column], seed: str, *, groups: int, per_stratum: int, empty_per_camera: int
) -> DataFrame:
    """Frozen review sample: whole frame groups, oversampled strata, verified-empty per camera.

    Exact and repeatable (hash order). `images` needs `verified_empty`. Reasons are kept.
    """
    rows = images.withColumn("_h", hash_order(seed, "dataset_id", "frame_id", "camera_id"))
    frames = images.select("dataset_id", "frame_id").distinct().withColumn("_g", hash_order(seed, "dataset_id", "frame_id"))
    chosen = frames.orderBy("_g", "dataset_id", "frame_id").limit(groups).select("dataset_id", "frame_id")
    parts = [rows.join(chosen, ["dataset_id", "frame_id"], "left_semi").select("image_id", F.lit("representative").alias("reason"))]
    named = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in strata.items()]))
    best = W.partitionBy("reason").orderBy("_h", "image_id")
    tagged = rows.select("image_id", "_h", F.explode(named).alias("reason"))
    parts.append(tagged.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= per_stratum).select("image_id", "reason"))
    per_camera = W.partitionBy("camera_id").orderBy("_h", "image_id")
    empty = rows.filter("verified_empty").withColumn("_n", F.row_number().over(per_camera))
    parts.append(empty.filter(F.col("_n") <= empty_per_camera).select("image_id", F.lit("verified_empty").alias("reason")))
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # at most one row per reason and image, so the array is bounded by the number of strata
    return union.groupBy("image_id").agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("sampling_reason"))


def crossover(tasks: DataFrame, seed: str) -> DataFrame:
    """Half of each annotator's tasks manual first, half assisted first, in hash order.

    `tasks`: annotator_id, image_id. With an odd number the extra task is manual first.
    """
    rows = tasks.withColumn("_h", hash_order(seed, "annotator_id", "image_id"))
    order = [F.col("_h").asc(), F.col("image_id").asc()]
    ranked = part_running_sum(range_parts(rows, ["annotator_id"], order), ["annotator_id"], order, {"_n": F.lit(1).cast("long")})
    total = tasks.groupBy("annotator_id").agg(F.count(F.lit(1)).alias("_all"))
    ranked = ranked.join(total, "annotator_id")
    arm = F.when(2 * F.col("_n") <= F.col("_all") + 1, "manual_first").otherwise("assisted_first")
    return ranked.select("annotator_id", "image_id", arm.alias("arm"))


# --- policy ---------------------------------------------------------------------------

def policy_band(df: DataFrame, *, low: float = 0.3, high: float = 0.98, min_hits: int = 3) -> DataFrame:
    """Three policy bands. Expects calibrated, track_hits, teacher_evidence, ignored,
    disagreement, truncated, rare. Every band still needs a human submit.
    """
    stable = F.coalesce(F.col("track_hits"), F.lit(0)) >= min_hits
    evidence = F.coalesce(F.col("teacher_evidence"), F.lit(False)) | stable
    weak = F.coalesce(F.col("calibrated") < low, F.lit(True))
    doubt = F.lit(False)
    for name in ("ignored", "disagreement", "truncated", "rare"):
        doubt = doubt | F.coalesce(F.col(name), F.lit(True))
    band = (
        F.when(weak & evidence, "manual_search")
        .when((F.col("calibrated") >= high) & stable & ~doubt, "auto_accept_candidate")
        .otherwise("review")
    )
    return enforce_review_only(df.withColumn("band", band))


def enforce_review_only(df: DataFrame) -> DataFrame:
    """Bands are audit labels: no box is accepted without a person."""
    return df.withColumn("requires_human", F.lit(True))


def mark_propagated(df: DataFrame) -> DataFrame:
    """Propagated boxes are tracker output and stay unreviewed predictions."""
    return df.withColumns({"source": F.lit("tracker"), "review_status": F.lit("unreviewed_prediction")})


def with_provenance(df: DataFrame, **meta: str) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in meta.items()})
