"""Detection metrics: outcomes, slices, support, AP, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from boxloom.constants import HEAVY_EQUIPMENT, IOU_LEVELS, TAXONOMY, Z95
from boxloom.functions import geometry as g
from boxloom.functions.scalars import class_name, wilson_lower
from boxloom.operators.boxes import band_column
from boxloom.session import checkpointed, literal, stored
from boxloom.operators.scale import exact_quantile, join_small, part_running_sum, range_parts

KEYS = ["image_id", "class_id"]
#: True counts of a stretch of the precision envelope.
ENVELOPE_WIDTH = 50_000
OUTCOME_DIMS = ["size_bucket", "score_band", "occluded", "truncated"]


def detection_outcomes(pred: DataFrame, truth: DataFrame, matches: DataFrame, edges=(0.25, 0.5, 0.75)) -> DataFrame:
    """One row per TP, FP and FN. Size and flags come from the truth box when there is one."""
    p = pred.select(*KEYS, "det_id", "score", g.area(g.corners()).alias("_p_area"))
    p = p.join(matches.select(*KEYS, "det_id", "annotation_id", "iou"), [*KEYS, "det_id"], "left")
    t = truth.select(*KEYS, "annotation_id", g.area(g.corners()).alias("_t_area"), "occluded", "truncated")
    rows = p.join(t, [*KEYS, "annotation_id"], "full_outer")
    outcome = F.when(F.col("det_id").isNull(), "FN").when(F.col("annotation_id").isNull(), "FP").otherwise("TP")
    rows = rows.withColumns({
        "outcome": outcome,
        "size_bucket": g.size_bucket(F.coalesce("_t_area", "_p_area")),
        "score_band": F.coalesce(band_column(F.col("score"), list(edges)), F.lit("none")),
    })
    return rows.drop("_p_area", "_t_area")


def _rates() -> dict[str, Column]:
    tp, fp, fn = F.count_if(F.col("outcome") == "TP"), F.count_if(F.col("outcome") == "FP"), F.count_if(F.col("outcome") == "FN")
    return {
        "tp": tp,
        "fp": fp,
        "fn": fn,
        "n_truth": tp + fn,
        "precision": F.try_divide(tp.cast("double"), tp + fp),
        "recall": F.try_divide(tp.cast("double"), tp + fn),
    }


def detection_counts(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    return outcomes.groupBy(*keys).agg(*[v.alias(k) for k, v in _rates().items()])


def slice_metrics(outcomes: DataFrame, dims: list[list[str]]) -> DataFrame:
    """One pass over the outcomes for many slices; `slice` names the columns that are fixed."""
    names = list(dict.fromkeys(n for group in dims for n in group))
    rows = outcomes.groupingSets([[F.col(n) for n in group] for group in dims], *[F.col(n) for n in names]).agg(
        F.grouping_id().alias("_gid"), *[v.alias(k) for k, v in _rates().items()]
    )
    label = F.lit(None).cast("string")
    for group in dims:
        gid = sum(0 if n in group else 1 << (len(names) - 1 - i) for i, n in enumerate(names))
        label = F.when(F.col("_gid") == gid, F.lit("*".join(group) if group else "all")).otherwise(label)
    return rows.withColumn("slice", label).drop("_gid")


def label_support(metrics: DataFrame, min_n: int = 50, count: str = "n_truth") -> DataFrame:
    """Thin slices are named, never merged into another number."""
    thin = F.coalesce(F.col(count), F.lit(0)) < min_n
    return metrics.withColumn("support", F.when(thin, "insufficient_evidence").otherwise("supported"))


def localization_error(pred: DataFrame, truth: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """1 - IoU and largest edge error of matched boxes."""
    p = pred.select("image_id", "det_id", F.struct(*g.CORNERS).alias("p"))
    t = truth.select("image_id", "annotation_id", F.struct(*g.CORNERS).alias("t"))
    rows = matches.join(p, ["image_id", "det_id"]).join(t, ["image_id", "annotation_id"])
    edge = F.greatest(*[F.abs(F.col(f"p.{n}") - F.col(f"t.{n}")) for n in g.CORNERS])
    # read twice below
    rows = stored(rows.select(*keys, (1.0 - F.col("iou")).alias("loss"), edge.alias("edge_error")))
    means = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("matched"),
        F.avg("loss").alias("mean_iou_loss"),
        F.avg("edge_error").alias("mean_edge_error"),
        F.max("edge_error").alias("max_edge_error"),
    )
    return means.join(exact_quantile(rows, keys, "edge_error", 0.5, "median_edge_error"), keys)


def ignored_counts(marked: DataFrame, keys: list[str]) -> DataFrame:
    return marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("boxes"), F.count_if("ignored").alias("ignored"),
    )


def cumulative_tp_fp(matches: DataFrame, key: str = "class_id", levels: list[float] = IOU_LEVELS, hits_only: bool = False) -> DataFrame:
    """Running TP and FP by falling score (ties by det_id) per key and IoU level.

    `matches` is the result of `match_coco`. The order does not depend on the level, so one row per
    prediction is sorted and all levels are summed side by side; rows become levels afterwards. A
    class may hold most rows: the order is cut by range and the parts are linked by their totals.
    `hits_only` keeps the rows of true positives, the only ones where precision can peak.
    """
    order = [F.col("score").desc(), F.col("det_id").asc()]
    parts = range_parts(matches.select(key, "det_id", "score", "tp"), [key], order)
    hit = {f"_tp{i}": F.get("tp", F.lit(i)).cast("int").cast("long") for i in range(len(levels))}
    rows = part_running_sum(parts, [key], order, {"_n": F.lit(1).cast("long"), **hit})
    each = F.array(*[
        F.struct(F.lit(level).alias("level"), F.get("tp", F.lit(i)).alias("tp"), F.col(f"_tp{i}").alias("cum_tp"))
        for i, level in enumerate(levels)
    ])
    if hits_only:
        each = F.filter(each, lambda x: x["tp"])
    rows = rows.select(key, "det_id", "score", "_n", F.explode(each).alias("l"))
    return rows.select(key, "l.level", "det_id", "score", "l.tp", "l.cum_tp", (F.col("_n") - F.col("l.cum_tp")).alias("cum_fp"))


def pr_curve(matches: DataFrame, truth_counts: DataFrame, key: str = "class_id", hits_only: bool = False) -> DataFrame:
    """Precision and recall after every prediction; `truth_counts`: key, n_truth."""
    # most rows may be of one key, so they are never dealt by it
    rows = join_small(cumulative_tp_fp(matches, key, hits_only=hits_only), truth_counts, key)
    tp, fp = F.col("cum_tp").cast("double"), F.col("cum_fp")
    return rows.withColumns({
        "precision": F.try_divide(tp, F.col("cum_tp") + fp),
        "recall": F.try_divide(tp, F.col("n_truth")),
    })


def precision_envelope(curve: DataFrame, keys: list[str]) -> DataFrame:
    """Largest precision at or beyond each recall of the curve, one row per distinct true count.

    Only the best precision per true count matters, so the window runs over that reduction, cut into stretches of
    ENVELOPE_WIDTH counts: rows move once, and a task never holds more than a stretch of the reduction.
    """
    curve = curve.withColumn("_part", F.floor(F.col("cum_tp") / F.lit(ENVELOPE_WIDTH)))
    later = W.partitionBy(*keys).orderBy("_part").rowsBetween(1, W.unboundedFollowing)
    beyond = curve.groupBy(*keys, "_part").agg(F.max("precision").alias("_m"))
    beyond = beyond.select(*keys, "_part", F.max("_m").over(later).alias("_beyond"))
    # dealt by stretch at once, which serves the reduction and the window after it
    points = curve.repartition(*keys, "_part").groupBy(*keys, "_part", "cum_tp").agg(F.max("precision").alias("precision"), F.max("recall").alias("recall"))
    # falling order keeps the running maximum incremental
    inner = W.partitionBy(*keys, "_part").orderBy(F.col("cum_tp").desc()).rowsBetween(W.unboundedPreceding, 0)
    rows = join_small(points.withColumn("_near", F.max("precision").over(inner)), beyond, [*keys, "_part"])
    return rows.select(*keys, "cum_tp", "recall", "precision", F.greatest("_near", F.coalesce("_beyond", "_near")).alias("envelope"))


def average_precision(matches: DataFrame, truth_counts: DataFrame, key: str = "class_id") -> DataFrame:
    """101-point AP per key and level. A key without truth, or without any hit, is absent.

    Each point lifts all recall steps up to floor(100 * recall); the best precision per step
    is a plain aggregation and the rest works on at most 101 numbers per key.
    """
    keys = [key, "level"]
    curve = pr_curve(matches, truth_counts, key, hits_only=True)
    best = curve.withColumn("_step", F.expr("least(100 * cum_tp div n_truth, 100)"))
    best = best.groupBy(*keys, "_step").agg(F.max("precision").alias("_p"))
    steps = best.groupBy(*keys).agg(F.collect_list(F.struct("_step", "_p")).alias("_steps"))

    def at(r: Column) -> Column:
        reach = F.transform(F.filter("_steps", lambda s: s["_step"] >= r), lambda s: s["_p"])
        return F.coalesce(F.array_max(reach), F.lit(0.0))

    total = F.aggregate(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(100).cast("long")), at), F.lit(0.0), lambda t, v: t + v)
    return steps.select(*keys, (total / 101.0).alias("ap"))


def coco_summary(matches: DataFrame, truth_counts: DataFrame) -> DataFrame:
    """AP50 and AP50:95 per class; a class without truth is null, one without predictions 0."""
    matches = checkpointed(matches)
    ap = average_precision(matches, truth_counts)
    n_levels = len(IOU_LEVELS)
    per_class = ap.groupBy("class_id").agg(
        F.max(F.when(F.abs(F.col("level") - 0.5) < 1e-9, F.col("ap"))).alias("_ap50"),
        (F.sum("ap") / n_levels).alias("_ap"),
    )
    ids = matches.select("class_id").union(truth_counts.select("class_id")).distinct()
    rows = ids.join(truth_counts, "class_id", "left").join(per_class, "class_id", "left")
    has = F.coalesce(F.col("n_truth"), F.lit(0)) > 0
    return rows.select(
        "class_id",
        F.coalesce("n_truth", F.lit(0)).alias("n_truth"),
        F.when(has, F.coalesce("_ap50", F.lit(0.0))).alias("ap50"),
        F.when(has, F.coalesce("_ap", F.lit(0.0))).alias("ap50_95"),
    )


def default_recall_rules(spark) -> DataFrame:
    """Recall targets: 0.95 for Car and Truck, 0.90 for heavy equipment and Sign."""
    rows = [
        (cid, 0.90 if name in HEAVY_EQUIPMENT or name == "Sign" else 0.95)
        for cid, name, active in TAXONOMY if active
    ]
    return literal(spark, rows, "class_id int, min_recall double")


def development_gate(counts: DataFrame, rules: DataFrame, fold: str = "fold_id", min_n: int = 50, overall: float = 0.95) -> DataFrame:
    """Recall per fold and class, and per fold over all classes (class_id null), against targets.

    Every fold reports every class that has a rule or was seen in any fold; a class without a rule is held to `overall`,
    one without any count is `insufficient_evidence`. Folds are told apart by dataset_id too where `counts` has it.
    """
    folds = [c for c in ("dataset_id", fold) if c in counts.columns]
    # read four times below, and a report of few rows against the boxes it was counted from
    counts = checkpointed(counts.select(*folds, "class_id", "tp", "fn"))
    classes = rules.select("class_id").union(counts.select("class_id")).distinct()
    classes = classes.join(rules, "class_id", "left").select("class_id", F.coalesce("min_recall", F.lit(overall)).alias("min_recall"))
    # folds x classes: both are distinct values of a report of few rows
    listed = classes.agg(F.collect_list(F.struct("class_id", "min_recall")).alias("_c"))
    grid = counts.select(*folds).distinct().withColumn("_c", F.explode(listed.scalar())).select(*folds, "_c.*")
    per_class = grid.join(counts.select(*folds, "class_id", "tp", "fn"), [*folds, "class_id"], "left").fillna(0, ["tp", "fn"])
    total = counts.groupBy(*folds).agg(F.sum("tp").alias("tp"), F.sum("fn").alias("fn"))
    total = total.withColumns({"class_id": F.lit(None).cast("int"), "min_recall": F.lit(overall)})
    rows = per_class.unionByName(total)
    rows = rows.withColumns({
        "n_truth": F.col("tp") + F.col("fn"),
        "recall": F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")),
    })
    verdict = (
        F.when(F.col("n_truth") < min_n, "insufficient_evidence")
        .when(F.col("recall") >= F.col("min_recall"), "pass")
        .otherwise("fail")
    )
    return rows.withColumn("verdict", verdict)


def regression_gate(old: DataFrame, new: DataFrame, keys: list[str], tolerance: float = 0.01, min_n: int = 50) -> DataFrame:
    """Recall of a new run against the old one; a supported drop above `tolerance` fails."""
    a = old.select(*keys, F.col("recall").alias("old_recall"), F.col("n_truth"))
    b = new.select(*keys, F.col("recall").alias("new_recall"))
    rows = a.join(b, keys, "left").withColumn("drop", F.col("old_recall") - F.coalesce("new_recall", F.lit(0.0)))
    verdict = (
        F.when(F.col("n_truth") < min_n, "insufficient_evidence")
        .when(F.col("drop") > tolerance + 1e-12, "fail")
        .otherwise("pass")
    )
    return rows.withColumn("verdict", verdict)


def acceptance_gate(
    slices: DataFrame, flags: DataFrame, keys: list[str], *,
    min_n: int = 200, min_precision: float = 0.98, z: float = Z95,
) -> DataFrame:
    """Which slices are eligible for automatic acceptance. Eligibility changes no band.

    `slices`: keys, tp, fp, recall, min_recall. `flags`: keys, open_flags, approved.
    """
    rows = slices.join(flags, keys, "left")
    n = F.col("tp") + F.col("fp")
    rows = rows.withColumns({
        "n": n,
        "precision": F.try_divide(F.col("tp").cast("double"), n),
        "wilson_lower": wilson_lower(F.col("tp"), n, z),
    })
    checks = {
        "enough": F.col("n") >= min_n,
        "precise": F.col("precision") >= min_precision,
        "bounded": F.col("wilson_lower") >= min_precision,
        "recall_ok": F.col("recall") >= F.col("min_recall"),
        "no_open_flags": F.coalesce(F.col("open_flags"), F.lit(0)) == 0,
        "approved": F.col("approved"),
    }
    rows = rows.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in checks.items()})
    eligible = F.lit(True)
    for name in checks:
        eligible = eligible & F.col(name)
    return rows.withColumn("eligible", eligible)


def per_thousand(counts: DataFrame, images: Column) -> DataFrame:
    """Missed and false boxes per 1,000 images."""
    return counts.withColumns({
        "missed_per_1000": F.try_divide(F.col("fn") * 1000.0, images),
        "false_per_1000": F.try_divide(F.col("fp") * 1000.0, images),
    })


def scorecard(metrics: DataFrame, key: str, models: list[str], values: list[str]) -> DataFrame:
    """One row per key, one column per model and metric."""
    return metrics.groupBy(key).pivot("model", models).agg(*[F.first(v, ignorenulls=True).alias(v) for v in values])


def slice_metric(
    df: DataFrame, keys: list[str], partials: dict, final: Column, *, ident: str, salts: int = 64, name: str = "metric"
) -> DataFrame:
    """User metric per slice from additive parts.

    `partials`: name -> (function of pandas Series to float, input columns). Each part runs on a
    salted share of the slice, so no slice has to fit one task; shares are summed and `final`
    combines the sums.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(ident), F.lit(salts)))
    parts = salted.groupBy(*keys, "_salt").agg(*[
        F.pandas_udf(fn, "double")(*[F.col(x) for x in inputs]).alias(part) for part, (fn, inputs) in partials.items()
    ])
    return parts.groupBy(*keys).agg(*[F.sum(part).alias(part) for part in partials]).select(*keys, final.alias(name))


def named_classes(df: DataFrame) -> DataFrame:
    return df.withColumn("class", class_name("class_id"))
