"""Manifest building and checking: keyframes, context, sequences, folds, audits.

Image columns: dataset_id, image_id, frame_id, camera_id, camera_order, capture_us,
is_keyframe, width, height; later sequence_id and fold_id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from boxloom.constants import CAMERAS, SEQUENCE_GAP_US, TAXONOMY
from boxloom.operators.scale import carry, exact_quantile, join_small, running_sum
from boxloom.session import checkpointed

HOUR_US = 3_600_000_000
FRAME_BUCKET = 10_000
#: Expanding folds: frame groups of a lot, rows of a task, and folds that may be broadcast (where their text allows).
FOLD_LOT, FOLD_ROWS, FOLDS_SENT = 64, 20_000_000, 300_000


# --- matching files, stems and frames -------------------------------------------------

def match_keyframes(stems: DataFrame, images: DataFrame) -> DataFrame:
    """Images whose stem is a label stem, in every camera."""
    return images.join(stems.select("stem").distinct(), ["stem"])


def missing_images(stems: DataFrame, cameras: DataFrame, images: DataFrame) -> DataFrame:
    """Expected (stem, camera) pairs without an image.

    Every stem meets every camera by definition; the camera table rides along as one array, so that no join is needed.
    """
    listed = cameras.agg(F.collect_set("camera_id").alias("_ids"))
    wanted = stems.select("stem").distinct().withColumn("camera_id", F.explode(listed.scalar()))
    return wanted.join(images.select("stem", "camera_id"), ["stem", "camera_id"], "left_anti")


def extra_images(stems: DataFrame, images: DataFrame) -> DataFrame:
    return images.join(stems.select("stem"), ["stem"], "left_anti")


def match_context(images: DataFrame, keys: tuple[str, ...] = ("dataset_id", "camera_id"), width: int = HOUR_US) -> DataFrame:
    """Nearest keyframe by time for every context frame of a camera, ties to the earlier one.

    The context frame keeps its own image; only the keyframe's id and the delta are added. Images of one time stand in
    the order of their ids: a keyframe with a smaller id is past, one with a larger id is next.
    """
    here = F.when(F.col("is_keyframe"), F.struct("image_id", "capture_us"))
    rows = carry(images, list(keys), "capture_us", {"_past": here}, later={"_next": here}, width=width, ties=("image_id",))
    context = rows.filter(~F.col("is_keyframe"))
    past = F.col("capture_us") - F.col("_past.capture_us")
    ahead = F.col("_next.capture_us") - F.col("capture_us")
    use_past = F.col("_past").isNotNull() & (F.col("_next").isNull() | (past <= ahead))
    return context.select(
        *images.columns,
        F.when(use_past, F.col("_past.image_id")).otherwise(F.col("_next.image_id")).alias("keyframe_image_id"),
        (F.when(use_past, past).otherwise(ahead) / F.lit(1000.0)).alias("sync_delta_ms"),
    )


# --- sequences ------------------------------------------------------------------------

def assign_sequences(images: DataFrame, gap_us: int = SEQUENCE_GAP_US, width: int = HOUR_US) -> DataFrame:
    """Number the stretches of a dataset without a gap above `gap_us`; ids s00, s01, ...

    Works on distinct capture times, cut into time buckets, so one long dataset is spread out.
    """
    times = checkpointed(images.select("dataset_id", "capture_us").distinct())
    times = checkpointed(carry(times, ["dataset_id"], "capture_us", {"_prev": F.col("capture_us")}, width=width))
    starts = F.coalesce((F.col("capture_us") - F.col("_prev") > gap_us).cast("long"), F.lit(0).cast("long"))
    times = running_sum(times, ["dataset_id"], "capture_us", {"sequence_no": starts}, width=width)
    times = times.select("dataset_id", "capture_us", "sequence_no")
    rows = images.join(times, ["dataset_id", "capture_us"])
    return rows.withColumn("sequence_id", F.format_string("s%02d", F.col("sequence_no")))


def keyframe_sequences(images: DataFrame, gap_us: int = SEQUENCE_GAP_US) -> DataFrame:
    """Sequences of the keyframe stream with their first and last capture time."""
    keyed = assign_sequences(images.filter("is_keyframe"), gap_us)
    return keyed.groupBy("dataset_id", "sequence_id").agg(
        F.min("capture_us").alias("first_us"), F.max("capture_us").alias("last_us"),
    )


def inherit_sequence(images: DataFrame, sequences: DataFrame, gap_us: int = SEQUENCE_GAP_US) -> DataFrame:
    """Give every raw frame the sequence of the keyframes in its own stretch.

    The raw stream is cut at the same gap; `cut_ok` is false for a stretch without keyframes
    or with keyframes of several sequences.
    """
    starts = sequences.select(
        "dataset_id", F.col("sequence_id").alias("_sequence"),
        F.explode(F.array("first_us", "last_us")).alias("capture_us"),
    )
    raw = assign_sequences(images.drop("sequence_id", "sequence_no"), gap_us).drop("sequence_id")
    seen = raw.select("dataset_id", "capture_us", "sequence_no").distinct().join(starts, ["dataset_id", "capture_us"])
    named = seen.groupBy("dataset_id", "sequence_no").agg(
        F.min("_sequence").alias("sequence_id"), F.count_distinct("_sequence").alias("_names"),
    )
    rows = raw.join(named, ["dataset_id", "sequence_no"], "left")
    return rows.withColumn("cut_ok", F.coalesce(F.col("_names") == 1, F.lit(False))).drop("_names", "sequence_no")


def raw_index(images: DataFrame, keys: tuple[str, ...] = ("dataset_id", "camera_id"), width: int = HOUR_US) -> DataFrame:
    """0-based position of an image in its camera's stream."""
    one = F.lit(1).cast("long")
    rows = running_sum(images, list(keys), "capture_us", {"_n": one}, width=width, ties=("image_id",))
    return rows.withColumn("raw_sequence_index", F.col("_n") - 1).drop("_n")


def cadence(images: DataFrame, keys: tuple[str, ...] = ("dataset_id", "camera_id"), width: int = HOUR_US) -> DataFrame:
    """Index and time deltas between keyframes of a camera: counts, extremes and medians."""
    indexed = checkpointed(raw_index(images, keys, width).filter("is_keyframe"))
    steps = carry(
        indexed, list(keys), "capture_us",
        {"_prev_index": F.col("raw_sequence_index"), "_prev_us": F.col("capture_us")},
        width=width, ties=("image_id",),
    )
    steps = steps.withColumns({
        "index_delta": F.col("raw_sequence_index") - F.col("_prev_index"),
        "time_delta_us": F.col("capture_us") - F.col("_prev_us"),
    })
    spans = steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("keyframes"),
        F.min("index_delta").alias("min_index_delta"),
        F.max("index_delta").alias("max_index_delta"),
    )
    return spans.join(exact_quantile(steps, list(keys), "time_delta_us", 0.5, "median_time_delta_us"), list(keys), "left")


def continuity_segments(
    images: DataFrame,
    cuts: DataFrame | None = None,
    *,
    keys: tuple[str, ...] = ("dataset_id", "camera_id"),
    gap_us: int = SEQUENCE_GAP_US,
    width: int = HOUR_US,
) -> DataFrame:
    """Segments within which tracking may run, per camera, with the reason each one began.

    A segment ends on a sequence change, a gap, a missing frame, or a scene cut (`cuts`: image_id).
    """
    rows = images
    if cuts is not None:
        rows = rows.join(cuts.select("image_id").distinct().withColumn("_cut", F.lit(True)), ["image_id"], "left")
    else:
        rows = rows.withColumn("_cut", F.lit(None).cast("boolean"))
    held = F.struct("sequence_id", "capture_us", "frame_id")
    rows = checkpointed(carry(rows, list(keys), "capture_us", {"_prev": held}, width=width, ties=("image_id",)))
    reason = (
        F.when(F.col("_prev").isNull(), "start")
        .when(F.col("_prev.sequence_id") != F.col("sequence_id"), "sequence")
        .when(F.col("capture_us") - F.col("_prev.capture_us") > gap_us, "gap")
        .when(F.col("frame_id") - F.col("_prev.frame_id") > 1, "missing_context")
        .when(F.col("_cut"), "scene_cut")
    )
    rows = rows.withColumn("reset_reason", reason)
    fresh = F.col("reset_reason").isNotNull().cast("long")
    rows = running_sum(rows, list(keys), "capture_us", {"_seen": fresh}, width=width, ties=("image_id",))
    return rows.withColumn("segment_id", F.col("_seen") - 1).drop("_prev", "_cut", "_seen")


def scene_cuts(features: DataFrame, threshold: float, *, keys: tuple[str, ...] = ("dataset_id", "camera_id"),
               width: int = FRAME_BUCKET) -> DataFrame:
    """Successive frames of a camera whose feature vectors differ by more than `threshold` (L1 mean)."""
    rows = carry(features, list(keys), "frame_id", {"_prev": F.col("features")}, width=width)
    gaps = F.zip_with("features", "_prev", lambda a, b: F.abs(a.cast("double") - b.cast("double")))
    score = F.try_divide(F.aggregate(gaps, F.lit(0.0), lambda t, v: t + v), F.size("features"))
    rows = rows.withColumn("change_score", F.when(F.col("_prev").isNotNull(), score)).drop("_prev")
    return rows.withColumn("scene_cut", F.coalesce(F.col("change_score") > threshold, F.lit(False)))


# --- roles, folds, sets ---------------------------------------------------------------

def assign_role(images: DataFrame) -> DataFrame:
    return images.withColumn("role", F.when(F.col("is_keyframe"), "keyframe").otherwise("temporal_context"))


def supervised(images: DataFrame) -> DataFrame:
    """Only keyframes may be truth, negatives or test examples."""
    return images.filter(F.col("is_keyframe"))


def partition_roles(images: DataFrame) -> DataFrame:
    """One row: both role sets are disjoint and cover all images."""
    roles = assign_role(images).groupBy("image_id").agg(
        F.count_if(F.col("role") == "keyframe").alias("_k"), F.count_if(F.col("role") == "temporal_context").alias("_c"),
    )
    return roles.agg(
        F.count_if(F.col("_k") > 0).alias("keyframes"),
        F.count_if(F.col("_c") > 0).alias("context"),
        F.count_if((F.col("_k") > 0) & (F.col("_c") > 0)).alias("in_both"),
        F.count(F.lit(1)).alias("images"),
    )


def build_folds(images: DataFrame) -> DataFrame:
    """Leave-one-sequence-out: fold k validates on sequence k.

    Only the validation fold is stored per image (`fold_id`); the training side of any fold is every other sequence of
    the same data set: a fold is named by dataset_id and fold_id. `expand_folds` writes both sides out for given folds.
    """
    return images.withColumn("fold_id", F.regexp_extract("sequence_id", r"(\d+)$", 1).cast("int"))


def expand_folds(images: DataFrame, folds: DataFrame, group: str = "frame_id") -> DataFrame:
    """(fold, side) rows per frame group, all cameras of a frame on one side.

    Rows grow with the number of folds by definition, so this works on frame groups only. Groups are dealt in lots, and a lot
    comes whole under one fold after the other: whatever the number of folds, files hold runs of a fold and short repeats of a
    lot, which dictionaries and compression make small. Groups and lots are shuffled, never the rows; tasks are cut by those.
    """
    columns = [group, "sequence_id", "fold_id"]
    groups = checkpointed(images.select("dataset_id", *columns).distinct())
    named = checkpointed(folds.select("dataset_id", F.col("fold_id").alias("fold")).distinct())
    sizes = groups.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("_n"))
    counts = sizes.join(named.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("_folds")), "dataset_id")
    rows = counts.agg(F.sum(F.col("_n") * F.col("_folds"))).first()[0] or 0
    tasks = max(images.sparkSession.sparkContext.defaultParallelism, -(-rows // FOLD_ROWS))
    lot = F.pmod(F.xxhash64(*columns), F.ceil(F.col("_n") / FOLD_LOT))
    dealt = join_small(groups, sizes, ["dataset_id"]).withColumn("_lot", lot).drop("_n")
    keys = ["dataset_id", "_lot"]
    lots = join_small(dealt.select(*keys).distinct().repartition(tasks, *keys), named, ["dataset_id"], max_rows=FOLDS_SENT)
    sides = lots.join(dealt.repartition(tasks, *keys).hint("shuffle_hash"), keys)
    side = F.when(F.col("fold_id") == F.col("fold"), "validation").otherwise("train")
    return sides.select("dataset_id", group, "sequence_id", "fold", side.alias("side"))


def same_folds(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Rows found in one fold assignment only; empty when two models used the same folds."""
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).withColumn("only_in", F.lit("first")).unionByName(
        b.exceptAll(a).withColumn("only_in", F.lit("second"))
    )


def split_violations(images: DataFrame) -> DataFrame:
    """Frame groups whose images lie in more than one fold."""
    groups = images.groupBy("dataset_id", "frame_id").agg(
        F.count_distinct("fold_id").alias("folds"), F.count(F.lit(1)).alias("images"),
    )
    return groups.filter(F.col("folds") > 1)


def union_proposals(**by_source: DataFrame) -> DataFrame:
    """Proposals of several producers in one table, kept apart by `source`."""
    parts = [df.withColumn("source", F.lit(name)) for name, df in by_source.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def release_diff(old: DataFrame, new: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Added, removed and changed ids between two releases."""
    a = old.select(key, F.struct(*values).alias("_old"))
    b = new.select(key, F.struct(*values).alias("_new"))
    rows = a.join(b, key, "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    return rows.select(key, change.alias("change")).filter(F.col("change").isNotNull())


def sequence_number() -> Column:
    """The number in a sequence id: s99 comes before s100."""
    return F.regexp_extract("sequence_id", r"(\d+)$", 1).try_cast("bigint")


def canonical_order(images: DataFrame) -> DataFrame:
    return images.orderBy(sequence_number(), "sequence_id", "frame_id", "camera_order", "image_id")


# --- reconciliation and audits --------------------------------------------------------

def reconcile(manifest: DataFrame, export: DataFrame) -> DataFrame:
    """Manifest against exported tasks by image id: ok, missing, duplicate, extra."""
    a = manifest.groupBy("image_id").agg(F.count(F.lit(1)).alias("in_manifest"))
    b = export.groupBy("image_id").agg(F.count(F.lit(1)).alias("in_export"))
    rows = a.join(b, "image_id", "full_outer").fillna(0, ["in_manifest", "in_export"])
    status = (
        F.when(F.col("in_manifest") == 0, "extra")
        .when(F.col("in_export") == 0, "missing")
        .when((F.col("in_export") > 1) | (F.col("in_manifest") > 1), "duplicate")
        .otherwise("ok")
    )
    return rows.withColumn("status", status)


def non_empty(images: DataFrame, annotations: DataFrame) -> DataFrame:
    return images.join(annotations.select("image_id"), ["image_id"], "left_semi")


def empty(images: DataFrame, annotations: DataFrame) -> DataFrame:
    return images.join(annotations.select("image_id"), ["image_id"], "left_anti")


def camera_coverage(images: DataFrame, cameras: list[str]) -> DataFrame:
    """Expected and actual cameras of every frame, with the missing ids."""
    want = F.array(*[F.lit(name) for name in cameras])
    rows = images.groupBy("dataset_id", "frame_id").agg(
        F.count(F.lit(1)).alias("images"), F.collect_set("camera_id").alias("_have"),
    )
    return rows.select(
        "dataset_id", "frame_id", "images",
        F.size(want).alias("expected"),
        F.size(F.array_intersect("_have", want)).alias("actual"),
        F.array_join(F.array_sort(F.array_except(want, F.col("_have"))), ",").alias("missing"),
    )


def population_audit(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Tasks, unique keys, duplicates, empty and boxes per camera and in total (camera null)."""
    boxes = annotations.groupBy("image_id").agg(F.count(F.lit(1)).alias("boxes"))
    unique = images.groupBy("camera_id", "dataset_id", "frame_id", "image_id").agg(F.count(F.lit(1)).alias("copies"))
    rows = unique.join(boxes, "image_id", "left").fillna(0, ["boxes"])
    return rows.rollup("camera_id").agg(
        F.sum("copies").alias("tasks"),
        F.count(F.lit(1)).alias("unique_keys"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
        F.count_if(F.col("boxes") == 0).alias("empty"),
        F.count_if(F.col("boxes") > 0).alias("non_empty"),
        F.sum("boxes").alias("boxes"),
    )


def class_audit(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Box counts by camera and class with both subtotals."""
    rows = annotations.groupBy("image_id", "class_id").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(images.select("image_id", "camera_id").distinct(), "image_id")
    return rows.rollup("camera_id", "class_id").agg(F.sum("n").alias("boxes"))


def approx_audit(images: DataFrame, log: DataFrame, rsd: float = 0.02, accuracy: int = 10_000) -> DataFrame:
    """Sketch variant for very large audits; the exact operators stay the default."""
    left = images.agg(
        F.approx_count_distinct("image_id", rsd).alias("approx_images"),
        F.approx_count_distinct(F.struct("dataset_id", "frame_id"), rsd).alias("approx_frames"),
    )
    return left.withColumn("approx_median_seconds", log.agg(F.percentile_approx("seconds", 0.5, accuracy)).scalar())


def duplicates(images: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Values that occur more than once, for each named key."""
    parts = []
    for name, columns in keys.items():
        value = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
        counts = images.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(counts.filter(F.col("rows") > 1).select(F.lit(name).alias("key"), "value", "rows"))
    return reduce(DataFrame.unionByName, parts)


def ordering_report(images: DataFrame) -> DataFrame:
    """Per dataset: groups whose cameras are not in canonical order, steps back in time, cadence."""
    groups = images.groupBy("dataset_id", "frame_id").agg(
        F.min("capture_us").alias("first_us"),
        F.max("capture_us").alias("last_us"),
        F.count_distinct("camera_order").alias("orders"),
        F.count_distinct("camera_id").alias("cameras"),
    )
    steps = carry(checkpointed(groups), ["dataset_id"], "frame_id", {"_prev_us": F.col("last_us")}, width=FRAME_BUCKET)
    steps = steps.withColumn("step_us", F.col("first_us") - F.col("_prev_us"))
    report = steps.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if(F.col("first_us") != F.col("last_us")).alias("unsynchronised_frames"),
        F.count_if(F.col("orders") != F.col("cameras")).alias("camera_order_conflicts"),
        F.count_if(F.col("first_us") <= F.col("_prev_us")).alias("time_not_rising"),
    )
    return report.join(exact_quantile(steps, ["dataset_id"], "step_us", 0.5, "median_step_us"), "dataset_id", "left")


def sequence_summary(images: DataFrame) -> DataFrame:
    """First and last index, image count and time span of every sequence."""
    return images.groupBy("dataset_id", "sequence_id").agg(
        F.min("frame_id").alias("first_frame"),
        F.max("frame_id").alias("last_frame"),
        F.count(F.lit(1)).alias("images"),
        F.count_if("is_keyframe").alias("keyframe_images"),
        F.min("capture_us").alias("first_us"),
        F.max("capture_us").alias("last_us"),
    )


def fold_support(annotations: DataFrame, images: DataFrame, classes: list[int] | None = None) -> DataFrame:
    """Boxes of each class on both sides of every fold; a side without any is `not_evaluable`.

    Classes are those of the taxonomy (or `classes`) and all others that boxes have. Folds and training counts are per
    data set: the class total of the data set less the validation count, so no rows are copied.
    """
    fold = ["dataset_id", "fold_id"]
    counts = annotations.groupBy("image_id", "class_id").agg(F.count(F.lit(1)).alias("n"))
    per = counts.join(images.select("image_id", *fold).distinct(), "image_id")
    per = checkpointed(per.groupBy(*fold, "class_id").agg(F.sum("n").alias("validation")))  # a row per fold and class
    total = per.groupBy("dataset_id", "class_id").agg(F.sum("validation").alias("_all"))
    known = F.array(*[F.lit(c) for c in (taxonomy_classes() if classes is None else classes)])
    seen = per.agg(F.array_sort(F.array_union(known, F.array_compact(F.collect_set("class_id")))).alias("_c"))
    grid = images.select(*fold).distinct().withColumn("class_id", F.explode(seen.scalar()))
    rows = grid.join(per, [*fold, "class_id"], "left").join(total, ["dataset_id", "class_id"], "left")
    rows = rows.fillna(0, ["validation", "_all"])
    rows = rows.withColumn("train", F.col("_all") - F.col("validation")).drop("_all")
    thin = (F.col("train") == 0) | (F.col("validation") == 0)
    return rows.withColumn("status", F.when(thin, "not_evaluable").otherwise("evaluable"))


def leakage_report(objects: DataFrame, images: DataFrame, key: str) -> DataFrame:
    """Persistent objects (or duplicate hashes) seen in more than one fold."""
    rows = objects.select("image_id", key).join(images.select("image_id", "dataset_id", "fold_id"), "image_id")
    rows = rows.groupBy(key, "dataset_id", "fold_id").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("folds"), F.sum("n").alias("rows"),
        F.min("fold_id").alias("first_fold"), F.max("fold_id").alias("last_fold"),
    )
    return rows.filter(F.col("folds") > 1)


def near_leakage(pairs: DataFrame, images: DataFrame) -> DataFrame:
    """Near-duplicate pairs (id_a, id_b, distance) whose images lie in different folds."""
    folds = images.select("image_id", "dataset_id", "fold_id").distinct()
    a = folds.select(F.col("image_id").alias("id_a"), F.struct("dataset_id", "fold_id").alias("_a"))
    b = folds.select(F.col("image_id").alias("id_b"), F.struct("dataset_id", "fold_id").alias("_b"))
    rows = pairs.join(a, "id_a").join(b, "id_b").filter("_a <> _b")
    return rows.select(*pairs.columns, F.col("_a.fold_id").alias("fold_a"), F.col("_b.fold_id").alias("fold_b"))


def taxonomy_classes() -> list[int]:
    return [cid for cid, _, active in TAXONOMY if active]


def validate_release(images: DataFrame, annotations: DataFrame, cameras: list[str], classes: list[int] | None = None) -> DataFrame:
    """Every exception found, as (check, detail); an empty result passes the gate.

    Sizes are those of the camera table; a keyframe without a size, or of a camera that the table does not have (or
    without a camera), is reported. Classes are those of the taxonomy, or `classes`. Where the manifest holds
    `relative_path` or `sha256`, each must be an image's own.
    """
    known = taxonomy_classes() if classes is None else classes
    keyframes = images.filter("is_keyframe")
    unique = {"duplicate_image_id": ["image_id"], "duplicate_frame_camera": ["dataset_id", "frame_id", "camera_id"]}
    checks = duplicates(images, unique)
    for name, column in (("duplicate_path", "relative_path"), ("duplicate_content", "sha256")):
        if column in images.columns:
            checks = checks.unionByName(duplicates(images.filter(F.col(column).isNotNull()), {name: [column]}))
    parts = [checks.select(F.col("key").alias("check"), F.col("value").alias("detail"))]
    gaps = camera_coverage(keyframes, cameras).filter("actual < expected")
    parts.append(gaps.select(F.lit("missing_camera").alias("check"), F.concat_ws("|", F.col("frame_id").cast("string"), "missing").alias("detail")))
    right = [F.when(F.col("camera_id") == name, (F.col("width") == w) & (F.col("height") == h)) for _, name, w, h, _ in CAMERAS]
    size = keyframes.filter(~F.coalesce(*right, F.lit(False)))
    parts.append(size.select(F.lit("image_size").alias("check"), F.col("image_id").cast("string").alias("detail")))
    unknown = annotations.filter(F.col("class_id").isNull() | ~F.col("class_id").isin(known))
    parts.append(unknown.select(F.lit("unknown_class").alias("check"), F.col("annotation_id").cast("string").alias("detail")))
    orphan = annotations.join(images.select("image_id"), "image_id", "left_anti")
    parts.append(orphan.select(F.lit("unknown_image").alias("check"), F.col("annotation_id").cast("string").alias("detail")))
    return reduce(DataFrame.unionByName, parts)


def release_gate(exceptions: DataFrame) -> DataFrame:
    """Counts per check; raises when any exception exists."""
    counts = exceptions.groupBy("check").agg(F.count(F.lit(1)).alias("n")).orderBy("check")
    found = {r["check"]: r["n"] for r in counts.collect()}  # a row per kind of check
    if found:
        raise ValueError(f"release validation failed: {found}")
    return counts


def balance(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """Boxes and shares by class and camera with all subtotals."""
    counts = annotations.groupBy("image_id", "class_id").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.join(images.select("image_id", "camera_id").distinct(), "image_id")
    cells = counts.groupBy("class_id", "camera_id").agg(F.sum("n").alias("n"))
    rows = cells.cube("class_id", "camera_id").agg(F.sum("n").alias("boxes"))
    return rows.withColumn("share", F.col("boxes") / cells.agg(F.sum("n")).scalar())
