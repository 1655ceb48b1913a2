"""Validation operators. Bad rows are kept with reasons; nothing is dropped silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxloom.constants import REVIEW_STATES, SOURCES
from boxloom.functions import geometry as g
from boxloom.operators.scale import join_small


def _reasons(checks: dict[str, Column]) -> Column:
    """Names of the checks that did not hold; a null outcome counts as failed."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()
    ]))


def box_checks(box: list[Column], score: Column) -> dict[str, Column]:
    x1, y1, x2, y2 = box
    return {
        "x1_range": g.finite(x1) & (x1 >= 0),
        "y1_range": g.finite(y1) & (y1 >= 0),
        "x2_range": g.finite(x2) & (x2 > 0),
        "y2_range": g.finite(y2) & (y2 > 0),
        "score_range": g.finite(score) & (score >= 0) & (score <= 1),
        "corner_order": (x2 > x1) & (y2 > y1),
    }


def validate_boxes(df: DataFrame, require_label: bool = False) -> DataFrame:
    """Add `reasons` and `ok` to flat boxes; `ok` and its opposite split good from bad."""
    checks = box_checks(g.corners(), F.col("score"))
    if require_label:
        checks["label_missing"] = F.col("label").isNotNull()
    return df.withColumn("reasons", _reasons(checks)).withColumn("ok", F.size("reasons") == 0)


def validate_predictions(df: DataFrame) -> DataFrame:
    """Nested predictions: size and ids, then every box; missing `boxes` becomes an empty list."""
    boxes = F.coalesce(F.col("boxes"), F.array().cast(df.schema["boxes"].dataType))
    row = _reasons({
        "image_id_missing": F.col("image_id").isNotNull(),
        "model_version_missing": F.col("model_version").isNotNull(),
        "width_range": F.col("width") > 0,
        "height_range": F.col("height") > 0,
    })

    def one_box(b: Column, i: Column) -> Column:
        checks = box_checks([b[n] for n in g.CORNERS], b["score"])
        checks["label_missing"] = b["label"].isNotNull()
        return F.transform(_reasons(checks), lambda r: F.concat(F.lit("box "), i.cast("string"), F.lit(": "), r))

    out = df.withColumn("boxes", boxes)
    out = out.withColumn("reasons", F.concat(row, F.flatten(F.transform("boxes", one_box))))
    return out.withColumn("ok", F.size("reasons") == 0)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter("ok").drop("ok", "reasons"), df.filter("NOT ok").drop("ok")


def map_classes(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Label text to class id, exact spelling and case; `class_status` names what is wrong."""
    known = taxonomy.select(F.col("name").alias("label"), "class_id", "active")
    out = join_small(df, known, ["label"], "left")
    status = F.when(F.col("active").isNull(), "unknown").when(~F.col("active"), "inactive").otherwise("active")
    return out.withColumn("class_status", status).drop("active")


def active_only(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    live = taxonomy.filter("active").select("class_id")
    return join_small(df, live, ["class_id"], "left_semi")


def inactive_boxes(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Boxes that break the active-class rule; each is an error."""
    live = taxonomy.filter("active").select("class_id")
    return join_small(df, live, ["class_id"], "left_anti")


def check_camera_policy(images: DataFrame, cameras: DataFrame) -> DataFrame:
    """Size, rotation and canonical order of every image against its camera's policy."""
    policy = cameras.select(
        "camera_id",
        F.col("camera_order").alias("want_order"),
        F.col("width").alias("want_width"),
        F.col("height").alias("want_height"),
        F.col("rotation").alias("want_rotation"),
    )
    rotation = F.col("rotation") if "rotation" in images.columns else F.lit(0)
    out = join_small(images, policy, ["camera_id"], "left")
    out = out.withColumn("reasons", _reasons({
        "unknown_camera": F.col("want_order").isNotNull(),
        "camera_order": F.col("camera_order") == F.col("want_order"),
        "image_size": (F.col("width") == F.col("want_width")) & (F.col("height") == F.col("want_height")),
        "rotation": rotation == F.col("want_rotation"),
    }))
    return out.drop("want_order", "want_width", "want_height", "want_rotation").withColumn("ok", F.size("reasons") == 0)


def check_enums(df: DataFrame) -> DataFrame:
    out = df.withColumn("reasons", _reasons({
        "source": F.col("source").isin(SOURCES),
        "review_status": F.col("review_status").isin(REVIEW_STATES),
    }))
    return out.withColumn("ok", F.size("reasons") == 0)


def require_ok(df: DataFrame) -> DataFrame:
    """Fail the job on the first row that did not pass, naming its reasons."""
    message = F.concat(F.lit("validation failed: "), F.array_join("reasons", ","))
    passed = F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.withColumn("ok", passed)
