"""Readers. Every JSON source has a given schema; nested forms are flattened to box rows here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from boxloom import schemas
from boxloom.constants import CAMERAS, TAXONOMY
from boxloom.functions import geometry as g
from boxloom.functions.scalars import image_identity, path_camera, path_stem, stem_timestamp
from boxloom.operators.boxes import from_xywh
from boxloom.session import literal

SEGMENTS = 1_024


def scan_images(spark: SparkSession, root: str, pattern: str = "*.{jpg,jpeg,png}", dataset_id: str | None = None) -> DataFrame:
    """One row per image file: path, camera, stem, capture time, size in bytes, hash, width, height.

    Hash and size are taken in the scan; the bytes never reach a shuffle.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    rows = image_dims(files.select(
        "path", "length", path_camera("path").alias("camera_id"), path_stem("path").alias("stem"),
        F.sha2("content", 256).alias("sha256"), "content",
    )).drop("content")
    rows = rows.withColumn("capture_timestamp", stem_timestamp("stem"))
    if dataset_id is not None:
        identity = image_identity("dataset_id", F.unix_micros("capture_timestamp"), "camera_id")
        rows = rows.withColumn("dataset_id", F.lit(dataset_id)).withColumn("image_id", identity)
    return rows


def _number(data: Column, at: Column, size: int) -> Column:
    return F.conv(F.hex(F.substring(data, at, F.lit(size))), 16, 10).cast("int")


def image_dims(df: DataFrame) -> DataFrame:
    """Width and height from the PNG or JPEG header in `content`; null when there is none.

    JPEG markers are walked from segment to segment up to the frame header, wherever it lies.
    """
    data = F.col("content")
    png = F.hex(F.substring(data, F.lit(1), F.lit(8))) == "89504E470D0A1A0A"
    jpeg = F.hex(F.substring(data, F.lit(1), F.lit(2))) == "FFD8"
    start = F.struct(F.lit(3).alias("at"), F.lit(None).cast("int").alias("frame"), F.lit(False).alias("done"))

    def step(state: Column, _: Column) -> Column:
        at = state["at"]
        lead = F.hex(F.substring(data, at, F.lit(1)))
        mark = _number(data, at + 1, 1)
        is_frame = mark.between(0xC0, 0xCF) & ~mark.isin(0xC4, 0xC8, 0xCC)
        stop = F.coalesce(lead != "FF", F.lit(True)) | mark.isNull() | mark.isin(0xDA, 0xD9)
        size = F.when(mark == 0xFF, 1).when(mark.between(0xD0, 0xD7) | (mark == 0x01), 2).otherwise(2 + _number(data, at + 2, 2))
        moved = F.struct(
            F.when(stop | is_frame, at).otherwise(at + size).alias("at"),
            F.when(~stop & is_frame, at).alias("frame"),
            (stop | is_frame).alias("done"),
        )
        return F.when(state["done"], state).otherwise(moved)

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(SEGMENTS)), start, step)
    # nearly every header ends within SEGMENTS markers; the rest is walked as far as the bytes go
    rest = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(data), F.lit(1))), F.col("_walk"), step)
    rows = df.withColumn("_walk", F.when(jpeg, walked))
    rows = rows.withColumn("_frame", F.when(F.col("_walk.done"), F.col("_walk.frame")).when(jpeg, rest["frame"])).drop("_walk")
    return rows.withColumns({
        "width": F.when(png, _number(data, F.lit(17), 4)).otherwise(_number(data, F.col("_frame") + 7, 2)),
        "height": F.when(png, _number(data, F.lit(21), 4)).otherwise(_number(data, F.col("_frame") + 5, 2)),
    }).drop("_frame")


def scan_label_stems(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Stems of the label files. Only `path` is selected, so no file content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return files.select(path_stem("path").alias("stem")).distinct()


def _json(spark: SparkSession, path, schema: T.StructType, array_file: bool) -> DataFrame:
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(with_bad).option("multiLine", str(array_file).lower()).option("mode", "PERMISSIVE").json(path)


def read_review_export(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Reviewed tasks as box rows; a task without boxes keeps one row with a null result.

    JSON Lines is split over tasks; an array file has to be read by one task, so large exports
    should be many files or lines. Unreadable records stay, with their text.
    """
    tasks = _json(spark, path, schemas.REVIEW_TASK, array_file)
    rows = tasks.select(
        F.col("id").alias("task_id"), F.col("data.image_id").alias("image_id"), "_corrupt_record",
        F.explode_outer("annotations").alias("a"),
    )
    rows = rows.select(
        "task_id", "image_id", "_corrupt_record", F.col("a.id").alias("review_id"), F.col("a.was_cancelled").alias("was_cancelled"),
        F.col("a.completed_by").alias("annotator_id"), F.col("a.lead_time").alias("seconds"),
        F.col("a.created_at").alias("created_at"), F.explode_outer("a.result").alias("r"),
    )
    value = F.col("r.value")
    box = g.from_percent_box(value, F.col("r.original_width"), F.col("r.original_height"))
    return rows.select(
        "task_id", "image_id", "review_id", "was_cancelled", "annotator_id", "seconds", "created_at",
        F.col("r.id").alias("result_id"), F.col("r.original_width").alias("width"), F.col("r.original_height").alias("height"),
        F.get(value["rectanglelabels"], F.lit(0)).alias("label"), *[box[n].alias(n) for n in g.CORNERS],
        F.col("r.score").alias("score"), "_corrupt_record",
    )


def read_predictions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schemas.PREDICTIONS).format(fmt).load(path)


def flatten_predictions(predictions: DataFrame) -> DataFrame:
    """One row per box, with its position; images without boxes are not lost (box columns null)."""
    head = [c for c in predictions.columns if c != "boxes"]
    rows = predictions.select(*head, F.posexplode_outer("boxes").alias("box_no", "b"))
    return rows.select(*head, "box_no", "b.*")


def nest_predictions(boxes: DataFrame) -> DataFrame:
    """Flat boxes back to one row per image, boxes in `box_no` order."""
    head = ["image_id", "width", "height", "model_version"]
    names = [f.name for f in schemas.BOX.fields]
    body = F.struct("box_no", F.struct(*names).alias("b"))
    grouped = boxes.groupBy(*head).agg(F.array_sort(F.collect_list(F.when(F.col("box_no").isNotNull(), body))).alias("_b"))
    return grouped.select(*head, F.transform("_b", lambda x: x["b"]).alias("boxes"))


def read_coco(spark: SparkSession, path: str) -> DataFrame:
    """COCO detection documents (one per file) as flat pixel boxes with class and file name."""
    docs = spark.read.schema(schemas.COCO).option("multiLine", "true").json(path)
    images = docs.select(F.explode("images").alias("i")).select(
        F.col("i.id").alias("image_id"), F.col("i.file_name").alias("relative_path"), F.col("i.width").alias("width"), F.col("i.height").alias("height"),
    ).distinct()
    names = docs.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("class_id"), F.col("c.name").alias("label")).distinct()
    boxes = docs.select(F.explode("annotations").alias("a")).select(
        F.col("a.id").alias("annotation_id"), F.col("a.image_id").alias("image_id"), F.col("a.category_id").alias("class_id"),
        *[F.get("a.bbox", F.lit(i)).alias(n) for i, n in enumerate("xywh")],
    )
    return from_xywh(boxes).join(images, "image_id", "left").join(names, "class_id", "left")


def read_review_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REVIEW_LOG).json(path)


# --- policy tables --------------------------------------------------------------------

def taxonomy(spark: SparkSession) -> DataFrame:
    return literal(spark, TAXONOMY, "class_id int, name string, active boolean")


def cameras(spark: SparkSession) -> DataFrame:
    rows = [(order, name, w, h, rot) for order, name, w, h, rot in CAMERAS]
    return literal(spark, rows, "camera_order int, camera_id string, width int, height int, rotation int")


POLICY_SCHEMAS = {
    "classes": "class_id int, name string, active boolean",
    "cameras": "camera_order int, camera_id string, width int, height int, rotation int, calibration_version string, "
               "ignore_polygons array<array<struct<x:double,y:double>>>, road_polygons array<array<struct<x:double,y:double>>>",
    "thresholds": "camera_id string, class_id int, review double, accept double, track_low double, track_high double",
}


def load_policy(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Policy tables from one small YAML file with lists `classes`, `cameras`, `thresholds`.

    `classes` may also be plain names: active ids follow the fixed taxonomy, other names are inactive.
    """
    import yaml

    whole = spark.read.text(path, wholetext=True).first()  # one small file, wherever Spark can read it
    content = yaml.safe_load(whole[0] if whole else "") or {}
    known = {name: (cid, active) for cid, name, active in TAXONOMY}
    out = {}
    for table, ddl in POLICY_SCHEMAS.items():
        schema = T.StructType.fromDDL(ddl)
        rows = []
        for item in content.get(table, []):
            if isinstance(item, str):
                cid, active = known.get(item, (None, False))
                item = {"class_id": cid, "name": item, "active": active}
            rows.append(tuple(_fit(item.get(f.name), f.dataType) for f in schema.fields))
        out[table] = literal(spark, rows, schema)
    return out


def _fit(value, kind: T.DataType):
    """YAML numbers as the declared type; points may be written as [x, y]."""
    if value is None:
        return None
    if isinstance(kind, T.DoubleType):
        return float(value)
    if isinstance(kind, T.ArrayType):
        return [_fit(v, kind.elementType) for v in value]
    if isinstance(kind, T.StructType):
        parts = value if isinstance(value, (list, tuple)) else [value[f.name] for f in kind.fields]
        return tuple(_fit(v, f.dataType) for v, f in zip(parts, kind.fields))
    return value
