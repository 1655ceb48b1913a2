"""Writers. Nothing is overwritten: a run either adds what is new or fails on an existing path."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from boxloom.constants import TAXONOMY
from boxloom.functions.scalars import canonical_json
from boxloom.operators.boxes import prediction_results
from boxloom.operators.manifest import sequence_number
from boxloom.operators.release import content_hash
from boxloom.schemas import MANIFEST
from boxloom.session import freeing

#: Partitions of a target up to which a filter names them.
PRUNED = 200
ORDER = ["dataset_id", "sequence_id", "frame_id", "camera_order", "image_id"]


def canonical_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """JSON text of each row with fixed columns, in canonical order over all parts."""
    named = [c for c in ORDER if c in columns]
    # sequences by their number: s99 before s100
    order = [x for c in named for x in ([sequence_number(), F.col(c)] if c == "sequence_id" else [F.col(c)])]
    rows = df.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select(canonical_json(*columns).alias("value"))


def write_manifest(df: DataFrame, path: str) -> str:
    """Sorted JSON Lines with the manifest's columns. Returns the content hash, which does not
    depend on file names or on how many parts there are.
    """
    columns = [f.name for f in MANIFEST.fields if f.name in df.columns]
    canonical_lines(df, columns).write.mode("errorifexists").text(path)
    return content_hash(df.select(*columns)).first()[0]


def write_lines(df: DataFrame, path: str, columns: list[str]) -> None:
    canonical_lines(df, columns).write.mode("errorifexists").text(path)


def review_tasks(predictions: DataFrame) -> DataFrame:
    """One import task per image with its prediction, model version and ids."""
    rows = prediction_results(predictions)
    return rows.select(
        F.struct("image_id").alias("data"),
        F.array(F.struct(F.col("model_version"), F.col("result"))).alias("predictions"),
    )


def write_review_tasks(predictions: DataFrame, path: str, compression: str = "none") -> None:
    with freeing(predictions.sparkSession):
        review_tasks(predictions).write.mode("errorifexists").option("ignoreNullFields", "false").option("compression", compression).json(path)


def coco_documents(images: DataFrame, annotations: DataFrame, *, frames_per_shard: int = 1_000, boxes_per_shard: int = 50_000) -> DataFrame:
    """COCO documents, one row per shard of a sequence: key columns and `value`.

    A shard is a block of frames; where a block holds more than `boxes_per_shard` boxes, its images are spread by id
    over several shards. Every image is in one document, with all its boxes.
    """
    block = F.floor(F.col("frame_id") / frames_per_shard).alias("block")
    homes = images.select("image_id", "sequence_id", block, "relative_path", "width", "height")
    boxes = annotations.join(homes.select("image_id", "sequence_id", "block"), "image_id")
    sizes = annotations.groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).join(homes, "image_id", "right")
    sizes = sizes.groupBy("sequence_id", "block").agg(
        F.greatest(F.ceil(F.coalesce(F.sum("n"), F.lit(0)) / boxes_per_shard), F.lit(1)).alias("parts"),
    )
    keys = ["sequence_id", "block", "part"]
    entry = F.struct(
        F.col("image_id").cast("string").alias("id"), F.col("relative_path").alias("file_name"), "width", "height",
    )
    heads = homes.join(sizes, ["sequence_id", "block"])
    part = F.pmod(F.xxhash64("image_id"), F.col("parts"))
    heads = heads.withColumn("part", part)
    heads = heads.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("images"))
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    box = F.struct(
        F.col("annotation_id").cast("string").alias("id"), F.col("image_id").cast("string").alias("image_id"),
        F.col("class_id").alias("category_id"),
        F.array(*[v.cast("double") for v in (F.col("x1"), F.col("y1"), w, h)]).alias("bbox"),
        (w * h).cast("double").alias("area"), F.lit(0).alias("iscrowd"),
    )
    bodies = boxes.join(sizes, ["sequence_id", "block"])
    bodies = bodies.withColumn("part", part)
    bodies = bodies.groupBy(*keys).agg(F.array_sort(F.collect_list(box)).alias("annotations"))
    rows = heads.join(bodies, keys, "left")
    none = F.array().cast(bodies.schema["annotations"].dataType)
    names = F.array(*[F.struct(F.lit(cid).alias("id"), F.lit(name).alias("name")) for cid, name, active in TAXONOMY if active])
    value = canonical_json("images", F.coalesce("annotations", none).alias("annotations"), names.alias("categories"))
    return rows.select(*keys, value.alias("value"))


def write_coco(images: DataFrame, annotations: DataFrame, path: str, compression: str = "none", **sizes: int) -> None:
    """One document per line, in folders by sequence."""
    docs = coco_documents(images, annotations, **sizes)
    # a sequence's documents lie together, so its folder gets one file or a few, and a long sequence is still cut
    docs = docs.repartitionByRange("sequence_id", "block", "part").select("sequence_id", "value")
    with freeing(docs.sparkSession):
        docs.write.mode("errorifexists").partitionBy("sequence_id").option("compression", compression).text(path)


def existing(df: DataFrame, path: str) -> DataFrame | None:
    try:
        return df.sparkSession.read.schema(df.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def new_rows(df: DataFrame, target: DataFrame | None, keys: list[str]) -> DataFrame:
    rows = df.dropDuplicates(keys)
    return rows if target is None else rows.join(target.select(*keys), keys, "left_anti")


def append_once(df: DataFrame, path: str, keys: list[str], by: tuple[str, ...] = ()) -> None:
    """Append rows whose key the target does not hold; running it twice adds nothing.

    `by` names keys of few values (a release, a model version): the target is partitioned by them, and only the
    partitions that the rows can fall in are compared.
    """
    target = existing(df, path)
    if by and target is not None:
        here = df.select(*by).distinct().limit(PRUNED + 1).collect()
        if len(here) <= PRUNED:  # else the whole target is compared
            hit = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c])) for c in by]) for r in here]
            target = target.filter(reduce(Column.__or__, hit, F.lit(False)))
    out = new_rows(df, target, keys).write.mode("append")
    (out.partitionBy(*by) if by else out).parquet(path)


def pending(inputs: DataFrame, outputs: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs without an output yet: the resume set of an interrupted run."""
    return inputs.join(outputs.select(*keys), keys, "left_anti")


def write_new(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def write_record(record: DataFrame, path: str) -> None:
    record.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


