"""Results of every kind in a review export, known or not, kept as they were written.

A result's own text is held exactly as it stood in its line, and beside it as a variant, which any path of any kind of
result can be read from without a schema of all kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxloom.functions import geometry as g

#: Kinds of results that this library gives a meaning to; all others are kept and counted.
KNOWN = ("rectanglelabels", "polygonlabels", "keypointlabels", "choices")

LINE = "_corrupt_record string, id string, data string, annotations array<struct<id: string, was_cancelled: string, completed_by: string, lead_time: string, created_at: string, result: array<string>>>"


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per result of a JSON Lines export: task_no orders the lines, and the texts of tasks and annotations stay.

    `raw` is the result's text byte for byte (the file is read by the JSON source, which copies nested text exactly),
    `result` the same as a variant. Tasks without annotations and annotations without results keep one row with a null
    result; a line that is no JSON keeps its text in `line` and nothing else. `type` is null for a result without one,
    and `known` tells whether KNOWN names it. A result that is a bare string has its content as `raw` and no variant,
    unless that content is JSON itself, which then stands for it.
    """
    lines = spark.read.schema(LINE).json(path)
    tasks = lines.select(F.monotonically_increasing_id().alias("task_no"), F.struct("id", "data", "annotations").alias("t"), F.col("_corrupt_record").alias("line"))
    rows = tasks.select(
        "task_no", F.col("t.id").alias("task_id"), F.col("t.data").alias("data"), "line",
        F.posexplode_outer("t.annotations").alias("review_no", "a"),
    )
    rows = rows.select(
        "task_no", "task_id", "data", "line", "review_no", F.col("a.id").alias("review_id"), F.struct("a.was_cancelled", "a.completed_by", "a.lead_time", "a.created_at").alias("review"),
        F.posexplode_outer("a.result").alias("result_no", "raw"),
    )
    rows = rows.withColumn("result", F.try_parse_json("raw"))
    return rows.withColumns({
        "image_id": F.try_variant_get(F.try_parse_json("data"), "$.image_id", "string"),
        "result_id": F.try_variant_get("result", "$.id", "string"), "type": F.try_variant_get("result", "$.type", "string"),
    }).withColumn("known", F.when(F.col("raw").isNotNull(), F.coalesce(F.col("type").isin(*KNOWN), F.lit(False))))


def result_types(results: DataFrame) -> DataFrame:
    """Kinds of results with their number, images and the schema that covers all their values."""
    rows = results.filter("raw IS NOT NULL")
    return rows.groupBy("type", "known").agg(
        F.count(F.lit(1)).alias("results"), F.count_distinct("image_id").alias("images"),
        F.count_if(F.col("result").isNull()).alias("unreadable"), F.schema_of_variant_agg("result").alias("schema"),
    )


def result_boxes(results: DataFrame) -> DataFrame:
    """Pixel boxes of the rectangles; a rectangle whose numbers cannot be read has null corners."""
    at = lambda path, kind: F.try_variant_get("result", path, kind)
    rows = results.filter("type = 'rectanglelabels'")
    value = F.struct(*[at(f"$.value.{n}", "double").alias(n) for n in ("x", "y", "width", "height")])
    rows = rows.withColumns({"_value": value, "width": at("$.original_width", "int"), "height": at("$.original_height", "int")})
    box = g.from_percent_box(F.col("_value"), F.col("width"), F.col("height"))
    return rows.select(
        "image_id", "result_id", at("$.value.rectanglelabels[0]", "string").alias("label"), *[box[n].alias(n) for n in g.CORNERS],
        at("$.score", "double").alias("score"), "width", "height",
    )


def result_polygons(results: DataFrame) -> DataFrame:
    """Pixel polygons: label and corner points in order."""
    at = lambda path, kind: F.try_variant_get("result", path, kind)
    points = F.transform(at("$.value.points", "array<array<double>>"), lambda p: F.struct(
        (p[0] * at("$.original_width", "double") / 100).alias("x"), (p[1] * at("$.original_height", "double") / 100).alias("y")))
    return results.filter("type = 'polygonlabels'").select("image_id", "result_id", at("$.value.polygonlabels[0]", "string").alias("label"), points.alias("points"))


def result_keypoints(results: DataFrame) -> DataFrame:
    at = lambda path, kind: F.try_variant_get("result", path, kind)
    return results.filter("type = 'keypointlabels'").select(
        "image_id", "result_id", at("$.value.keypointlabels[0]", "string").alias("label"),
        (at("$.value.x", "double") * at("$.original_width", "double") / 100).alias("x"), (at("$.value.y", "double") * at("$.original_height", "double") / 100).alias("y"),
    )


def result_choices(results: DataFrame) -> DataFrame:
    """One row per choice made."""
    chosen = F.explode(F.try_variant_get("result", "$.value.choices", "array<string>")).alias("choice")
    return results.filter("type = 'choices'").select("image_id", "result_id", F.try_variant_get("result", "$.from_name", "string").alias("question"), chosen)


def _member(name: str, text: Column, quoted: bool = False) -> Column:
    """A member of an object, or null where the text is null; `text` is JSON already unless `quoted`."""
    return F.when(text.isNotNull(), F.concat(F.lit(f'"{name}":'), _quoted(text) if quoted else text))


def _quoted(text: Column) -> Column:
    said = F.to_json(F.array(text))
    return F.substring(said, F.lit(2), F.length(said) - 2)


def write_results(results: DataFrame, path: str) -> None:
    """Tasks as JSON Lines again, each result with its own bytes; unreadable lines as they were.

    Tasks may be written in any order of files, each on a line with its annotations and results in their order.
    """
    keys = ["task_no", "task_id", "data", "line"]
    text = F.when(F.col("result").isNull(), _quoted(F.col("raw"))).otherwise(F.col("raw"))
    raws = F.transform(F.array_sort(F.collect_list(F.when(F.col("raw").isNotNull(), F.struct("result_no", text.alias("raw"))))), lambda x: x["raw"])
    reviews = results.groupBy(*keys, "review_no", "review_id", "review").agg(raws.alias("raws"))
    text = F.concat(F.lit("{"), F.concat_ws(
        ",", _member("id", F.col("review_id")), _member("was_cancelled", F.col("review.was_cancelled")),
        _member("completed_by", F.col("review.completed_by"), quoted=True), _member("lead_time", F.col("review.lead_time")),
        _member("created_at", F.col("review.created_at"), quoted=True), F.concat(F.lit('"result":['), F.array_join("raws", ","), F.lit("]")),
    ), F.lit("}"))
    tasks = reviews.withColumn("text", text).groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("review_no").isNotNull(), F.struct("review_no", "text")))), lambda x: x["text"]).alias("texts"))
    line = F.concat(F.lit("{"), F.concat_ws(",", _member("id", F.col("task_id")), _member("data", F.col("data")), F.concat(F.lit('"annotations":['), F.array_join("texts", ","), F.lit("]"))), F.lit("}"))
    tasks.select(F.coalesce("line", line).alias("value")).write.text(path)
