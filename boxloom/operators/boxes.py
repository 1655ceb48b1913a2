"""Row-wise box operators: clip, convert, filter, bucket, tile, ignore regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxloom.constants import MEDIUM_AREA, SMALL_AREA
from boxloom.functions import geometry as g
from boxloom.operators.scale import join_small


def clip_corners(box: list[Column], width: Column, height: Column) -> list[Column]:
    zero = F.lit(0.0)
    limits = [width, height, width, height]
    return [F.least(F.greatest(v, zero), limit.cast("double")) for v, limit in zip(box, limits)]


def clip_boxes(df: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Clip to the image; boxes that become empty are dropped, or flagged with `keep_empty`."""
    moved = clip_corners(g.corners(), F.col("width"), F.col("height"))
    out = df.withColumns(dict(zip(g.CORNERS, moved)))
    empty = (F.col("x2") <= F.col("x1")) | (F.col("y2") <= F.col("y1"))
    if keep_empty:
        return out.withColumn("empty_after_clip", empty)
    return out.filter(~empty)


def clip_drop_counts(df: DataFrame) -> DataFrame:
    flagged = clip_boxes(df, keep_empty=True)
    return flagged.agg(
        F.count(F.lit(1)).alias("boxes"),
        F.count_if("empty_after_clip").alias("dropped"),
    )


def filter_scores(df: DataFrame, thresholds: DataFrame, keys: list[str]) -> DataFrame:
    """Keep boxes at or above the class's low threshold; mark those at or above the high one."""
    kept = join_small(df, thresholds, keys).filter(F.col("score") >= F.col("low"))
    return kept.withColumn("strong", F.col("score") >= F.col("high")).drop("low", "high")


def result_struct(box: Column, width: Column, height: Column, result_id: Column | None = None) -> Column:
    """One rectangle result of the review UI from a box struct (corners, label, score)."""
    rect = g.percent_box([box[n] for n in g.CORNERS], width, height)
    head = [] if result_id is None else [result_id.cast("string").alias("id")]
    return F.struct(
        *head,
        F.lit("label").alias("from_name"),
        F.lit("image").alias("to_name"),
        F.lit("rectanglelabels").alias("type"),
        F.lit("prediction").alias("origin"),
        width.alias("original_width"),
        height.alias("original_height"),
        F.lit(0).alias("image_rotation"),
        F.struct(
            rect["x"].alias("x"), rect["y"].alias("y"),
            rect["width"].alias("width"), rect["height"].alias("height"),
            F.lit(0).alias("rotation"), F.array(box["label"]).alias("rectanglelabels"),
        ).alias("value"),
        box["score"].alias("score"),
    )


def prediction_results(df: DataFrame) -> DataFrame:
    """Nested predictions to result lists, in box order; missing boxes give an empty list."""
    boxes = F.coalesce(F.col("boxes"), F.array().cast(df.schema["boxes"].dataType))
    return df.withColumn("result", F.transform(boxes, lambda b: result_struct(b, F.col("width"), F.col("height"))))


def to_percent(df: DataFrame) -> DataFrame:
    rect = g.percent_box(g.corners(), F.col("width"), F.col("height"))
    return df.withColumns({f"pct_{n}": rect[n] for n in ("x", "y", "width", "height")})


def from_percent(df: DataFrame) -> DataFrame:
    rect = F.struct(*[F.col(f"pct_{n}").alias(n) for n in ("x", "y", "width", "height")])
    box = g.from_percent_box(rect, F.col("width"), F.col("height"))
    return df.withColumns({n: box[n] for n in g.CORNERS})


def round_trip_error(df: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Largest edge error in pixels after clip -> percentages -> pixels."""
    there = to_percent(clip_boxes(df))
    rect = F.struct(*[F.col(f"pct_{n}").alias(n) for n in ("x", "y", "width", "height")])
    back = g.from_percent_box(rect, F.col("width"), F.col("height"))
    error = F.greatest(*[F.abs(back[n] - F.col(n)) for n in g.CORNERS])
    return there.withColumn("edge_error", error).withColumn("ok", F.col("edge_error") <= tolerance)


def to_xywh(df: DataFrame) -> DataFrame:
    box = g.corners()
    return df.withColumns({"x": box[0], "y": box[1], "w": g.width(box), "h": g.height(box)}).drop(*g.CORNERS)


def from_xywh(df: DataFrame) -> DataFrame:
    x, y, w, h = (F.col(n) for n in "xywh")
    return df.withColumns({"x1": x, "y1": y, "x2": x + w, "y2": y + h}).drop("x", "y", "w", "h")


def size_bucket(df: DataFrame, small: float = SMALL_AREA, medium: float = MEDIUM_AREA) -> DataFrame:
    return df.withColumn("size_bucket", g.size_bucket(g.area(g.corners()), small, medium))


def band_column(score: Column, edges: list[float]) -> Column:
    """Text label of the half-open band [edge, next edge) that holds the score."""
    bounds = [0.0, *edges]
    label = F.lit(None).cast("string")
    for i, low in enumerate(bounds):
        name = f"[{low:.2f},{bounds[i + 1]:.2f})" if i + 1 < len(bounds) else f"[{low:.2f},1.00]"
        label = F.when(score >= low, F.lit(name)).otherwise(label)
    return label


def score_band(df: DataFrame, edges: list[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    return df.withColumn("score_band", band_column(F.col("score"), list(edges)))


def polygon_outline(polygons: Column) -> Column:
    """The edges of each polygon, and the box around all of them: made once per camera, read once per box."""
    points = F.flatten(polygons)
    ends = {f"{low}_{n}": end(F.transform(points, lambda p: p[n].cast("double"))) for n in ("x", "y") for low, end in (("min", F.array_min), ("max", F.array_max))}
    edges = F.transform(polygons, g.polygon_edges)
    return F.when(polygons.isNotNull(), F.struct(edges.alias("edges"), *[v.alias(k) for k, v in ends.items()]))


def outline_share(outline: Column, box: list[Column]) -> Column:
    """Share of the box inside the (non-overlapping) polygons of an outline; boxes away from all of them are not worked on."""
    near = (outline["min_x"] < box[2]) & (outline["max_x"] > box[0]) & (outline["min_y"] < box[3]) & (outline["max_y"] > box[1])
    covered = F.aggregate(outline["edges"], F.lit(0.0), lambda t, e: t + g.edges_box_area(e, box))
    return F.when(near, F.coalesce(F.try_divide(covered, g.area(box)), F.lit(0.0))).otherwise(0.0)


def polygon_share(polygons: Column, box: list[Column]) -> Column:
    """Share of the box inside the (non-overlapping) polygons of its camera."""
    return outline_share(polygon_outline(polygons), box)


def mark_ignored(df: DataFrame, polygons: DataFrame, ratio: float = 0.5) -> DataFrame:
    """Flag boxes whose share inside the camera's ignore polygons reaches `ratio`.

    `polygons`: camera_id, ignore_polygons. Rows are kept, so they can be counted.
    """
    outlines = polygons.select("camera_id", polygon_outline(F.col("ignore_polygons")).alias("_outline"))
    joined = join_small(df, outlines, ["camera_id"], "left")
    share = outline_share(F.col("_outline"), g.corners())
    return joined.withColumn("ignore_share", share).withColumn(
        "ignored", F.col("ignore_share") >= ratio
    ).drop("_outline")


def without_ignored(df: DataFrame, polygons: DataFrame, ratio: float = 0.5) -> DataFrame:
    """The boxes that take part in scoring: predictions and truth inside ignore regions belong to neither side.

    `mark_ignored` keeps and counts what this leaves out.
    """
    return mark_ignored(df, polygons, ratio).filter(~F.col("ignored")).drop("ignore_share", "ignored")


def in_road_region(df: DataFrame, regions: DataFrame, ratio: float = 0.5) -> DataFrame:
    """Keep boxes that lie in the camera's road region; cameras without one keep all."""
    outlines = regions.select("camera_id", polygon_outline(F.col("road_polygons")).alias("_outline"))
    joined = join_small(df, outlines, ["camera_id"], "left")
    share = outline_share(F.col("_outline"), g.corners())
    return joined.filter(F.col("_outline").isNull() | (share >= ratio)).drop("_outline")


def min_area(df: DataFrame, smallest: float) -> DataFrame:
    return df.filter(g.area(g.corners()) >= smallest)


def touches_border(df: DataFrame, margin: float = 0.0) -> DataFrame:
    """Candidate flag for truncation; border boxes stay in the data."""
    x1, y1, x2, y2 = g.corners()
    at_edge = (x1 <= margin) | (y1 <= margin) | (x2 >= F.col("width") - margin) | (y2 >= F.col("height") - margin)
    return df.withColumn("touches_border", at_edge)


def tile_starts(length: Column, size: int, overlap: int) -> Column:
    """Offsets that cover [0, length); the last tile is moved back inside the image."""
    step = size - overlap
    last = F.greatest(length - size, F.lit(0)).cast("int")
    regular = F.filter(F.sequence(F.lit(0), last, F.lit(step)), lambda s: s < last)
    return F.concat(regular, F.array(last))


def make_tiles(images: DataFrame, size: int = 640, overlap: int = 128) -> DataFrame:
    rows = images.withColumn("tile_x", F.explode(tile_starts(F.col("width"), size, overlap)))
    rows = rows.withColumn("tile_y", F.explode(tile_starts(F.col("height"), size, overlap)))
    return rows.withColumns({
        "tile_width": F.least(F.lit(size), F.col("width")),
        "tile_height": F.least(F.lit(size), F.col("height")),
    })


def cut_to_tiles(boxes: DataFrame, size: int = 640, overlap: int = 128) -> DataFrame:
    """Boxes in tile coordinates, one row for each tile a box reaches."""
    tiles = make_tiles(boxes, size, overlap)
    x1, y1, x2, y2 = g.corners()
    left, top = F.col("tile_x"), F.col("tile_y")
    right, bottom = left + F.col("tile_width"), top + F.col("tile_height")
    reach = tiles.filter((x1 < right) & (x2 > left) & (y1 < bottom) & (y2 > top))
    return reach.withColumns({
        "x1": F.greatest(x1, left) - left,
        "y1": F.greatest(y1, top) - top,
        "x2": F.least(x2, right) - left,
        "y2": F.least(y2, bottom) - top,
    })


def untile(boxes: DataFrame) -> DataFrame:
    """Tile coordinates back to the full image."""
    shift = {"x1": "tile_x", "x2": "tile_x", "y1": "tile_y", "y2": "tile_y"}
    return boxes.withColumns({n: F.col(n) + F.col(s) for n, s in shift.items()})


def migrate_taxonomy(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Class ids of the next taxonomy; `mapping`: class_id, new_class_id. Unmapped rows raise."""
    joined = join_small(df, mapping.withColumn("_known", F.lit(True)), ["class_id"], "left")
    message = F.concat(F.lit("class id without a migration: "), F.coalesce(F.col("class_id").cast("string"), F.lit("null")))
    checked = F.when(F.col("_known"), F.col("new_class_id")).otherwise(F.raise_error(message).cast("int"))
    return joined.withColumn("class_id", checked).drop("new_class_id", "_known")
