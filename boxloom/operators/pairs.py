"""Joins between boxes by overlap.

The equi keys (image, class by default) give a hash join with the overlap as a residual
predicate. Groups above `group_limit` boxes are split further by image cells whose size
follows the size of the boxes: an IoU of t bounds the ratio of sides by 1 / t, so with a
factor of 1 / t between levels two boxes of a pair lie at most one level apart. A box stands
in the few cells it reaches at its own level and at the next one, whatever its size, and a
pair is kept only at the coarser of its two levels, in the cell that holds the upper left
corner of the shared area, so no pair is repeated and none is lost. Cells that still hold
more than `cell_limit` boxes are dealt as pairs of blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from boxloom.functions import geometry as g
from boxloom.operators.scale import hot_keys, join_small, split_by_keys
from boxloom.session import checkpointed

GROUP_LIMIT = 256
CELL = 64
#: Boxes of both sides that one unit of work of a hot place holds about.
CELL_LIMIT = 2_048
PLACE = ["_level", "_cx", "_cy"]
#: From this IoU on, hot groups are joined over bands of sides and cells that are small against the boxes.
NEAR_IOU = 0.75
NEAR_PLACE = ["_bx", "_by", "_cx", "_cy"]
#: Ratio of sides within a band as a power of 1 / t; size of a cell against the farthest move of a corner.
NEAR_BANDS, NEAR_CELLS = 4, 4


def _packed(df: DataFrame, keys: list[str], ident: str, side: str, extra: list[str]) -> DataFrame:
    body = F.struct(F.col(ident).alias("id"), *[F.col(n) for n in g.CORNERS], *[F.col(n) for n in extra])
    return df.select(*keys, body.alias(side))


def cells(df: DataFrame, side: str, cell: int) -> DataFrame:
    def reach(low: str, high: str) -> Column:
        first = F.floor(F.col(f"{side}.{low}") / cell)
        return F.sequence(first, F.greatest(first, F.ceil(F.col(f"{side}.{high}") / cell) - 1))

    return df.withColumn("_cx", F.explode(reach("x1", "x2"))).withColumn("_cy", F.explode(reach("y1", "y2")))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], min_iou: float, residual) -> DataFrame:
    a, b = g.corners("a"), g.corners("b")
    rows = left.join(right, keys)
    rows = rows.filter(g.overlaps(a, b))
    if residual is not None:
        rows = rows.filter(residual(F.col("a"), F.col("b")))
    return rows.withColumn("iou", g.iou(a, b)).filter(F.col("iou") >= min_iou)


def _level_factor(min_iou: float) -> float:
    """Ratio of cell sizes from level to level; a little over 1 / t, so that rounding parts no pair."""
    return max(2.0, (1.0 + 1e-9) / min_iou)


def _cell_size(level: Column, cell: float, factor: float) -> Column:
    return F.lit(float(cell)) * F.pow(F.lit(factor), level)


def placed(df: DataFrame, side: str, cell: float, factor: float) -> DataFrame:
    """Copies of the boxes in the cells they reach at their own level and the next; `_own` tells the level of the box.

    Boxes without a positive finite area overlap nothing and have no place.
    """
    low, high = (lambda axis: F.col(f"{side}.{axis}1").cast("double")), (lambda axis: F.col(f"{side}.{axis}2").cast("double"))
    width, height = high("x") - low("x"), high("y") - low("y")
    rows = df.filter((width > 0) & (height > 0) & (width < math.inf) & (height < math.inf))
    own = F.ceil(F.log(F.greatest(width, height) / F.lit(float(cell))) / F.lit(math.log(factor))).cast("int")
    rows = rows.withColumn("_own", own).withColumn("_level", F.explode(F.array("_own", F.col("_own") + 1)))
    size = _cell_size(F.col("_level"), cell, factor)
    for axis in ("x", "y"):
        rows = rows.withColumn(f"_c{axis}", F.explode(F.sequence(F.floor(low(axis) / size), F.floor(high(axis) / size))))
    return rows


def near_places(df: DataFrame, side: str, min_iou: float, home: bool) -> DataFrame:
    """For a high threshold t: the one place of a box (`home`), or all places where boxes that overlap it by t may be at home.

    An IoU of t bounds the ratio of sides by 1 / t, and moves a corner by at most 1 - t of the longer side. So a place is a
    band of widths, one of heights, and a cell that is small against both; a pair meets once, at the home of its left box.
    """
    t = min(min_iou, 0.99) * (1.0 - 1e-9)
    step = -NEAR_BANDS * math.log(t)
    low, high = (lambda axis: F.col(f"{side}.{axis}1").cast("double")), (lambda axis: F.col(f"{side}.{axis}2").cast("double"))
    width, height = high("x") - low("x"), high("y") - low("y")
    rows = df.filter((width > 0) & (height > 0) & (width < math.inf) & (height < math.inf))
    for axis, length in (("x", width), ("y", height)):
        def band(of: Column, slack: float) -> Column:
            return F.floor(F.log(of) / step + slack).cast("int")

        size = F.exp((F.col(f"_b{axis}") + 1) * step) * (NEAR_CELLS * (1.0 - t))
        if home:
            rows = rows.withColumn(f"_b{axis}", band(length, 0.0)).withColumn(f"_c{axis}", F.floor(low(axis) / size))
            continue
        reach = length * ((1.0 - t) / t * (1.0 + 1e-9)) + F.abs(low(axis)) * 1e-15
        rows = rows.withColumn(f"_b{axis}", F.explode(F.sequence(band(length * t, -1e-9), band(length / t, 1e-9))))
        rows = rows.withColumn(f"_c{axis}", F.explode(F.sequence(F.floor((low(axis) - reach) / size), F.floor((low(axis) + reach) / size))))
    return rows


def _dealt(left: DataFrame, right: DataFrame, place: list[str], cell_limit: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with `_i` and `_j`: blocks of the left and right boxes of a place, (0, 0) where one unit holds all.

    Each box of a heavy place is copied once per block of the other side only.
    """
    none, one = F.lit(0), F.lit(1)
    marks = left.select(*place, one.alias("_l"), none.alias("_r")).unionAll(right.select(*place, none.alias("_l"), one.alias("_r")))
    heavy = marks.groupBy(*place).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    heavy = heavy.filter((F.col("_l") + F.col("_r") > cell_limit) & (F.col("_l") > 0) & (F.col("_r") > 0))
    half = max(1, cell_limit // 2)
    heavy = checkpointed(heavy.select(*place, F.ceil(F.col("_l") / half).alias("_nl"), F.ceil(F.col("_r") / half).alias("_nr")))
    if heavy.isEmpty():
        return (df.withColumns({"_i": F.lit(0).cast("long"), "_j": F.lit(0).cast("long")}) for df in (left, right))

    def deal(df: DataFrame, side: str, mine: str, own: str, other: str, copies: str) -> DataFrame:
        rows = join_small(df, heavy, place, "left")
        block = F.coalesce(F.pmod(F.xxhash64(F.lit(11), f"{side}.id"), F.col(own)), F.lit(0).cast("long"))
        every = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(copies), F.lit(1).cast("long")) - 1)
        return rows.withColumn(mine, block).withColumn(other, F.explode(every)).drop("_nl", "_nr")

    return deal(left, "a", "_i", "_nl", "_j", "_nr"), deal(right, "b", "_j", "_nr", "_i", "_nl")


def _gridded(left, right, keys, min_iou, residual, cell, cell_limit) -> DataFrame:
    if min_iou >= NEAR_IOU:
        place = [*keys, *NEAR_PLACE]
        a, b = _dealt(near_places(left, "a", min_iou, True), near_places(right, "b", min_iou, False), place, cell_limit)
        return _joined(a, b, [*place, "_i", "_j"], min_iou, residual).drop(*NEAR_PLACE, "_i", "_j")
    factor = _level_factor(min_iou)
    place = [*keys, *PLACE]
    a, b = placed(left, "a", cell, factor), placed(right, "b", cell, factor)
    a, b = _dealt(a.withColumnRenamed("_own", "_own_a"), b.withColumnRenamed("_own", "_own_b"), place, cell_limit)

    def here(p: Column, q: Column) -> Column:
        size = _cell_size(F.col("_level"), cell, factor)
        owner = [F.floor(F.greatest(p[f"{axis}1"], q[f"{axis}1"]).cast("double") / size) == F.col(f"_c{axis}") for axis in ("x", "y")]
        pair = (F.greatest("_own_a", "_own_b") == F.col("_level")) & owner[0] & owner[1]
        return pair if residual is None else pair & residual(p, q)

    return _joined(a, b, [*place, "_i", "_j"], min_iou, here).drop(*PLACE, "_i", "_j", "_own_a", "_own_b")


def overlap_parts(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    min_iou: float,
    *,
    left_id: str,
    right_id: str,
    left_extra: list[str] = (),
    right_extra: list[str] = (),
    residual=None,
    group_limit: int = GROUP_LIMIT,
    cell: int = CELL,
    cell_limit: int = CELL_LIMIT,
) -> tuple[DataFrame, DataFrame | None]:
    """Overlaps of at least `min_iou` (> 0) as rows (keys, a, b, iou), a and b being box structs.

    Two parts: groups of at most `group_limit` boxes, and the hot groups (None without any).
    The sizes come from one count of the keys, made before any pair is.
    """
    a = _packed(left, keys, left_id, "a", list(left_extra))
    b = _packed(right, keys, right_id, "b", list(right_extra))
    big = hot_keys(left.select(*keys).unionAll(right.select(*keys)), keys, group_limit)
    small_a, hot_a = split_by_keys(a, keys, big)
    small_b, hot_b = split_by_keys(b, keys, big)
    rows = _joined(small_a, small_b, keys, min_iou, residual)
    hot = None if big is None else _gridded(hot_a, hot_b, keys, min_iou, residual, cell, cell_limit)
    return rows, hot


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], min_iou: float, **options) -> DataFrame:
    """Both parts of `overlap_parts` as one table."""
    rows, hot = overlap_parts(left, right, keys, min_iou, **options)
    return rows if hot is None else rows.unionByName(hot)


def iou_pairs(
    pred: DataFrame,
    truth: DataFrame,
    min_iou: float = 0.5,
    keys: tuple[str, ...] = ("image_id", "class_id"),
    *,
    left_id: str = "det_id",
    right_id: str = "annotation_id",
    group_limit: int = GROUP_LIMIT,
    cell: int = CELL,
    cell_limit: int = CELL_LIMIT,
) -> DataFrame:
    """Prediction x truth overlaps of the same image and class."""
    rows = overlap_join(
        pred, truth, list(keys), min_iou,
        left_id=left_id, right_id=right_id, group_limit=group_limit, cell=cell, cell_limit=cell_limit,
    )
    return rows.select(*keys, F.col("a.id").alias(left_id), F.col("b.id").alias(right_id), "iou")


def self_pairs(
    boxes: DataFrame,
    min_iou: float = 0.5,
    keys: tuple[str, ...] = ("image_id", "class_id"),
    *,
    ident: str = "det_id",
    group_limit: int = GROUP_LIMIT,
    cell: int = CELL,
    cell_limit: int = CELL_LIMIT,
) -> DataFrame:
    """Overlaps within one set of boxes, each pair once with the smaller id first."""
    rows = overlap_join(
        boxes, boxes, list(keys), min_iou, left_id=ident, right_id=ident,
        residual=lambda a, b: a["id"] < b["id"], group_limit=group_limit, cell=cell, cell_limit=cell_limit,
    )
    return rows.select(*keys, F.col("a.id").alias(f"{ident}_a"), F.col("b.id").alias(f"{ident}_b"), "iou")


def adjacent_support(
    boxes: DataFrame,
    k: int = 1,
    min_iou: float = 0.5,
    keys: tuple[str, ...] = ("sequence_id", "camera_id"),
    *,
    same_class: bool = True,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Whether a box is overlapped in an earlier or later frame at distance 1..k."""
    lane = [*keys, "class_id"] if same_class else list(keys)
    offsets = F.array(*[F.lit(d).cast("long") for d in range(-k, k + 1) if d != 0])
    moved = boxes.withColumn("_step", F.explode(offsets)).withColumn("frame_id", F.col("frame_id") + F.col("_step"))
    hits = overlap_join(
        moved, boxes, [*lane, "frame_id"], min_iou, left_id="det_id", right_id="det_id",
        left_extra=["_step"], group_limit=group_limit,
    )
    found = hits.groupBy(F.col("a.id").alias("det_id")).agg(
        F.max((F.col("a._step") < 0).cast("int")).alias("_before"),
        F.max((F.col("a._step") > 0).cast("int")).alias("_after"),
    )
    out = boxes.join(found, "det_id", "left")
    before = F.coalesce(F.col("_before"), F.lit(0)) == 1
    after = F.coalesce(F.col("_after"), F.lit(0)) == 1
    return out.withColumns({
        "support_before": before, "support_after": after, "supported": before | after,
    }).drop("_before", "_after")
