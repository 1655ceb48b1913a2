"""Score calibration: temperature, isotonic, expected calibration error."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from boxloom.functions.scalars import clamp_probability, temperature_scaled
from boxloom.operators.scale import carry, join_small
from boxloom.session import checkpointed


def _loss(temperature: Column) -> Column:
    """Negative log likelihood of one row at a temperature, in the stable form."""
    s = clamp_probability("score")
    logit = F.log(s / (1.0 - s))
    margin = F.when(F.col("tp"), logit).otherwise(-logit) / temperature
    return F.log1p(F.exp(-margin))


def fit_temperature(scored: DataFrame, key: str = "class_id", low: float = 0.05, high: float = 20.0, points: int = 25, refine: int = 2) -> DataFrame:
    """Temperature per class with the least loss on a log grid, refined around the best point.

    All grid points are aggregates of one pass, so rows are never multiplied.
    """
    ratio = (high / low) ** (1.0 / (points - 1))
    factors = [low * ratio**i for i in range(points)]
    # the loss depends on (class, score, hit) only: equal rows are counted once and read in every round
    counted = checkpointed(scored.groupBy(key, "score", "tp").agg(F.count(F.lit(1)).alias("_n")))
    best = checkpointed(counted.select(key).distinct().withColumn("_centre", F.lit(1.0)))
    for _ in range(refine + 1):
        rows = join_small(counted, best.select(key, "_centre"), [key])
        sums = [F.sum(F.col("_n") * _loss(F.col("_centre") * f)).alias(f"_l{i}") for i, f in enumerate(factors)]
        sums = rows.groupBy(key, "_centre").agg(F.sum("_n").alias("n"), *sums)
        choice = F.array_min(F.array(*[
            F.struct(F.col(f"_l{i}").alias("nll"), (F.col("_centre") * f).alias("t")) for i, f in enumerate(factors)
        ]))
        best = sums.select(key, "n", choice.alias("_c")).select(key, "n", F.col("_c.t").alias("_centre"), F.col("_c.nll").alias("nll"))
        best = checkpointed(best)
        # next grid: the two steps around the best point, again in equal log steps
        step = ratio ** (2.0 / (points - 1))
        factors = [(1.0 / ratio) * step**i for i in range(points)]
        ratio = step
    return best.select(key, "n", F.col("_centre").alias("temperature"), "nll")


def apply_temperature(df: DataFrame, fitted: DataFrame, key: str = "class_id") -> DataFrame:
    rows = join_small(df, fitted.select(key, "temperature"), [key], "left")
    scaled = temperature_scaled("score", F.coalesce("temperature", F.lit(1.0)))
    return rows.withColumn("calibrated", scaled).drop("temperature")


BLOCKS = "class_id int, x0 double, x1 double, hits long, n long"


def _pooled(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pool adjacent violators of blocks sorted by (class, x0): one stack per class, exact in whole numbers."""
    stack: list[list] = []
    held = None
    for rows in parts:
        for cid, x0, x1, hits, n in rows[["class_id", "x0", "x1", "hits", "n"]].itertuples(index=False, name=None):
            if held is not None and cid != held:
                yield pd.DataFrame([(held, *block) for block in stack], columns=["class_id", "x0", "x1", "hits", "n"])
                stack = []
            held = cid
            while stack and stack[-1][2] * n >= hits * stack[-1][3]:
                x0, _, more, m = stack.pop()
                hits, n = hits + more, n + m
            stack.append([x0, x1, hits, n])
    if stack:
        yield pd.DataFrame([(held, *block) for block in stack], columns=["class_id", "x0", "x1", "hits", "n"])


def _pooled_part(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.concat(_pooled(iter([rows.sort_values(["class_id", "x0"])]))).assign(_part=rows["_part"].iloc[0])


def _numbered(blocks: DataFrame) -> tuple[DataFrame, bool]:
    """`blocks` (with `_part`, parts being ranges) with their number in order, and whether a violation lies between parts.

    What is ordered as a whole is one row per part.
    """
    first, last = F.struct("class_id", "x0", "hits", "n"), F.struct("class_id", "hits", "n")
    at = F.struct("class_id", "x0")
    ends = blocks.groupBy("_part").agg(
        F.min_by(first, at).alias("first"), F.max_by(last, at).alias("last"), F.count(F.lit(1)).alias("_size"),
    )
    order = W.orderBy("first.class_id", "first.x0")
    ends = ends.withColumns({"_before": F.lag("last").over(order), "_start": F.sum("_size").over(order) - F.col("_size")})

    def big(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}").cast("decimal(19,0)")

    wrong = (F.col("_before.class_id") == F.col("first.class_id")) & (big("_before", "hits") * big("first", "n") >= big("first", "hits") * big("_before", "n"))
    ends = checkpointed(ends.select("_part", "_start", F.coalesce(wrong, F.lit(False)).alias("_wrong")))
    inner = W.partitionBy("_part").orderBy("class_id", "x0")
    rows = blocks.join(ends.select("_part", "_start"), "_part").withColumn("_at", F.col("_start") + F.row_number().over(inner) - 1)
    return rows.drop("_start"), not ends.filter("_wrong").isEmpty()


def fit_isotonic(scored: DataFrame, classes: list[int] | None = None, min_n: int = 1_000, block_rows: int = 200_000) -> DataFrame:
    """Isotonic fit of all classes at once: class_id, x0, x1, hits, n, value, one row per block of equal fitted rate.

    Classes with fewer than `min_n` rows, and those not in `classes` if given, have no block; rows without a score, class or
    `tp` take no part. Equal scores count as one point. Parts of the ordered points are pooled on their own; since pooling
    any adjacent violators in any order gives the same fit, the blocks left are cut anew (`block_rows` a part, at a
    place that moves from round to round) until no violation lies between parts. Neither a class nor the fit ever lies
    in one task, and only whether a violation is left reaches the driver.
    """
    rows = scored.filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("tp").isNotNull() & F.col("class_id").isNotNull())
    if classes is not None:
        rows = rows.filter(F.col("class_id").isin(list(classes)))
    points = rows.groupBy(F.col("class_id").cast("int").alias("class_id"), (F.col("score").cast("double") + F.lit(0.0)).alias("x0")).agg(
        F.count_if("tp").alias("hits"), F.count(F.lit(1)).alias("n"),
    )
    points = checkpointed(points)
    enough = points.groupBy("class_id").agg(F.sum("n").alias("_n")).filter(F.col("_n") >= min_n).select("class_id")
    points = points.join(enough, "class_id").select("class_id", "x0", F.col("x0").alias("x1"), "hits", "n")
    cut = points.repartitionByRange("class_id", "x0").sortWithinPartitions("class_id", "x0")
    blocks = checkpointed(cut.mapInPandas(_pooled, BLOCKS).withColumn("_part", F.spark_partition_id().cast("long")))
    turn = 0
    while True:
        rows, wrong = _numbered(blocks)
        if not wrong:
            break
        # golden steps never bring back the same cut twice
        shift = int(block_rows * (turn * 0.6180339887498949 % 1.0))
        part = F.floor((F.col("_at") + shift) / block_rows)
        pooled = rows.withColumn("_part", part).groupBy("_part").applyInPandas(_pooled_part, f"{BLOCKS}, _part long")
        blocks = checkpointed(pooled)
        turn += 1
    return blocks.drop("_part").withColumn("value", F.col("hits") / F.col("n"))


def apply_isotonic(df: DataFrame, fitted: DataFrame, buckets: int = 1_024) -> DataFrame:
    """Adds `calibrated`: the block's value, linear between blocks, flat beyond the ends; null without a fit or a score.

    The blocks before and after each distinct score are carried along the order of scores, so the fit is met as a
    table of any length; rows then take the value of their score.
    """
    own = df.select(F.col("class_id").cast("int").alias("class_id"), (F.col("score").cast("double") + F.lit(0.0)).alias("_x"))
    own = own.filter(F.col("class_id").isNotNull() & F.col("_x").isNotNull() & ~F.isnan("_x")).distinct()
    none = F.lit(None)
    block = F.struct(F.col("x0"), F.col("x1"), F.col("value"))
    marks = fitted.select(F.col("class_id").cast("int").alias("class_id"), F.col("x0").alias("_x"), block.alias("_block"))
    both = own.select("class_id", "_x", none.cast(marks.schema["_block"].dataType).alias("_block"), F.lit(1).alias("_kind"))
    # a block stands before the scores equal to its start
    both = checkpointed(both.unionByName(marks.withColumn("_kind", F.lit(0))))
    low, high = both.agg(F.min("_x"), F.max("_x")).first()
    width = max((high - low) / buckets, 1e-300) if low is not None else 1.0
    near = carry(both, ["class_id"], "_x", {"_below": F.col("_block")}, width=width, ties=("_kind",), later={"_above": F.col("_block")})
    x = F.col("_x")
    share = (x - F.col("_below.x1")) / (F.col("_above.x0") - F.col("_below.x1"))
    value = (
        F.when(F.col("_below").isNull(), F.col("_above.value"))
        .when((x <= F.col("_below.x1")) | F.col("_above").isNull(), F.col("_below.value"))
        .otherwise(F.col("_below.value") + share * (F.col("_above.value") - F.col("_below.value")))
    )
    values = near.filter("_kind = 1").select(F.col("class_id").alias("_class"), "_x", value.alias("calibrated"))
    rows = df.drop("calibrated")
    return rows.join(
        values, (rows["class_id"].cast("int") == values["_class"]) & ((rows["score"].cast("double") + F.lit(0.0)) == values["_x"]), "left"
    ).drop("_class", "_x")


def reliability(scored: DataFrame, keys: list[str], bins: int = 10, score: str = "score") -> DataFrame:
    """Reliability table: mean score and hit rate of equal-width bins."""
    number = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(*keys, number.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"),
        F.avg(F.col("tp").cast("double")).alias("tp_rate"),
    )


def calibration_error(scored: DataFrame, keys: list[str], bins: int = 10, score: str = "score") -> DataFrame:
    table = reliability(scored, keys, bins, score)
    gap = F.col("n") * F.abs(F.col("mean_score") - F.col("tp_rate"))
    return table.groupBy(*keys).agg(F.sum("n").alias("n"), F.try_divide(F.sum(gap), F.sum("n")).alias("ece"))
