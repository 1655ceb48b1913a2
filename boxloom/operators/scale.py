"""Ways to keep one hot key from landing in one task.

* `hot_keys` / `split_hot`: find groups above a size by a pre-aggregated count.
* `carry` / `running_sum`: ordered scans per key, cut into buckets of the order
  column, so that a key of any length is spread over many tasks.
* `range_parts` / `part_running_sum`: the same for an arbitrary sort order.
* `join_small`: broadcast only what has been counted and measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from boxloom.session import checkpointed, stored

BROADCAST_ROWS = 50_000
#: Characters of all values as JSON that may be broadcast; no value takes more than four times its text in memory.
BROADCAST_TEXT = 8_000_000


def fits_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_text: int = BROADCAST_TEXT) -> bool:
    """Whether `small` has at most `max_rows` rows and `max_text` characters; reads no more than one row beyond the limit."""
    size = F.length(F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(small.columns)])))
    rows, text = small.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    return rows <= max_rows and (text or 0) <= max_text


def join_small(df: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast `small` when its measured rows and bytes allow, else leave the join to Spark."""
    if fits_broadcast(small, max_rows):
        small = F.broadcast(small)
    return df.join(small, on, how)


def hot_keys(df: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    """Keys with more than `limit` rows, or None. Counts are combined before the shuffle."""
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(*keys)
    big = checkpointed(big)
    return None if big.isEmpty() else big


def split_by_keys(df: DataFrame, keys: list[str], big: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    if big is None:
        return df, None
    return join_small(df, big, keys, "left_anti"), join_small(df, big, keys, "left_semi")


def split_hot(df: DataFrame, keys: list[str], limit: int) -> tuple[DataFrame, DataFrame | None]:
    return split_by_keys(df, keys, hot_keys(df, keys, limit))


def _bucket(order: str, width: int) -> Column:
    return F.floor(F.col(order) / F.lit(width))


def carry(
    df: DataFrame,
    keys: list[str],
    order: str,
    values: dict[str, Column],
    *,
    width: int,
    ties: tuple[str, ...] = (),
    later: dict[str, Column] | None = None,
    include_self: bool = False,
) -> DataFrame:
    """Add, per name, the nearest earlier (`values`) or later (`later`) non-null value of the key.

    Like `lag`/`last(ignorenulls)`, but the window is (key, bucket of `order`), and only one row
    per bucket takes part in the second window, which links neighbouring buckets. That row comes
    from an aggregation combined before its shuffle, so `df` itself is shuffled once. Both sides
    read `df`: freeze it first when it is costly.
    """
    sides = {n: (v, True) for n, v in values.items()} | {n: (v, False) for n, v in (later or {}).items()}
    rows = df.withColumns({f"_v_{n}": v for n, (v, _) in sides.items()}).withColumn("_bucket", _bucket(order, width))
    by = [order, *ties]
    at = F.struct(*by)
    ends = rows.groupBy(*keys, "_bucket").agg(*[
        (F.max_by if past else F.min_by)(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_end_{n}")
        for n, (_, past) in sides.items()
    ])

    def window(part: list[str], columns: list[str], past: bool, last: int):
        ordered = [F.col(x).asc() if past else F.col(x).desc() for x in columns]
        return W.partitionBy(*part).orderBy(*ordered).rowsBetween(W.unboundedPreceding, last)

    far = [F.last(f"_end_{n}", ignorenulls=True).over(window(keys, ["_bucket"], past, -1)).alias(f"_far_{n}") for n, (_, past) in sides.items()]
    ends = ends.select(*keys, "_bucket", *far)
    inner = 0 if include_self else -1
    near = rows.withColumns({
        f"_near_{n}": F.last(f"_v_{n}", ignorenulls=True).over(window([*keys, "_bucket"], by, past, inner))
        for n, (_, past) in sides.items()
    })
    kept = [x for x in df.columns if x not in sides]
    joined = near.join(ends, [*keys, "_bucket"])
    return joined.select(*kept, *[F.coalesce(f"_near_{n}", f"_far_{n}").alias(n) for n in sides])


def running_sum(
    df: DataFrame,
    keys: list[str],
    order: str,
    sums: dict[str, Column],
    *,
    width: int,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Add inclusive running sums per key in `order`, cut into buckets as in `carry`."""
    held = {name: f"_v_{name}" for name in sums}
    rows = df.withColumns({held[n]: v for n, v in sums.items()}).withColumn("_bucket", _bucket(order, width))
    return _link_sums(rows, keys, "_bucket", [F.col(x) for x in (order, *ties)], held, df.columns)


def range_parts(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Range-partition by (keys, order) and freeze the cut, so `_part` never moves on a retry.

    A hot key spans several parts; `order` must make rows of a key distinct.
    """
    cut = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return stored(cut.withColumn("_part", F.spark_partition_id()))


def part_running_sum(parts: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Inclusive running sums over the result of `range_parts`."""
    held = {name: f"_v_{name}" for name in sums}
    rows = parts.withColumns({held[n]: v for n, v in sums.items()})
    return _link_sums(rows, keys, "_part", order, held, [x for x in parts.columns if x != "_part"])


def _link_sums(rows, keys, cut, order, held, columns) -> DataFrame:
    before = W.partitionBy(*keys).orderBy(cut).rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, cut).agg(*[F.sum(h).alias(f"_sum{h}") for h in held.values()])
    totals = totals.select(*keys, cut, *[
        F.coalesce(F.sum(f"_sum{h}").over(before), F.lit(0)).alias(f"_off{h}") for h in held.values()
    ])
    inner = W.partitionBy(*keys, cut).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    near = rows.withColumns({f"_near{h}": F.sum(h).over(inner) for h in held.values()})
    kept = [x for x in columns if x not in held]
    return near.join(totals, [*keys, cut]).select(*kept, *[
        (F.col(f"_near{h}") + F.col(f"_off{h}")).alias(n) for n, h in held.items()
    ])


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, name: str) -> DataFrame:
    """Exact interpolated quantile per key (null values ignored) without holding a group in memory.

    Equal values are counted first; the counts are then accumulated over range parts.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    cum = part_running_sum(range_parts(counts, keys, [F.col(value).asc()]), keys, [F.col(value).asc()], {"_cum": F.col("_n")})
    total = cum.groupBy(*keys).agg(F.max("_cum").alias("_total"))
    rows = cum.join(total, keys) if keys else cum.withColumn("_total", total.scalar())
    at = (F.col("_total") - 1) * F.lit(q)
    low, high = F.floor(at), F.ceil(at)
    picked = rows.groupBy(*keys).agg(
        F.min(F.when(F.col("_cum") > low, F.col(value).cast("double"))).alias("_low"),
        F.min(F.when(F.col("_cum") > high, F.col(value).cast("double"))).alias("_high"),
        F.max(at - low).alias("_share"),
    )
    return picked.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias(name))


def exact_percent_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """`percent_rank` over all rows; nulls stay null. Works on counts of distinct values."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col(value).asc()]
    cum = part_running_sum(range_parts(counts, [], order), [], order, {"_cum": F.col("_n")})
    ranks = cum.withColumn("_total", cum.agg(F.max("_cum")).scalar())
    share = F.coalesce(F.try_divide((F.col("_cum") - F.col("_n")).cast("double"), F.col("_total") - 1), F.lit(0.0))
    ranks = ranks.select(value, share.alias(name))
    return df.join(ranks, value, "left")
