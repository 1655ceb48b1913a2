"""Append-once into a table laid out by levels and hash buckets of the key.

Level d has 2^d buckets and is written until its files reach `bucket_bytes` a bucket; then level d + 1 begins. A batch that
holds more than that for each bucket begins as many levels further, so that no task writes it whole. A key lies
in the same bucket of a level for ever, so a batch is compared with the buckets of its own keys only: at most
`bucket_bytes` for each key and level, however large the table has grown, and of those only the key columns. Nothing is
rewritten. Levels grow by powers of two, so a table of N buckets' worth of rows has about log2(N) levels.

Buckets that a batch touches are found from file names; rows of the batch, not of the target, choose them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructField, StructType

LEVEL, BUCKET = "append_level", "append_bucket"
#: Bytes of files a bucket holds before the next level begins, and the last level (4,096 buckets), which has no end.
BUCKET_BYTES, LAST_LEVEL = 32 << 20, 12


class Layout:
    """The folders of a target as its file system lists them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self, name: str, inside: str = "") -> list[int]:
        """The values of partition column `name` right below `inside`."""
        found = self._files.globStatus(self._hadoop(f"{self.path}{inside}/{name}=*")) or []
        return sorted(int(f.getPath().getName().split("=")[1]) for f in found)

    def bytes_of(self, level: int) -> int:
        return self._files.getContentSummary(self._hadoop(f"{self.path}/{LEVEL}={level}")).getLength()

    def folders(self, level: int, buckets: set[int]) -> list[str]:
        there = buckets.intersection(self.numbers(BUCKET, f"/{LEVEL}={level}"))
        return [f"{self.path}/{LEVEL}={level}/{BUCKET}={b}" for b in sorted(there)]


def bucket_of(keys: list[str], level: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(1 << level)).cast("int")


def compared(df: DataFrame, path: str, keys: list[str]) -> DataFrame | None:
    """The keys of the target's buckets that rows of `df` fall in; None where there is none."""
    spark = df.sparkSession
    layout = Layout(spark, path)
    levels = layout.numbers(LEVEL)
    if not levels:
        return None
    # the deepest level's buckets tell those of all others; at most 2^LAST_LEVEL numbers
    deepest = {r[0] for r in df.select(bucket_of(keys, levels[-1])).distinct().collect()} if levels[-1] else {0}
    folders = [f for d in levels for f in layout.folders(d, {b % (1 << d) for b in deepest})]
    if not folders:
        return None
    return spark.read.schema(df.schema).option("basePath", path).parquet(*folders).select(*keys)


def _width(kind: DataType) -> int:
    """Bytes that a value inside a list is taken to have."""
    if isinstance(kind, StructType):
        return sum(_width(f.dataType) for f in kind.fields)
    return 32 if isinstance(kind, (StringType, BinaryType)) else 64 if isinstance(kind, (ArrayType, MapType)) else 8


def _bytes(value: Column, kind: DataType) -> Column:
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(value) + 8
    elif isinstance(kind, StructType):
        size = sum((_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(8))
    elif isinstance(kind, ArrayType):
        inner = kind.elementType
        fields = [f.dataType for f in inner.fields] if isinstance(inner, StructType) else [inner]
        flat = isinstance(inner, StructType) and not any(isinstance(k, (ArrayType, MapType, StructType)) for k in fields)
        if flat or _width(inner) == 8:
            size = F.size(value) * _width(inner)
        else:
            size = F.aggregate(value, F.lit(0).cast("long"), lambda total, x: total + _bytes(x, inner))
    else:
        size = F.lit(_width(kind))
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def bytes_of(df: DataFrame) -> int:
    """About what the rows take in memory. Structs in lists count by their types, so that their texts need not be made."""
    return df.agg(F.sum(_bytes(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]), StructType([
        StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)
    ])))).first()[0] or 0


def append_bucketed(df: DataFrame, path: str, keys: list[str], bucket_bytes: int | None = None) -> None:
    """Append the rows of `df` whose key the target does not hold; running it twice adds nothing.

    Nulls in keys equal each other. A key that comes twice in `df` is written once. The target gets the columns
    append_level and append_bucket beside those of `df`. One writer at a time; a run that broke off before its commit
    leaves nothing that a reader sees, and is repeated. An empty `df` writes nothing.
    """
    layout = Layout(df.sparkSession, path)
    levels = layout.numbers(LEVEL)
    level = levels[-1] if levels else 0
    room = BUCKET_BYTES if bucket_bytes is None else bucket_bytes
    if levels and level < LAST_LEVEL and layout.bytes_of(level) >= room << level:
        level += 1
    arriving = bytes_of(df) if level < LAST_LEVEL else 0
    while level < LAST_LEVEL and arriving > room << level:
        level += 1
    rows, held = df.dropDuplicates(keys), compared(df, path, keys)
    if held is not None:
        held = held.toDF(*[f"_held_{k}" for k in keys])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
        rows = rows.join(held, same, "left_anti")
    rows = rows.withColumns({LEVEL: F.lit(level), BUCKET: bucket_of(keys, level)})
    # one file per bucket and batch
    rows.repartition(BUCKET).write.mode("append").partitionBy(LEVEL, BUCKET).parquet(path)
