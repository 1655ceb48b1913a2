"""Session settings and the one place that decides where checkpoints go."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def get_session(app: str = "boxloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a shuffle on (image, class) also serves a join on (image, class, det)
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; make one only for local runs."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="boxloom-ckpt-")
    context.setCheckpointDir(shared)


#: With it, an action removes its shuffle files as soon as it has ended (Spark 4.1; no effect before).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing(spark: SparkSession):
    """Plans made inside, for one action that keeps its rows, take their shuffle files with them when that action ends.

    Spark would leave these until the driver collects its garbage, so the disk would hold those of all steps together.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Freeze `df` on reliable storage: cuts lineage, survives executor loss and frees the disk of the shuffles before it."""
    ensure_checkpoint_dir(df.sparkSession)
    with freeing(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Freeze a bulky `df` as compressed columns: as `checkpointed`, in a fraction of the disk, and later reads touch only the columns they need.

    The rows lie in the folder of an empty checkpoint that every plan over them names, so where Spark clears checkpoints
    that nothing refers to, it clears them too.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    none = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]).checkpoint(eager=True)
    folder = f"{none._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()}/rows"
    with freeing(spark):
        df.select("*").write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder).unionAll(none)


def stored_by(df: DataFrame, *columns: str) -> DataFrame:
    """Freeze `df` as a table in the shared folder, partitioned by `columns`, so that later reads touch only what they ask for."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/by-{uuid.uuid4().hex}"
    df.write.partitionBy(*columns).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def literal(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A small table written in code: kept in the plan, so its size is known to the optimizer."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [() for _ in kind.fields]
    arrow = to_arrow_schema(kind)
    arrays = [pa.array([_plain(v) for v in values], type=field.type) for values, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), kind)


def _plain(value):
    """Points given as (x, y) become the structs the schema names."""
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, tuple) and len(value) == 2:
        return {"x": value[0], "y": value[1]}
    return value
