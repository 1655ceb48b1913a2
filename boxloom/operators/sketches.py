"""Audits that add up: sketches kept per release and camera, merged over releases without reading rows again.

Distinct images and frames are HyperLogLog sketches, the set of images a theta sketch (so that releases can be
compared), review seconds a KLL quantile sketch. All are built by aggregates combined before the shuffle, and one
release is a few rows, whatever its size. `overlap_sketches` cuts the set of images into shares so small that their theta
sketches hold every image: comparing those is exact, for some bytes an image.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxloom.operators.scale import join_small

KEYS = ("dataset_id", "camera_id")
#: log2 of the registers of HyperLogLog (standard error 0.8 %), log2 of the theta sample (0.4 %), and the KLL size (rank error 0.7 %).
LG_HLL, LG_THETA, K_KLL = 14, 16, 400
#: Shares that quantile sketches of a key are first merged in.
FAN = 256
#: Images that a share of `overlap_sketches` holds on average: half of what a theta sketch keeps exactly.
SHARE_IMAGES = 1 << (LG_THETA - 1)


def audit_sketches(images: DataFrame, log: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per `keys` (columns of `images`): rows, image_hll, frame_hll, image_theta, second_kll.

    Null ids and null or non-finite seconds are not counted; a review event counts once for each key its image has, and not at
    all without an image. A key without any value has a null sketch. Null keys are a key of their own.
    """
    frame = F.when(F.col("frame_id").isNotNull(), F.to_json(F.struct("dataset_id", "frame_id")))
    left = images.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg(F.col("image_id").cast("string"), F.lit(LG_HLL)).alias("image_hll"),
        F.hll_sketch_agg(frame, F.lit(LG_HLL)).alias("frame_hll"),
        F.theta_sketch_agg(F.col("image_id").cast("string"), LG_THETA).alias("image_theta"),
    )
    seconds = F.col("seconds").cast("double")
    timed = log.select("image_id", seconds.alias("_seconds")).filter(F.col("_seconds").isNotNull() & ~F.isnan("_seconds") & (F.abs("_seconds") < float("inf")))
    # an event meets each key of its image once, also where the image is listed twice
    timed = timed.join(images.select("image_id", *[F.col(k).alias(f"_k_{k}") for k in keys]).distinct(), "image_id")
    right = timed.groupBy(*[f"_k_{k}" for k in keys]).agg(F.kll_sketch_agg_double("_seconds", K_KLL).alias("second_kll"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(right, same, "left").drop(*[f"_k_{k}" for k in keys])


def store_sketches(sketches: DataFrame, folder: str, release: str = "dataset_id") -> None:
    """Write the rows of one or more releases; those of a release that is already there are replaced, so a run can be repeated."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(release).parquet(folder)


def stored_sketches(spark: SparkSession, folder: str, release: str = "dataset_id") -> DataFrame:
    """All stored sketches; the release stays text, whatever it looks like."""
    plain = spark.read.parquet(folder)
    kinds = [f"`{f.name}` {'string' if f.name == release else f.dataType.simpleString()}" for f in plain.schema.fields]
    return spark.read.schema(", ".join(kinds)).parquet(folder)


def _merged_kll(sketches: Column) -> Column:
    return F.aggregate(
        F.slice(sketches, 2, F.greatest(F.size(sketches), F.lit(1))), F.get(sketches, F.lit(0)), lambda x, y: F.kll_sketch_merge_double(x, y)
    )


def merge_sketches(sketches: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sketches of the union of all rows of each `keys` (none: of everything); `rows` are added."""
    share = F.pmod(F.xxhash64("image_hll", "second_kll"), F.lit(FAN)).alias("_share")
    part = sketches.groupBy(*keys, share)
    for last in (False, True):
        part = part.agg(
            F.sum("rows").alias("rows"),
            F.hll_union_agg("image_hll").alias("image_hll"),
            F.hll_union_agg("frame_hll").alias("frame_hll"),
            F.theta_union_agg("image_theta", LG_THETA).alias("image_theta"),
            _merged_kll(F.collect_list("second_kll")).alias("second_kll"),
        )
        part = part if last else part.groupBy(*keys)
    return part


def sketch_audit(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """The estimates in place of the sketches: rows, images, frames, seconds_<percent>."""
    kept = [c for c in sketches.columns if c not in ("image_hll", "frame_hll", "image_theta", "second_kll")]
    return sketches.select(
        *kept,
        F.hll_sketch_estimate("image_hll").alias("images"),
        F.hll_sketch_estimate("frame_hll").alias("frames"),
        *[F.kll_sketch_get_quantile_double("second_kll", F.lit(q)).alias(f"seconds_{round(100 * q)}") for q in quantiles],
    )


def overlap_sketches(images: DataFrame, keys: tuple[str, ...] = KEYS, share_images: int = SHARE_IMAGES) -> DataFrame:
    """Rows (keys, shares, share, image_theta) for an exact `release_overlap`.

    The images of each key are dealt by hash to a power of two of shares, as many as keep a share at `share_images` on average.
    """
    ident = F.col("image_id").cast("string")
    wanted = F.greatest(F.lit(0.0), F.ceil(F.log2(F.greatest(F.count(F.lit(1)), F.lit(1)) / F.lit(share_images))))
    sizes = images.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.pow(F.lit(2.0), wanted).cast("long").alias("shares"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    rows = join_small(images, sizes, same).withColumn("share", F.pmod(F.xxhash64(ident), F.col("shares")))
    return rows.groupBy(*keys, "shares", "share").agg(F.theta_sketch_agg(ident, LG_THETA).alias("image_theta"))


def release_overlap(sketches: DataFrame, before: str, after: str, keys: tuple[str, ...] = ("camera_id",), release: str = "dataset_id") -> DataFrame:
    """Images that two releases share, that the later one adds and that it drops, per `keys`, from stored sketches alone.

    A key that one release lacks shares nothing. Rows of `overlap_sketches` give exact numbers at any size, since shares of
    a few images are compared with the share of the other release that holds them; rows of `audit_sketches` give
    estimates where a key has more than 65,536 images.
    """
    if "share" not in sketches.columns:
        sketches = sketches.withColumns({"shares": F.lit(1).cast("long"), "share": F.lit(0).cast("long")})
    own = sketches.select(F.col(release).alias("_release"), *[F.col(k).alias(f"_{k}") for k in keys], "shares", "share", "image_theta")
    names = [f"_{k}" for k in keys]
    # rows of a key that were stored apart meet at the coarsest cut that any of them has, within a release
    cut = own.groupBy("_release", *names).agg(F.min("shares").alias("_cut"))

    def matching(a: DataFrame, b: DataFrame, on: list[str]) -> Column:
        every = F.lit(True)
        for n in on:
            every = every & a[n].eqNullSafe(b[f"{n}_"])
        return every

    cut = cut.select(*[F.col(n).alias(f"{n}_") for n in ("_release", *names)], "_cut")
    own = own.join(cut, matching(own, cut, ["_release", *names])).withColumn("share", F.pmod("share", F.col("_cut")))
    own = own.groupBy("_release", *names, F.col("_cut").alias("shares"), "share").agg(F.theta_union_agg("image_theta", LG_THETA).alias("theta"))
    sides = [own.filter(F.col("_release") == name).drop("_release") for name in (before, after)]

    def size(sketch) -> Column:
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")

    totals = [side.groupBy(*names).agg(F.sum(size("theta")).alias(end)) for side, end in zip(sides, ("_a", "_b"))]
    other = sides[1].select(*[F.col(n).alias(f"{n}_") for n in names], F.col("shares").alias("_shares"), F.col("share").alias("_share"), F.col("theta").alias("_theta"))
    fewer = F.least("shares", "_shares")
    met = sides[0].join(other, matching(sides[0], other, names) & (F.pmod("share", fewer) == F.pmod("_share", fewer)))
    both = met.groupBy(*names).agg(F.sum(size(F.theta_intersection("theta", "_theta"))).alias("shared"))
    rows = totals[0]
    for right in (totals[1], both):
        right = right.withColumnsRenamed({n: f"{n}_" for n in names})
        rows = rows.join(right, matching(rows, right, names), "full")
        rows = rows.withColumns({n: F.coalesce(n, f"{n}_") for n in names}).drop(*[f"{n}_" for n in names])
    a, b, shared = (F.coalesce(c, F.lit(0)) for c in ("_a", "_b", "shared"))
    return rows.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], shared.alias("shared"), (b - shared).alias("added"), (a - shared).alias("dropped"))
