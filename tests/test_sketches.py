"""Stored sketches: merged ones against exact answers, repeated runs, odd rows."""

import pytest
from pyspark.sql import functions as F

from boxloom.operators import sketches as sk

IMAGES = "dataset_id string, camera_id string, image_id long, frame_id long"
LOG = "image_id long, seconds double"


def releases(spark):
    """Three releases of 30,000 images that share 10,000 from one to the next, two cameras."""
    ids = spark.range(70_000).withColumn("r", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    ids = ids.filter((F.col("id") >= 20_000 * F.col("r")) & (F.col("id") < 20_000 * F.col("r") + 30_000))
    return ids.select(
        F.concat(F.lit("r"), "r").alias("dataset_id"), F.when(F.col("id") % 2 == 0, "front").otherwise("back").alias("camera_id"),
        F.col("id").alias("image_id"), F.floor(F.col("id") / 2).alias("frame_id"),
    )


def test_merged_releases_against_exact_counts(spark, tmp_path):
    images = releases(spark)
    log = spark.range(70_000).select(F.col("id").alias("image_id"), (F.col("id") % 1_000).cast("double").alias("seconds"))
    folder = str(tmp_path / "sketches")
    for name in ("r0", "r1", "r2", "r1"):  # the second run of r1 replaces the first
        sk.store_sketches(sk.audit_sketches(images.filter(F.col("dataset_id") == name), log), folder)
    stored = sk.stored_sketches(spark, folder)
    assert stored.count() == 6 and stored.agg(F.sum("rows")).first()[0] == 90_000
    got = {r.camera_id: r for r in sk.sketch_audit(sk.merge_sketches(stored, ("camera_id",))).collect()}
    for camera in ("front", "back"):
        assert got[camera].rows == 45_000 and got[camera].images == pytest.approx(35_000, rel=0.04)
        # frames are counted per data set, as in the exact audit
        assert got[camera].frames == pytest.approx(45_000, rel=0.04)
        assert 470 <= got[camera].seconds_50 <= 530 and 870 <= got[camera].seconds_90 <= 930
    total = sk.sketch_audit(sk.merge_sketches(stored)).first()
    assert total.rows == 90_000 and total.images == pytest.approx(70_000, rel=0.04)
    # below the size of the theta sample, set operations are exact
    over = {r.camera_id: (r.shared, r.added, r.dropped) for r in sk.release_overlap(stored, "r0", "r1").collect()}
    assert over == {"front": (5_000, 10_000, 10_000), "back": (5_000, 10_000, 10_000)}
    assert {(r.shared, r.added, r.dropped) for r in sk.release_overlap(stored, "r0", "r2").collect()} == {(0, 15_000, 15_000)}


def test_merging_order_does_not_matter(spark):
    images = releases(spark)
    log = spark.createDataFrame([(1, 2.0)], LOG)
    parts = sk.audit_sketches(images, log)
    whole = sk.audit_sketches(images.withColumn("dataset_id", F.lit("all")).distinct(), log)
    one, two = (sk.sketch_audit(sk.merge_sketches(x)).first() for x in (parts, whole))
    assert one.images == pytest.approx(two.images, rel=0.02) and one.seconds_50 == two.seconds_50 == 2.0


def test_nulls_repeated_rows_and_empty_tables(spark):
    rows = [("r", None, 1, 1), ("r", None, 1, 1), ("r", "front", None, None), (None, "front", 2, 2)]
    images = spark.createDataFrame(rows, IMAGES)
    log = spark.createDataFrame([(1, 3.0), (1, float("nan")), (None, 5.0), (2, None), (9, 1.0)], LOG)
    got = {(r.dataset_id, r.camera_id): r for r in sk.sketch_audit(sk.audit_sketches(images, log)).collect()}
    assert got["r", None].rows == 2 and got["r", None].images == 1 and got["r", None].seconds_50 == 3.0
    assert got["r", "front"].rows == 1 and not got["r", "front"].images and got["r", "front"].seconds_50 is None
    assert got[None, "front"].images == 1 and got[None, "front"].seconds_50 is None
    merged = sk.sketch_audit(sk.merge_sketches(sk.audit_sketches(images, log))).first()
    assert merged.rows == 4 and merged.images == 2 and merged.seconds_90 == 3.0
    assert sk.merge_sketches(sk.audit_sketches(images.limit(0), log), ("camera_id",)).count() == 0
    over = {r.camera_id: (r.shared, r.added, r.dropped) for r in sk.release_overlap(sk.audit_sketches(images, log), "r", "none").collect()}
    assert over == {None: (0, 0, 1), "front": (0, 0, 0)}


def test_overlap_of_large_releases_is_exact(spark, tmp_path):
    """200,000 and 90,000 images of a camera, beyond what one theta sketch holds, cut into 16 and 4 shares."""
    ids = spark.range(240_000).select(F.col("id").alias("image_id"), F.lit("front").alias("camera_id"))
    images = ids.filter("image_id < 200000").withColumn("dataset_id", F.lit("r0")).unionByName(ids.filter("image_id >= 150000").withColumn("dataset_id", F.lit("r1")))
    images = images.unionByName(images.filter("image_id % 3 = 0"))  # repeated rows count once
    folder = str(tmp_path / "shares")
    sk.store_sketches(sk.overlap_sketches(images), folder)
    stored = sk.stored_sketches(spark, folder)
    assert {(r.dataset_id, r.shares) for r in stored.select("dataset_id", "shares").distinct().collect()} == {("r0", 16), ("r1", 4)}
    got = [(r.camera_id, r.shared, r.added, r.dropped) for r in sk.release_overlap(stored, "r0", "r1").collect()]
    assert got == [("front", 50_000, 40_000, 150_000)]
    few = sk.overlap_sketches(images.withColumn("camera_id", F.lit(None).cast("string")), share_images=1_000)
    assert [tuple(r) for r in sk.release_overlap(few, "r0", "r1").collect()] == [(None, 50_000, 40_000, 150_000)]
    assert [tuple(r) for r in sk.release_overlap(few, "r0", "none").collect()] == [(None, 0, 0, 200_000)]
