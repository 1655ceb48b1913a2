"""Append-once into buckets: right rows, and bytes compared by key."""

import os

from pyspark.sql import functions as F

from boxloom.sources import append


def size_of(df):
    return 0 if df is None else sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in df.inputFiles())


def batch_of(spark, number, rows=20):
    fresh = spark.range(number * rows, (number + 1) * rows)
    again = spark.range(max(0, number - 1) * rows, number * rows)  # retries of the batch before
    return fresh.union(again).select(F.sha2(F.col("id").cast("string"), 256).alias("row_hash"), "id").coalesce(1)


def test_bytes_compared_are_bound_by_keys_and_not_by_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append.compared(batch_of(spark, 0), path, ["row_hash"]) is None
    for number in range(10):
        append.append_bucketed(batch_of(spark, number), path, ["row_hash"], bucket_bytes=3_000)
    got = [r["id"] for r in spark.read.parquet(path).collect()]
    assert sorted(got) == list(range(200))
    levels = append.Layout(spark, path).numbers(append.LEVEL)
    assert len(levels) > 2
    # a single key is compared with one bucket of each level, however many rows the target has
    one = batch_of(spark, 7).limit(1)
    held = append.compared(one, path, ["row_hash"])
    assert size_of(held) <= 2 * 3_000 * len(levels) and len({f.rsplit("/", 1)[0] for f in held.inputFiles()}) <= len(levels)
    assert size_of(held) < size_of(spark.read.parquet(path)) / 3
    assert held.columns == ["row_hash"]


def test_nulls_repeats_and_replays(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", None), ("a", None), ("a", 2)], "k string, n int")
    for _ in range(3):
        append.append_bucketed(df, path, ["k", "n"])
    append.append_bucketed(df.limit(0), path, ["k", "n"])
    got = spark.read.parquet(path).select("k", "n").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1), ("a", None), ("a", 2)], key=str)


def test_an_empty_first_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    append.append_bucketed(df.limit(0), path, ["k"])
    append.append_bucketed(df, path, ["k"])
    assert spark.read.parquet(path).count() == 1


def test_a_large_first_batch_is_dealt_over_buckets(spark, tmp_path):
    """A batch larger than a bucket is cut before it is written, also where the target is new or was small."""
    path = str(tmp_path / "t")
    for number in range(2):
        batch = batch_of(spark, number, 20 if number else 2_000)
        append.append_bucketed(batch, path, ["row_hash"], bucket_bytes=10_000)
    folders = {}
    for file in spark.read.parquet(path).inputFiles():
        folder, name = file.removeprefix("file:").replace("///", "/").rsplit("/", 1)
        folders[folder] = folders.get(folder, 0) + spark.read.parquet(f"{folder}/{name}").count()
    assert max(folders.values()) < 300
    append.append_bucketed(batch_of(spark, 0, 2_000), path, ["row_hash"], bucket_bytes=10_000)
    got = [r["id"] for r in spark.read.parquet(path).collect()]
    assert sorted(got) == list(range(2_000))
