"""Release hashing and records."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from boxloom.functions.scalars import canonical_json
from boxloom.schemas import RELEASE

LEVELS = (6, 3, 0)


def row_hashes(df: DataFrame) -> DataFrame:
    """(hash, n) of every distinct row, columns in name order."""
    text = canonical_json(*[F.col(c) for c in sorted(df.columns)])
    return df.select(F.sha2(text, 256).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))


def content_hash(df: DataFrame) -> DataFrame:
    """One row: a hash of the content, free of row order, partitioning and file names.

    Equal rows are counted first; then hashes are folded by prefix in three fixed levels, so no
    step puts more than a small slice of the hashes in one string.
    """
    rows = row_hashes(df)
    entry = F.concat_ws(":", "hash", F.col("n").cast("string"))
    level = rows.select(F.col("hash").alias("key"), entry.alias("entry"), "n")
    for digits in LEVELS:
        level = level.groupBy(F.substring("key", 1, digits).alias("key")).agg(
            F.array_join(F.array_sort(F.collect_list("entry")), ";").alias("_text"), F.sum("n").alias("n"),
        )
        level = level.select("key", F.sha2("_text", 256).alias("_h"), "n")
        level = level.select("key", F.concat_ws(":", "key", "_h").alias("entry"), F.col("_h").alias("hash"), "n")
    return level.select(F.col("hash").alias("content_hash"), F.col("n").alias("rows"))


def release_record(
    spark: SparkSession, manifest: DataFrame, annotations: DataFrame, *, taxonomy_version: str, camera_policy_version: str,
    split_version: str, command: str, git_commit: str, report: dict,
) -> DataFrame:
    """One row with the hashes and versions of everything that went into a release."""
    m, a = content_hash(manifest).first()[0], content_hash(annotations).first()[0]
    row = (m[:16], m, a, taxonomy_version, camera_policy_version, split_version, command, git_commit, json.dumps(report, sort_keys=True))
    return spark.createDataFrame([row], RELEASE)


def gold_manifest(sample: DataFrame, images: DataFrame, release_id: str) -> DataFrame:
    """Gold rows without images: ids, checksums, reasons, state, release."""
    rows = sample.join(images.select("image_id", "sha256", F.col("annotation_status").alias("review_state")), "image_id")
    return rows.select("image_id", "sha256", "sampling_reason", "review_state", F.lit(release_id).alias("dataset_release_id"))
