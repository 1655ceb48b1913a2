"""Explicit schemas; nothing in the package infers one."""

from pyspark.sql import types as T

BOX = T.StructType([
    T.StructField("x1", T.DoubleType()),
    T.StructField("y1", T.DoubleType()),
    T.StructField("x2", T.DoubleType()),
    T.StructField("y2", T.DoubleType()),
    T.StructField("label", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("track_id", T.StringType()),
])

PREDICTIONS = T.StructType([
    T.StructField("image_id", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("boxes", T.ArrayType(BOX)),
])

MANIFEST = T.StructType([
    T.StructField("dataset_id", T.StringType()),
    T.StructField("image_id", T.StringType()),
    T.StructField("relative_path", T.StringType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("sequence_id", T.StringType()),
    T.StructField("frame_id", T.LongType()),
    T.StructField("capture_timestamp", T.TimestampType()),
    T.StructField("raw_sequence_index", T.LongType()),
    T.StructField("keyframe_id", T.StringType()),
    T.StructField("is_keyframe", T.BooleanType()),
    T.StructField("sync_delta_ms", T.DoubleType()),
    T.StructField("camera_id", T.StringType()),
    T.StructField("camera_order", T.IntegerType()),
    T.StructField("fold_id", T.IntegerType()),
    T.StructField("annotation_status", T.StringType()),
])

ANNOTATIONS = T.StructType([
    T.StructField("annotation_id", T.StringType()),
    T.StructField("image_id", T.StringType()),
    T.StructField("class_id", T.IntegerType()),
    T.StructField("x1", T.DoubleType()),
    T.StructField("y1", T.DoubleType()),
    T.StructField("x2", T.DoubleType()),
    T.StructField("y2", T.DoubleType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("occluded", T.BooleanType()),
    T.StructField("truncated", T.BooleanType()),
    T.StructField("source", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("review_status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

RELEASE = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "manifest_id", "manifest_sha256", "annotation_sha256", "taxonomy_version",
        "camera_policy_version", "split_version", "command", "git_commit", "report",
    )
])

# one rectangle of a review export or import
RESULT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("from_name", T.StringType()),
    T.StructField("to_name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("original_width", T.IntegerType()),
    T.StructField("original_height", T.IntegerType()),
    T.StructField("image_rotation", T.IntegerType()),
    T.StructField("value", T.StructType([
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("width", T.DoubleType()),
        T.StructField("height", T.DoubleType()),
        T.StructField("rotation", T.DoubleType()),
        T.StructField("rectanglelabels", T.ArrayType(T.StringType())),
    ])),
    T.StructField("score", T.DoubleType()),
])

REVIEW_TASK = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("data", T.StructType([
        T.StructField("image_id", T.StringType()),
        T.StructField("image", T.StringType()),
    ])),
    T.StructField("annotations", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("was_cancelled", T.BooleanType()),
        T.StructField("completed_by", T.StringType()),
        T.StructField("lead_time", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("result", T.ArrayType(RESULT)),
    ]))),
])

REVIEW_LOG = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("image_id", T.StringType()),
    T.StructField("annotator_id", T.StringType()),
    T.StructField("assisted", T.BooleanType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("event", T.StringType()),
])

COCO = T.StructType([
    T.StructField("images", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
    ]))),
    T.StructField("annotations", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("image_id", T.StringType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("area", T.DoubleType()),
        T.StructField("iscrowd", T.IntegerType()),
    ]))),
    T.StructField("categories", T.ArrayType(T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
    ]))),
])
