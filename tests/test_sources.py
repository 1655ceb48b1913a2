import json
import struct

import pytest
from pyspark.sql import functions as F

from boxloom import schemas
from boxloom.functions.user import predict_images
from boxloom.operators import checks, release
from boxloom.sources import readers, writers


def png(w, h):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", w, h) + b"\x08\x02\x00\x00\x00"


def jpeg(w, h, filler=0):
    extra = b"".join(b"\xff\xe2" + struct.pack(">H", 60_002) + b"\xff" * 60_000 for _ in range(filler))
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, h, w, 3) + b"\x00" * 9
    return b"\xff\xd8\xff\xe0" + struct.pack(">H", 16) + b"JFIF\x00" + b"\x00" * 9 + extra + b"\xff\xff" + frame + b"\xff\xda\x00\x02\xff\xd9"


def test_image_scan(spark, tmp_path):
    for camera, name, data in (("front", "20260611_165130_934602.jpg", jpeg(1920, 1080)), ("back", "20260611_165130_934602.jpg", jpeg(640, 480, 30)),
                               ("back", "20260611_165131_934602.png", png(300, 200)), ("back", "broken.jpg", b"\xff\xd8\xff\xe0"), ("back", "text.txt", b"no")):
        (tmp_path / camera).mkdir(exist_ok=True)
        (tmp_path / camera / name).write_bytes(data)
    rows = readers.scan_images(spark, str(tmp_path), dataset_id="d").collect()
    got = {(r["camera_id"], r["stem"]): (r["width"], r["height"]) for r in rows}
    assert got == {("front", "20260611_165130_934602"): (1920, 1080), ("back", "20260611_165130_934602"): (640, 480),
                   ("back", "20260611_165131_934602"): (300, 200), ("back", "broken"): (None, None)}
    assert len({r["sha256"] for r in rows}) == 4 and all(len(r["image_id"]) == 64 for r in rows)


def test_label_stems_read_no_content(spark, tmp_path):
    for stem in ("a", "b"):
        (tmp_path / f"{stem}.json").write_text("{")
    stems = readers.scan_label_stems(spark, str(tmp_path))
    assert {r["stem"] for r in stems.collect()} == {"a", "b"}
    assert "ReadSchema: struct<path:string>" in stems._jdf.queryExecution().executedPlan().toString()


def task(number, image, results, cancelled=False):
    value = {"x": 10.0, "y": 10.0, "width": 40.0, "height": 40.0, "rotation": 0, "rectanglelabels": ["Truck"]}
    result = [{"id": r, "from_name": "label", "to_name": "image", "type": "rectanglelabels", "original_width": 1920, "original_height": 1080, "image_rotation": 0, "value": value} for r in results]
    return {"id": number, "data": {"image_id": image}, "annotations": [{"id": number, "was_cancelled": cancelled, "completed_by": "u", "lead_time": 2.5, "result": result}]}


@pytest.mark.parametrize("array_file", [True, False])
def test_review_export(spark, tmp_path, array_file):
    tasks = [task(2, "b", ["r1", "r2"]), task(1, "a", [])]
    text = json.dumps(tasks) if array_file else "\n".join(map(json.dumps, tasks)) + "\nnot json"
    (tmp_path / "export.json").write_text(text)
    rows = readers.read_review_export(spark, str(tmp_path), array_file).collect()
    boxes = [r for r in rows if r["result_id"]]
    assert {(r["image_id"], r["x1"], r["x2"], r["label"]) for r in boxes} == {("b", 192.0, 960.0, "Truck")} and len(boxes) == 2
    assert [r["image_id"] for r in rows if r["result_id"] is None and r["image_id"]] == ["a"]
    assert array_file or [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == ["not json"]


def small_set(spark):
    images = spark.createDataFrame([(f"i{n}", "s00", n, f"front/{n}.jpg", 1920, 1080) for n in range(5)],
                                   "image_id string, sequence_id string, frame_id bigint, relative_path string, width int, height int")
    boxes = spark.createDataFrame([(n, f"i{n % 2}", n % 6, 1.0, 2.0, 11.0 + n, 22.0) for n in range(40)],
                                  "annotation_id bigint, image_id string, class_id int, x1 double, y1 double, x2 double, y2 double")
    return images, boxes


@pytest.mark.parametrize("limit", [50_000, 7])
def test_coco_round_trip(spark, tmp_path, limit):
    images, boxes = small_set(spark)
    docs = writers.coco_documents(images, boxes, frames_per_shard=2, boxes_per_shard=limit)
    named = [i["id"] for row in docs.collect() for i in json.loads(row["value"])["images"]]
    assert sorted(named) == [f"i{n}" for n in range(5)]  # every image in one document
    for i, row in enumerate(docs.collect()):
        (tmp_path / f"{i}.json").write_text(row["value"])
    back = readers.read_coco(spark, str(tmp_path))
    want = boxes.withColumn("annotation_id", F.col("annotation_id").cast("string"))
    assert back.select(*want.columns).exceptAll(want).isEmpty() and back.count() == 40
    assert {r["label"] for r in back.filter("class_id = 4").collect()} == {"WaterTruck"}
    writers.write_coco(images, boxes, str(tmp_path / "out"), boxes_per_shard=limit)
    with pytest.raises(Exception, match="(?i)already.exists"):
        writers.write_coco(images, boxes, str(tmp_path / "out"))


def test_manifest_is_byte_stable(spark, tmp_path):
    images = small_set(spark)[0].withColumns({"dataset_id": F.lit("d"), "camera_order": F.lit(0)})
    hashes = [writers.write_manifest(df, str(tmp_path / name)) for name, df in (("a", images), ("b", images.repartition(3)))]
    texts = [sorted(spark.read.text(str(tmp_path / name)).collect()) for name in "ab"]
    assert hashes[0] == hashes[1] and texts[0] == texts[1]


def test_append_once_and_resume(spark, tmp_path):
    df = spark.createDataFrame([(1, "m"), (1, "m"), (2, "m")], "image_id int, model_version string")
    for _ in range(2):
        writers.append_once(df, str(tmp_path / "t"), ["image_id", "model_version"])
    done = spark.read.parquet(str(tmp_path / "t"))
    assert done.count() == 2
    more = spark.createDataFrame([(2, "m"), (3, "m")], df.schema)
    assert [r["image_id"] for r in writers.pending(more, done, ["image_id", "model_version"]).collect()] == [3]


def test_review_tasks_file(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"image_id": "a", "width": 1920, "height": 1080, "model_version": "m",
        "boxes": [{"x1": 192, "y1": 108, "x2": 960, "y2": 540, "label": "Truck", "score": 0.9}]}) + "\n" + json.dumps({"image_id": "b", "width": 10, "height": 10, "model_version": "m"}))
    predictions = checks.validate_predictions(readers.read_predictions(spark, str(tmp_path / "p.json")))
    writers.write_review_tasks(checks.split_valid(predictions)[0], str(tmp_path / "tasks"))
    rows = {}
    for line in spark.read.text(str(tmp_path / "tasks")).collect():
        item = json.loads(line[0])
        rows[item["data"]["image_id"]] = item["predictions"][0]
    assert rows["a"]["model_version"] == "m" and rows["a"]["result"][0]["value"]["x"] == 10.0 and rows["b"]["result"] == []
    flat = readers.flatten_predictions(predictions.drop("reasons", "ok"))
    assert {(r["image_id"], r["label"]) for r in flat.collect()} == {("a", "Truck"), ("b", None)}


def test_policy_file(spark, tmp_path):
    (tmp_path / "policy.yaml").write_text("classes: [Car, Pedestrian]\ncameras:\n  - camera_id: front\n    camera_order: 0\n    width: 1920\n    height: 1080\n    rotation: 0\n    ignore_polygons: [[[0, 0], [10, 0], [0, 10]]]\n")
    policy = readers.load_policy(spark, str(tmp_path / "policy.yaml"))
    assert [(r["name"], r["class_id"], r["active"]) for r in policy["classes"].collect()] == [("Car", 0, True), ("Pedestrian", None, False)]
    assert policy["cameras"].first()["ignore_polygons"][0][1]["x"] == 10.0 and policy["thresholds"].isEmpty()


def test_release_record(spark, tmp_path):
    images, boxes = small_set(spark)
    record = release.release_record(spark, images, boxes, taxonomy_version="1", camera_policy_version="1", split_version="1", command="x", git_commit="y", report={"n": 1})
    writers.write_record(record, str(tmp_path / "r"))
    assert record.schema == schemas.RELEASE and len(record.first()["manifest_sha256"]) == 64


def test_predictor_failures_are_rows(spark):
    class Broken:
        model_version = "b1"

        def predict(self, image_path):
            if "bad" in image_path:
                raise RuntimeError("no file")
            return {"width": 4, "height": 3, "boxes": []}

    images = spark.createDataFrame([("a", "ok.jpg"), ("b", "bad.jpg")], "image_id string, relative_path string")
    got = {r["image_id"]: (r["width"], r["error"]) for r in predict_images(images, Broken).collect()}
    assert got == {"a": (4, None), "b": (None, "RuntimeError: no file")}


def test_image_size_behind_many_markers(spark):
    head = bytes.fromhex("FFD8") + b"\xff\xfe\x00\x02" * 3_000 + b"\xff" * 50
    frame = bytes.fromhex("FFC0001108") + (1080).to_bytes(2, "big") + (1920).to_bytes(2, "big") + b"\x03" + b"\x00" * 20
    df = spark.createDataFrame([(1, bytearray(head + frame)), (2, bytearray(head)), (3, bytearray(b""))], "id int, content binary")
    got = {r["id"]: (r["width"], r["height"]) for r in readers.image_dims(df).collect()}
    assert got == {1: (1920, 1080), 2: (None, None), 3: (None, None)}


def test_documents_of_a_sequence_lie_in_few_files(spark, tmp_path):
    images = spark.range(160).select(
        F.concat(F.lit("i"), "id").alias("image_id"), F.format_string("s%02d", F.floor(F.col("id") / 8)).alias("sequence_id"), F.col("id").alias("frame_id"),
        F.lit("a.jpg").alias("relative_path"), F.lit(1920).alias("width"), F.lit(1080).alias("height"),
    )
    boxes = images.select(F.col("frame_id").alias("annotation_id"), "image_id", F.lit(1).alias("class_id"), *[F.lit(v).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), (1.0, 2.0, 11.0, 22.0))])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_coco(images, boxes, str(tmp_path / "out"), frames_per_shard=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.text(str(tmp_path / "out")).count() == 160
    assert len(list((tmp_path / "out").glob("*/part*"))) < 2 * 20
