import random
import statistics

import pytest
from pyspark.sql import Window as W, functions as F

from boxloom.operators import manifest as m, release, review, scale
from boxloom.sources import readers


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(5)
    rows = [(k, t, rng.choice([None, t * 10])) for k in "ab" for t in sorted(rng.sample(range(300), 90))]
    return spark.createDataFrame(rows, "k string, t bigint, v bigint")


@pytest.mark.parametrize("width", [3, 50, 10_000])
def test_carry_equals_plain_windows(series, width):
    past, ahead = W.partitionBy("k").orderBy("t"), W.partitionBy("k").orderBy(F.col("t").desc())
    before = (W.unboundedPreceding, -1)
    want = series.select("k", "t", F.last("v", True).over(past.rowsBetween(*before)).alias("p"), F.last("v", True).over(ahead.rowsBetween(*before)).alias("n"))
    got = scale.carry(series, ["k"], "t", {"p": F.col("v")}, later={"n": F.col("v")}, width=width).select("k", "t", "p", "n")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("width", [3, 50, 10_000])
def test_running_sums(series, width):
    rows = series.fillna(1)
    plain = W.partitionBy("k").orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    want = rows.select("k", "t", F.sum("v").over(plain).alias("s"))
    got = scale.running_sum(rows, ["k"], "t", {"s": F.col("v")}, width=width).select("k", "t", "s")
    assert got.exceptAll(want).isEmpty()
    order = [F.col("t").asc()]
    cut = scale.part_running_sum(scale.range_parts(rows, ["k"], order), ["k"], order, {"s": F.col("v")}).select("k", "t", "s")
    assert cut.exceptAll(want).isEmpty() and cut.count() == want.count()


def test_quantile_and_rank_are_exact(spark):
    values = [3.0, 1.0, 1.0, 7.5, 2.0, 2.0, 2.0, 9.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 4.0)], "k string, v double")
    got = {r["k"]: r["q"] for r in scale.exact_quantile(df, ["k"], "v", 0.5, "q").collect()}
    assert got == {"a": statistics.median(values), "b": 4.0}
    want = df.select("v", F.percent_rank().over(W.orderBy("v")).alias("r"))
    assert scale.exact_percent_rank(df, "v", "r").select("v", "r").exceptAll(want).isEmpty()


def frames(spark, times, camera="front"):
    rows = [("d", f"{camera}{i}", i, camera, 0, t, i % 5 == 0, 1920, 1080) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "dataset_id string, image_id string, frame_id bigint, camera_id string, camera_order int, capture_us bigint, is_keyframe boolean, width int, height int")


def test_gap_of_exactly_one_second_stays_together(spark):
    got = m.assign_sequences(frames(spark, [0, 1_000_000, 2_000_001, 2_100_000])).orderBy("frame_id").collect()
    assert [r["sequence_id"] for r in got] == ["s00", "s00", "s01", "s01"]


def test_sequences_across_bucket_edges(spark):
    times = [i * 100_000 + (i // 7) * 5_000_000 for i in range(60)]
    a = m.assign_sequences(frames(spark, times), width=1_000_000).select("image_id", "sequence_id")
    b = m.assign_sequences(frames(spark, times)).select("image_id", "sequence_id")
    assert a.exceptAll(b).isEmpty() and b.select("sequence_id").distinct().count() == 9


def test_stretch_without_keyframes_is_reported(spark):
    images = frames(spark, [0, 100_000, 9_000_000, 9_100_000])  # only frame 0 is a keyframe
    got = {r["frame_id"]: (r["sequence_id"], r["cut_ok"]) for r in m.inherit_sequence(images, m.keyframe_sequences(images)).collect()}
    assert got == {0: ("s00", True), 1: ("s00", True), 2: (None, False), 3: (None, False)}


def test_context_tie_goes_to_the_earlier_keyframe(spark):
    got = {r["frame_id"]: (r["keyframe_image_id"], r["sync_delta_ms"]) for r in m.match_context(frames(spark, [0, 250, 500, 700, 900, 1000])).collect()}
    assert got == {1: ("front0", 0.25), 2: ("front0", 0.5), 3: ("front5", 0.3), 4: ("front5", 0.1)}


def test_segments_name_their_reason(spark):
    images = m.assign_sequences(frames(spark, [0, 100_000, 200_000, 300_000, 5_000_000]))
    images = images.filter("frame_id <> 2")
    cuts = spark.createDataFrame([("front1",)], "image_id string")
    got = [(r["frame_id"], r["reset_reason"], r["segment_id"]) for r in m.continuity_segments(images, cuts).orderBy("frame_id").collect()]
    assert got == [(0, "start", 0), (1, "scene_cut", 1), (3, "missing_context", 2), (4, "sequence", 3)]


def test_release_gate(spark):
    six = None
    for order, (_, name, *_) in enumerate(readers.CAMERAS):
        one = frames(spark, [0, 100_000], name).withColumn("camera_order", F.lit(order))
        six = one if six is None else six.unionByName(one)
    names = [name for _, name, *_ in readers.CAMERAS]
    none = spark.createDataFrame([], "annotation_id bigint, image_id string, class_id int")
    assert m.release_gate(m.validate_release(six, none, names)).count() == 0
    broken = six.filter("image_id <> 'back0'").unionByName(six.filter("image_id = 'front1'"))
    with pytest.raises(ValueError, match="missing_camera"):
        m.release_gate(m.validate_release(broken, none, names))


def test_content_hash_ignores_order_and_parts(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("v"))
    first = release.content_hash(df).first()
    assert first == release.content_hash(df.orderBy(F.col("id").desc()).repartition(7)).first()
    assert first["rows"] == 500
    assert first["content_hash"] != release.content_hash(df.unionByName(df.limit(1))).first()["content_hash"]


def test_review_round_trip_states(spark):
    box = "image_id string, result_id string, class_id int, x1 double, y1 double, x2 double, y2 double"
    b = (0, 10.0, 10.0, 50.0, 50.0)
    pred = spark.createDataFrame([(f"i{n}", f"r{n}", *b) for n in (2, 3, 4, 6, 8, 9)], box)
    sent = spark.createDataFrame([
        ("i3", "r3", 0, 10.4, 10.0, 50.0, 50.0), ("i4", "r4", 1, 10.0, 10.0, 80.0, 50.0), ("i5", None, *b), ("i9", "r9", 0, 20.0, 10.0, 50.0, 50.0),
    ], box)
    outcome = {"i2": "displayed", "i8": "skipped"}
    tasks = spark.createDataFrame([(f"i{n}", outcome.get(f"i{n}", "submitted")) for n in range(2, 10)], "image_id string, outcome string")
    states = {r["image_id"]: r["review_status"] for r in review.map_review_state(review.review_diff(pred, sent), tasks).collect()}
    assert states == {
        "i2": "unreviewed_prediction", "i3": "human_verified", "i4": "human_modified", "i5": "human_created", "i6": "rejected_prediction",
        "i8": "unreviewed_prediction", "i9": "human_modified",
    }
    images = {r["image_id"]: r["annotation_status"] for r in review.image_status(tasks, sent).collect()}
    assert images["i7"] == images["i6"] == "verified_empty" and images["i8"] == images["i2"] == "unreviewed" and images["i3"] == "reviewed"
    assert spark.range(1).select(review.event_state(F.lit("skipped"))).first()[0] is None


def test_crossover_halves(spark):
    tasks = spark.createDataFrame([(a, i) for a, n in ((1, 7), (2, 10)) for i in range(n)], "annotator_id int, image_id int")
    got = {(r["annotator_id"], r["arm"]): r["count"] for r in review.crossover(tasks, "s").groupBy("annotator_id", "arm").count().collect()}
    assert got == {(1, "manual_first"): 4, (1, "assisted_first"): 3, (2, "manual_first"): 5, (2, "assisted_first"): 5}


def test_missing_images_of_many_cameras(spark):
    stems = spark.createDataFrame([("s1",)], "stem string")
    cameras = spark.createDataFrame([(f"c{i}",) for i in range(1200)], "camera_id string")
    images = spark.createDataFrame([("s1", "c7")], "stem string, camera_id string")
    assert m.missing_images(stems, cameras, images).count() == 1199


def test_sequences_in_the_order_of_their_numbers(spark):
    rows = [(f"s{i:02d}", 0, 0, i) for i in (100, 99, 2, 10)]
    df = spark.createDataFrame(rows, "sequence_id string, frame_id bigint, camera_order int, image_id bigint")
    assert [r["image_id"] for r in m.canonical_order(df).collect()] == [2, 10, 99, 100]


def test_sign_hash_reads_every_component(spark):
    from boxloom.functions.scalars import sign_hash

    a = [0.0] * 64 + [1.0] * 192
    df = spark.createDataFrame([(1, a), (2, [-x for x in a]), (3, a)], "id int, v array<double>")
    h = {r["id"]: r["h"] for r in df.select("id", sign_hash("v").alias("h")).collect()}
    assert h[1] == h[3] and h[1] != h[2] and bin(h[1] & (2**64 - 1)).count("1") > 10


def test_folds_are_expanded_whole(spark):
    """Data sets with folds of their own, groups without a fold or an id, images of a group more than once."""
    schema = "dataset_id string, frame_id bigint, sequence_id string, fold_id int"
    rows = [(d, f, f"s{f // 10}", f // 10) for d, n in (("a", 150), ("b", 40)) for f in range(n) for _ in range(2)]
    images = spark.createDataFrame([*rows, ("a", 900, None, None), ("a", None, "s3", 3), (None, 1, "s0", 0), ("c", 1, "s0", 0)], schema)
    folds = images.filter("dataset_id <> 'c' AND (dataset_id = 'a' OR fold_id > 1)")
    want = images.distinct().alias("i").join(folds.selectExpr("dataset_id", "fold_id AS fold").distinct(), ["dataset_id"]).selectExpr(
        "dataset_id", "frame_id", "sequence_id", "fold", "CASE WHEN fold_id = fold THEN 'validation' ELSE 'train' END AS side",
    )
    got = m.expand_folds(images, folds)
    assert got.columns == want.columns and got.count() == 152 * 16 + 40 * 2
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert m.expand_folds(images, folds.limit(0)).isEmpty() and m.expand_folds(images.limit(0), folds).isEmpty()


def test_many_folds_are_written_small_and_by_several_tasks(spark, tmp_path):
    """Rows are groups times folds: what a file takes for a row must not grow with the folds, nor may one task write them all."""
    groups = spark.range(200).selectExpr("'d0' AS dataset_id", "id AS frame_id", "'s00' AS sequence_id", "CAST(id AS int) AS fold_id")
    folds = spark.range(20_000).selectExpr("'d0' AS dataset_id", "CAST(id AS int) AS fold_id")
    m.expand_folds(groups, folds).select("frame_id", "fold", "side").write.parquet(str(tmp_path / "sides"))
    files = list((tmp_path / "sides").glob("*.parquet"))
    assert len(files) > 1 and sum(f.stat().st_size for f in files) < 4_000_000 * 0.5
    back = spark.read.parquet(str(tmp_path / "sides"))
    assert back.distinct().count() == 4_000_000 and back.filter("side = 'validation' AND frame_id = fold").count() == 200 == back.filter("side = 'validation'").count()
