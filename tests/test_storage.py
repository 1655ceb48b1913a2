"""What steps leave on disk: frozen tables are compressed, and shuffles go with the step that made them."""

import glob
import random

from pyspark.sql import functions as F

from boxloom.operators import metrics, similarity
from boxloom.session import SHUFFLE_CLEANUP, checkpointed, stored
from boxloom.sources import readers, writers


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(k).getPath() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}


def test_shuffles_go_with_the_step_that_made_them(spark):
    rows = spark.range(20_000).groupBy(F.xxhash64("id").alias("k")).agg(F.max("id").alias("v"))
    before, set_before = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    for freeze in (checkpointed, stored):
        kept = freeze(rows)
        assert kept.agg(F.sum("v")).first()[0] == sum(range(20_000))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == set_before
    left = [p for p in shuffle_files(spark) - before if p.endswith(".data")]
    size = sum(len(open(p, "rb").read()) for p in left)
    assert size < 50_000  # the sums, and not the 20,000 groups of both steps


def test_stored_rows_keep_values_types_and_columns(spark):
    schema = "id bigint, t string, a array<double>, s struct<x:double,l:array<string>>, ok boolean"
    rows = [(1, "a", [1.0, None], (0.5, ["q", None]), True), (None, None, None, None, None), (1, "a", [1.0, None], (0.5, ["q", None]), True)]
    df = spark.createDataFrame(rows, schema)
    kept = stored(df)
    assert kept.schema == df.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    assert stored(df.limit(0)).count() == 0


def test_envelope_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(metrics, "ENVELOPE_WIDTH", 3)
    rng = random.Random(4)
    rows = [(c, k, rng.random(), k / 40) for c in (1, 2, None) for k in range(40) for _ in range(rng.randrange(1, 4))]
    got = metrics.precision_envelope(spark.createDataFrame(rows, "class_id int, cum_tp long, precision double, recall double"), ["class_id"])
    want = {(c, k): max(p for d, n, p, _ in rows if d == c and n >= k) for c in (1, 2) for k in range(40)}
    assert {(r["class_id"], r["cum_tp"]): r["envelope"] for r in got.filter("class_id is not null").collect()} == want


def test_embedding_pairs_in_turns(spark, monkeypatch):
    """Where a row has many copies, they are dealt in turns; all pairs are found, each once."""
    rng = random.Random(3)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(30)]
    rows = [(5 * k + c, [x + 0.05 * c * rng.gauss(0, 1) for x in v]) for k, v in enumerate(base) for c in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    want = sorted((i, j) for i, a in rows for j, b in rows if i < j and cosine(a, b) >= 0.9)
    turns = []
    monkeypatch.setattr(similarity, "COPIES", 4)
    monkeypatch.setattr(similarity, "stored", lambda df: turns.append(1) or stored(df))
    for hot in (16, 2):  # blocks of all rows, then tables
        assert sorted((r["id_a"], r["id_b"]) for r in similarity.embedding_pairs(df, 0.9, hot=hot).collect()) == want
        assert len(turns) > 1
        turns.clear()


def test_exports_can_be_compressed(spark, boxes, tmp_path):
    flat = boxes([(k, f"i{k}", 0, 0.0, 0.0, 10.0, 10.0 + k, 0.5) for k in range(5)]).selectExpr(
        "image_id", "width", "height", "'m' AS model_version", "det_id AS box_no", "x1", "y1", "x2", "y2", "'Car' AS label", "score", "CAST(NULL AS string) AS track_id")
    nested = readers.nest_predictions(flat)
    for name, extra in (("plain", {}), ("small", {"compression": "gzip"})):
        writers.write_review_tasks(nested, f"{tmp_path}/{name}", **extra)
    assert glob.glob(f"{tmp_path}/small/*.json.gz") and not glob.glob(f"{tmp_path}/plain/*.gz")
    plain, small = (sorted(spark.read.text(f"{tmp_path}/{n}").collect()) for n in ("plain", "small"))
    assert plain == small and len(small) == 5
