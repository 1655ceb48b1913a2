"""What is broadcast has been measured."""

import re

from pyspark.sql import functions as F

from boxloom.operators.scale import fits_broadcast, join_small


def test_rows_and_bytes_are_measured(spark):
    ids = spark.range(100)
    assert fits_broadcast(ids) and fits_broadcast(ids, 100) and not fits_broadcast(ids, 99) and fits_broadcast(ids.limit(0))
    wide = ids.select("id", F.array_repeat(F.lit(0.5), 1_000).alias("xs"))
    assert fits_broadcast(wide, max_text=1_000_000) and not fits_broadcast(wide, max_text=100_000)
    odd = spark.sql("SELECT 1 AS `a.b`, CAST(NULL AS array<struct<x: double>>) AS v, map('k', 1) AS m, X'00' AS z UNION ALL SELECT NULL, NULL, NULL, NULL")
    assert fits_broadcast(odd)


def test_join_is_the_same_either_way(spark):
    ids = spark.range(1_000)
    few = spark.range(10).withColumn("name", F.repeat(F.lit("x"), 3))
    near, far = (join_small(ids, few, ["id"], "left", n) for n in (10, 9))
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()
    assert sorted(near.collect(), key=lambda r: r.id) == sorted(far.collect(), key=lambda r: r.id)


def test_curve_rows_are_not_dealt_by_class(spark, request):
    """A class may hold nearly all predictions: its rows meet the truth counts without a shuffle by class."""
    from boxloom.operators import metrics as mt

    # as where Spark does not know that the counts are few
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    rows = spark.range(2_000).selectExpr("1 AS class_id", "id AS det_id", "id / 2000 AS score", "array_repeat(id % 3 > 0, 10) AS tp")
    curve = mt.pr_curve(rows.selectExpr("class_id", "det_id", "CAST(score AS DOUBLE) AS score", "tp"), spark.createDataFrame([(1, 1_500)], "class_id int, n_truth bigint"))
    assert curve.agg({"recall": "max"}).first()[0] == 1_333 / 1_500
    plan = curve._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [class_id#" in plan and not re.search(r"SortMergeJoin \[class_id#\d+\]", plan)
