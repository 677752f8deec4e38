"""Copies written out in bounded pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from roostline.operators.copies import expand_copies


def test_every_copy_once(spark):
    counted = spark.createDataFrame(
        [("a", 1), ("b", 3), ("c", 4), ("d", 0), ("e", None), ("f", 9), (None, 2)], "k string, n bigint"
    )
    got = expand_copies(counted, "n", "nth", chunk=4)
    assert got.columns == ["k", "nth"]
    want = [(k, i + 1) for k, n in [("a", 1), ("b", 3), ("c", 4), ("f", 9), (None, 2)] for i in range(n)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_many_copies_of_one_row_are_many_tasks(spark):
    got = expand_copies(spark.sql("SELECT 'x' AS k, 3000000 AS n"), "n", "nth")
    parts = got.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 3_000_000
    assert max(r["count"] for r in parts) < 2_000_000
    assert got.agg(F.max("nth"), F.countDistinct("nth")).first()[:] == (3_000_000, 3_000_000)
