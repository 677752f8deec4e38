"""A left join whose right side may hold most of its rows under few keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key counts as hot above this many right rows.
HOT_ROWS = 1_000_000
SALTS = 64
# Keys that the sketch follows. Every key with more than 3.5 / TRACKED of the rows is among them;
# a key below that share of the rows is no burden to a task of its own share.
TRACKED = 65_536


def hot_hashes(rows: DataFrame, keys: Sequence[Column], hot_rows: int = HOT_ROWS) -> list[int]:
    """Hashes of the keys with more than ``hot_rows`` rows, from one pass that keeps a sketch of
    heavy hitters. Only keys that the sketch suspects, at most ``TRACKED``, are counted exactly,
    in a second pass over their rows; without suspects there is none."""
    present = reduce(and_, [k.isNotNull() for k in keys])
    hashed = rows.filter(present).select(F.xxhash64(*keys).alias("hash"))
    top = F.expr(f"approx_top_k(hash, {TRACKED // 2}, {TRACKED})")
    suspected = [
        r["hash"]
        for r in hashed.agg(top.alias("top")).select(F.inline("top").alias("hash", "n")).filter(f"n > {hot_rows}").collect()
    ]
    if not suspected:
        return []
    few = rows.sparkSession.createDataFrame([(h,) for h in suspected], "hash bigint")
    counted = hashed.join(F.broadcast(few), "hash").groupBy("hash").count()
    return sorted(r["hash"] for r in counted.filter(F.col("count") > hot_rows).collect())


def left_join_hot_right(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """``left.join(right, keys, 'left')`` with the right rows of hot keys spread over salts.

    Adaptive execution may split only the left side of a left join, so hot right keys are
    split here: their rows are dealt to ``salts`` buckets by a hash of the row and of its
    input partition, so equal copies spread too and a retried task deals them the same way.
    The left row is repeated once per bucket. A repeated left row that meets an empty bucket
    is removed; its key is hot, so it meets rows in other buckets. Keys that are not hot use
    bucket 0 and pass through unchanged. Without hot keys, found by :func:`hot_hashes` before
    the join is planned, it is a plain join.
    """
    typed = [F.col(k).cast(left.schema[k].dataType) for k in keys]
    found = hot_hashes(right, typed, hot_rows)
    if not found:
        return left.join(right, list(keys), "left")
    spark = left.sparkSession
    # Fewer than (right rows / hot_rows) and at most TRACKED hashes.
    hot = spark.createDataFrame([(h, True) for h in found], "__hash bigint, __hot boolean")
    buckets = F.when(F.col("__hot"), F.sequence(F.lit(1), F.lit(salts))).otherwise(
        F.array(F.lit(0))
    )
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    hashed = F.when(present, F.xxhash64(*typed))
    salted_left = (
        left.withColumn("__hash", hashed)
        .join(F.broadcast(hot), "__hash", "left")
        .withColumn("__salt", F.explode(buckets))
        .drop("__hot", "__hash")
    )
    others = [c for c in right.columns if c not in keys]
    row_hash = F.xxhash64(*[F.col(c) for c in others], F.spark_partition_id())
    bucket = F.when(F.col("__hot"), F.pmod(row_hash, F.lit(salts)) + 1).otherwise(0)
    salted_right = right.withColumn("__hash", hashed).join(F.broadcast(hot), "__hash", "left").select(
        *keys, *others, bucket.cast("int").alias("__salt"), F.lit(True).alias("__found")
    )
    return (
        salted_left.join(salted_right, [*keys, "__salt"], "left")
        .filter((F.col("__salt") == 0) | F.col("__found"))
        .drop("__salt", "__found")
    )
