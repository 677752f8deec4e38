"""Gates before a load: source freshness, amenity drift and the choice of the load mode."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Hours until a source is a warning, and until it is an error.
FRESHNESS = {
    "listings": (7 * 24, 14 * 24),
    "calendar": (24, 48),
    "generated_reviews": (7 * 24, 14 * 24),
    "amenities_changelog": (7 * 24, 14 * 24),
}


class StaleSourceError(RuntimeError):
    """A source is older than its error threshold."""


def source_freshness(
    sources: Iterable[tuple[str, DataFrame]],
    as_of: datetime.datetime | str,
    thresholds: Mapping[str, tuple[int, int]] = FRESHNESS,
) -> DataFrame:
    """One row per source: latest load, age in hours and pass, warn or error.

    A source without ``_loaded_at``, or without any load time in it, is an error. Each
    source costs one scan of that single column.
    """
    now = F.lit(str(as_of)).cast("timestamp")
    ages = []
    for name, df in sources:
        loaded = (
            F.max(F.col("_loaded_at").cast("timestamp"))
            if "_loaded_at" in df.columns
            else F.max(F.lit(None).cast("timestamp"))
        )
        warn, error = thresholds[name]
        ages.append(
            df.agg(loaded.alias("max_loaded_at")).select(
                F.lit(name).alias("source"),
                "max_loaded_at",
                F.lit(warn).alias("warn_after_hours"),
                F.lit(error).alias("error_after_hours"),
            )
        )
    age = (F.unix_micros(now) - F.unix_micros("max_loaded_at")) / F.lit(3_600_000_000)
    status = (
        F.when(F.col("age_hours").isNull(), "error")
        .when(F.col("age_hours") > F.col("error_after_hours"), "error")
        .when(F.col("age_hours") > F.col("warn_after_hours"), "warn")
        .otherwise("pass")
    )
    return (
        reduce(DataFrame.unionByName, ages)
        .withColumn("age_hours", age)
        .withColumn("status", status)
    )


def freshness_gate(freshness: DataFrame) -> str:
    """'passed' or 'warning'; raises when a source is an error. One row per source."""
    rows = freshness.select("source", "status").collect()
    stale = sorted(r.source for r in rows if r.status == "error")
    if stale:
        raise StaleSourceError(f"stale sources: {', '.join(stale)}")
    return "warning" if any(r.status == "warn" for r in rows) else "passed"


def verdict(results: DataFrame, gate: str, failing: str) -> DataFrame:
    """One row: what a gate says to results with a ``status``, as :func:`freshness_gate` (failing
    status ``error``) and ``checks_gate`` (``fail``) say it: failed, warning or passed. Without
    results there is nothing to object to."""
    failed, warned = F.bool_or(F.col("status") == failing), F.bool_or(F.col("status") == "warn")
    return results.agg(
        F.when(failed, "failed").when(warned, "warning").otherwise("passed").alias("verdict"),
        F.count_if(F.col("status") != "pass").alias("findings"),
    ).select(F.lit(gate).alias("gate"), "verdict", "findings")


def schema_drift(
    names: DataFrame, target_columns: Iterable[str], known_columns: Iterable[str] = ()
) -> DataFrame:
    """Amenity names against the columns of the published fact, one row per difference.

    ``names`` has one column ``amenity_name``. Only ``added`` names ask for a full refresh;
    a target that does not exist has no columns, so every name counts as added. ``removed``
    reports published amenity columns, those not in ``known_columns``, without a name.
    """
    spark = names.sparkSession
    target = set(target_columns)
    static = set(known_columns)

    def listed(values: Iterable[str]) -> DataFrame:
        array = F.array(*[F.lit(v) for v in sorted(values)]).cast("array<string>")
        return spark.range(1).select(F.explode(array).alias("amenity_name"))

    added = names.join(listed(target), "amenity_name", "left_anti").select(
        "amenity_name", F.lit("added").alias("change")
    )
    if not static:
        return added
    removed = (
        listed(target - static)
        .join(names, "amenity_name", "left_anti")
        .select("amenity_name", F.lit("removed").alias("change"))
    )
    return added.unionByName(removed)


def refresh_decision(drift: DataFrame, late: DataFrame) -> DataFrame:
    """One row: a full refresh when amenities were added or late rows exist, else incremental."""
    added = drift.agg(F.count_if(F.col("change") == "added").alias("new_amenities"))
    return late.select(
        added.scalar().alias("new_amenities"), F.col("late_count").alias("late_count")
    ).select(
        (F.col("new_amenities") > 0).alias("schema_changed"),
        (F.col("late_count") > 0).alias("late_arrivals"),
        "new_amenities",
        "late_count",
        F.when((F.col("new_amenities") > 0) | (F.col("late_count") > 0), "full_refresh")
        .otherwise("incremental")
        .alias("strategy"),
    )
