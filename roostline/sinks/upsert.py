"""The rows of a keyed upsert: one per key, and the old rows beside them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.functions.amenities import quoted
from roostline.session import remove_scratch, staged
from roostline.sinks.manifests import MONTH


class RepeatedKeyError(ValueError):
    """The rows of an upsert do not have one row per key."""


@contextmanager
def staged_rows(spark: SparkSession, rows: DataFrame) -> Iterator[DataFrame]:
    """The new rows, written once to the shared scratch folder, since the check of their keys,
    the anti join and the merge need them."""
    fresh, folder = staged(rows, "upsert")
    try:
        yield fresh
    finally:
        remove_scratch(spark, folder)


def with_kept_rows(current: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``fresh`` and the rows of ``current`` with other keys, with the columns of ``fresh``."""
    repeated = fresh.groupBy(*keys).count().filter("count > 1").first()
    if repeated is not None:
        raise RepeatedKeyError(f"more than one row with the key {repeated.asDict()}")
    known = set(current.columns)
    kept = current.join(fresh.select(*keys), list(keys), "left_anti").select(
        *[
            quoted(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
            for f in fresh.schema.fields
        ]
    )
    # Tasks per month are sized at run time: small months meet, a large one is split.
    return kept.unionByName(fresh).hint("rebalance", MONTH)
