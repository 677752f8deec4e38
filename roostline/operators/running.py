"""Row numbers and running sums in an order, without a task per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roostline.functions.amenities import quoted
from roostline.session import staged


def running(
    df: DataFrame,
    order: Sequence[Column],
    group: Sequence[str] = (),
    position: str = "position",
    sums: Mapping[str, str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Add the row number from 1 and running sums within each group, in the given order.

    ``sums`` maps new columns to the columns they add up, the row's own value included.
    The rows are cut into ranges of (group, order) and written once to the scratch folder. A
    row's number is the rows of its group in earlier ranges plus its place in its range, and
    sums are made alike, so a group that holds most rows is spread over many tasks. The counts
    have one row per group and range it reaches: at most groups + ranges. Rows that are equal in
    group and order cannot be divided: give an order that tells copies apart.
    """
    spark = df.sparkSession
    sums = dict(sums or {})
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [quoted(c) for c in df.columns]
    keys = [quoted(g).alias(f"__group{n}") for n, g in enumerate(group)]
    ranged = df.repartitionByRange(tasks, *[quoted(g) for g in group], *order).select(
        *names, F.spark_partition_id().alias("__range")
    )
    table, _ = staged(ranged, "running")
    placed = table.select("*", *keys)
    whole = [f"__group{n}" for n in range(len(group))]
    sizes = placed.groupBy(*whole, "__range").agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(quoted(c)).alias(f"__sum_{name}") for name, c in sums.items()],
    )
    earlier = Window.partitionBy(*whole).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = {"__rows": "__rows", **{f"__sum_{name}": f"__sum_{name}" for name in sums}}
    offsets = sizes.select(
        *[F.col(k).alias(f"{k}_of") for k in whole],
        F.col("__range").alias("__range_of"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in before],
    )
    inside = Window.partitionBy(*whole, "__range").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.select(
        "*",
        F.row_number().over(inside).alias("__place"),
        *[F.coalesce(F.sum(quoted(c)).over(upto), F.lit(0)).alias(f"__{name}") for name, c in sums.items()],
    )
    same = F.col("__range") == F.col("__range_of")
    for k in whole:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_of"))
    return numbered.join(offsets, same).select(
        *[quoted(c) for c in df.columns if c != position and c not in sums],
        (F.col("__place") + F.col("__rows_before")).alias(position),
        *[(F.col(f"__{name}") + F.col(f"__sum_{name}_before")).alias(name) for name in sums],
    )
