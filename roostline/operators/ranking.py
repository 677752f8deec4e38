"""Ranks over a whole table without sending the table through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roostline.operators.running import running


def dense_rank_by_value(
    df: DataFrame, value: str, overall: str, within: tuple[str, str] | None = None
) -> DataFrame:
    """Add ``dense_rank() over (order by value desc)`` as the column ``overall``.

    ``within=(group, name)`` also adds the rank inside each group.

    A dense rank depends on the distinct values only. Those are numbered over ranges, however
    many they are (see :func:`running`, which writes them once), and joined back: neither the
    table, nor a group that holds most of it, nor its distinct values are sorted in one task.
    A NULL value ranks first, as in the source dialect, and NULL is a group of its own.
    """
    keys = [value] if within is None else [within[0], value]
    inner = {k: f"__{k}" for k in keys}
    ranks = df.select(*[F.col(k).alias(a) for k, a in inner.items()]).distinct()
    descending = [F.col(inner[value]).desc_nulls_first()]
    if within is None:
        ranks = running(ranks, descending, (), overall)
    else:
        values = running(ranks.select(inner[value]).distinct(), descending, (), overall)
        values = values.withColumnRenamed(inner[value], "__ranked")
        ranks = (
            running(ranks, descending, [inner[within[0]]], within[1])
            .join(values, F.col(inner[value]).eqNullSafe(F.col("__ranked")))
            .drop("__ranked")
        )
    same = F.lit(True)
    for k, alias in inner.items():
        same = same & df[k].eqNullSafe(ranks[alias])
    return df.join(ranks, same, "left").drop(*inner.values())
