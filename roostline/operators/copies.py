"""Rows given as (row, number of copies), written out one by one in bounded pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roostline.functions.amenities import quoted

# Copies that one step of one task writes out at a time.
CHUNK = 4096


def expand_copies(counted: DataFrame, copies: str, nth: str, chunk: int = CHUNK) -> DataFrame:
    """Each row once per copy, numbered from 1 in the column ``nth``, which takes the place of
    ``copies``. A count that is NULL or below 1 gives no row.

    The copies of a row are cut into chunks, the chunks are dealt to all tasks, and a chunk
    is written out where it lies: neither an array nor a task grows with the copies of a row.
    A row makes copies / ``chunk`` chunks before they are dealt.
    """
    others = [c for c in counted.columns if c != copies]
    last = F.floor((quoted(copies) - 1) / F.lit(chunk)).cast("bigint")
    pieces = counted.filter(quoted(copies) >= 1).select(
        *[quoted(c) for c in others],
        quoted(copies).cast("bigint").alias("__copies"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("__piece"),
    )
    first = F.col("__piece") * chunk + 1
    # A given number of tasks: by their bytes before writing out, chunks would be put together.
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(tasks, *[quoted(c) for c in others], "__piece").select(
        *[quoted(c) for c in others],
        F.explode(F.sequence(first, F.least("__copies", first + chunk - 1))).alias(nth),
    )
