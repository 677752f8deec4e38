"""Validity periods, point-in-time lookups and runs of consecutive days.

All windows here are partitioned by the entity key. Their input is at most one row per
entity and day, so a partition is bounded by the length of the calendar, whatever the
number of raw rows of the entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roostline.functions.dates import OPEN_END
from roostline.operators.copies import CHUNK, expand_copies

# Start of the period before the first known change.
BEGINNING = "0001-01-01"


def scd2_intervals(changes: DataFrame, key: str, changed_on: str) -> DataFrame:
    """Turn change dates into closed, abutting ``[valid_from, valid_to]`` periods."""
    # The source dialect sorts NULL last: an undated change ends no period.
    order = F.col(changed_on).asc_nulls_last()
    following = F.lead(changed_on).over(Window.partitionBy(key).orderBy(order))
    others = [c for c in changes.columns if c not in (key, changed_on)]
    return changes.select(
        key,
        F.col(changed_on).alias("valid_from"),
        F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END).cast("date")).alias("valid_to"),
        *others,
    )


def as_of_join(
    facts: DataFrame,
    periods: DataFrame,
    key: str,
    at: str | Column,
    how: str = "inner",
    month: Column | None = None,
) -> DataFrame:
    """Join each fact row to the period of its entity that covers the date ``at``.

    The periods of an entity do not overlap. They are dealt to the months that have facts: a
    month gets the period that is open when it begins, found by a window over the starts and
    months of an entity, and the periods that start inside it. The join is an equality on entity
    and month, so a fact is compared with the periods of its month, at most one per day and
    one more, however many versions the entity has; and an entity that holds most of the facts
    is spread over its months. Facts are never broadcast, however small Spark takes them to be.
    Facts that have the first day of the month of ``at`` in a column give it as ``month``: those
    that are dealt by entity and month already stay where they are.
    """
    date = facts[at] if isinstance(at, str) else at
    of = F.trunc("__at", "month") if month is None else month
    dated = facts.withColumn("__at", date).withColumn("__month", of)
    others = [c for c in periods.columns if c != key]
    known = periods.filter(F.col("valid_to") >= F.col("valid_from")).select(
        F.col(key).alias("__key"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("__period")
    )
    start = F.col("__period")["valid_from"]
    starts = known.select("__key", start.alias("__on"), "__period")
    months = dated.select(F.col(key).alias("__key"), F.col("__month").alias("__on")).distinct()
    marks = months.filter(F.col("__on").isNotNull() & F.col("__key").isNotNull())
    timeline = starts.withColumn("__mark", F.lit(False)).unionByName(
        marks.withColumn("__mark", F.lit(True)), allowMissingColumns=True
    )
    # A start on the first of a month is open when the month begins.
    upto = (
        Window.partitionBy("__key")
        .orderBy("__on", "__mark")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    opened = (
        timeline.withColumn("__open", F.last("__period", ignorenulls=True).over(upto))
        .filter(F.col("__mark") & (F.col("__open")["valid_to"] >= F.col("__on")))
        .select("__key", F.col("__on").alias("__of"), F.col("__open").alias("__period"))
    )
    inside = known.select("__key", F.trunc(start, "month").alias("__of"), "__period").filter(
        start > F.col("__of")
    )
    dealt = opened.union(inside).select("__key", "__of", "__period.*")
    covered = (
        (dated[key] == dealt["__key"])
        & (dated["__month"] == dealt["__of"])
        & (dated["__at"] >= dealt["valid_from"])
        & (dated["__at"] <= dealt["valid_to"])
    )
    # Spark takes written out rows for as few as they were before, and would broadcast the facts.
    return dated.hint("merge").join(dealt, covered, how).drop(
        "__key", "__of", "__at", "__month", "valid_from", "valid_to"
    )


def continuous_periods(
    entities: DataFrame, history: DataFrame, key: str, value: str
) -> DataFrame:
    """One row per entity and period, without holes, from the beginning to the open end.

    Inside a known period the value of the history wins and the entity's own value fills a
    NULL. Before the first known change, and for entities without history, the entity's own
    value holds. A fact table then needs one inner join instead of an inner join to the
    entities plus a left range join to the history.

    The key travels inside the exploded period, so the result is not known to be partitioned
    by the key. A later join shuffles these few rows once more, and with an exchange directly
    below both of its sides adaptive execution can split an entity that holds many rows.
    """
    # A period without a start covers no date; it must not stand for "no history" below.
    dated = history.filter(F.col("valid_from").isNotNull())
    earlier = F.lag("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    known = dated.select(
        F.col(key).alias("__key"),
        F.col("valid_from").alias("__from"),
        F.col("valid_to").alias("__to"),
        F.col(value).alias("__value"),
        earlier.isNull().alias("__first"),
    )

    def period(start: Column, end: Column, content: Column) -> Column:
        return F.struct(
            F.col(key), start.alias("valid_from"), end.alias("valid_to"), content.alias(value)
        )

    beginning, open_end = F.lit(BEGINNING).cast("date"), F.lit(OPEN_END).cast("date")
    own = F.col(value)
    current = period(F.col("__from"), F.col("__to"), F.coalesce("__value", own))
    before = period(beginning, F.date_sub("__from", 1), own)
    periods = (
        F.when(F.col("__from").isNull(), F.array(period(beginning, open_end, own)))
        .when(F.col("__first") & (F.col("__from") > beginning), F.array(before, current))
        .otherwise(F.array(current))
    )
    others = [c for c in entities.columns if c not in (key, value)]
    return (
        entities.join(known, entities[key] == known["__key"], "left")
        .select(*others, F.explode(periods).alias("__period"))
        .select(*others, "__period.*")
    )


def islands(
    days: DataFrame,
    key: str,
    day: str,
    carried: Sequence[str],
    measures: Sequence[Column],
    unique_days: bool = False,
    month: str | None = None,
    merged: Sequence[Column] = (),
) -> DataFrame:
    """Group consecutive days of an entity into spans.

    A day minus its position among the entity's days is constant inside a run. A repeated
    day advances the position and so starts another run, as the plain row number does.

    Copies of a day are counted before the window, so an entity with many copies shuffles
    as few rows as any other, and written out in bounded pieces after it. Pass ``unique_days=True`` when (key, day) is known to be
    unique: it saves that exchange.

    Unique days may name the column that holds the first day of their ``month``. They are then
    numbered within their month, and only the runs of a month meet those of other months: their
    group moves by the days of the months before. ``merged`` makes the measures of a span from
    those of its runs. Neither a task nor a window holds all days of an entity, and days that are
    dealt by entity and month already stay where they are.
    """
    order = [F.col(day), *[F.col(c) for c in carried]]
    if unique_days and month is not None:
        position = F.row_number().over(Window.partitionBy(key, month).orderBy(*order))
        runs = (
            days.select(key, month, day, *carried, position.alias("__position"))
            .withColumn("__group", F.date_sub(day, F.col("__position")))
            .groupBy(key, month, "__group")
            .agg(
                F.min(day).alias("__start"),
                F.max(day).alias("__end"),
                F.count(F.lit(1)).alias("__days"),
                *measures,
            )
        )
        # A given number of tasks: by their bytes, runs would be put together in few tasks, whose
        # windows and groups need far more memory than that.
        tasks = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        runs = runs.repartition(tasks, key)
        upto = F.sum("__days").over(Window.partitionBy(key).orderBy(month))
        before = upto - F.sum("__days").over(Window.partitionBy(key, month))
        return (
            runs.withColumn("span_group", F.date_sub("__group", before.cast("int")))
            .groupBy(key, "span_group")
            .agg(
                F.min("__start").alias("span_start_date"),
                F.max("__end").alias("span_end_date"),
                F.sum("__days").alias("consecutive_available_days"),
                *merged,
            )
        )
    if unique_days:
        position = F.row_number().over(Window.partitionBy(key).orderBy(*order))
        placed = days.select(key, day, *carried, position.alias("__position"))
    else:
        counted = days.groupBy(key, day, *carried).agg(F.count(F.lit(1)).alias("__copies"))
        running = F.sum("__copies").over(
            Window.partitionBy(key)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        numbered = counted.withColumn("__before", running - F.col("__copies"))
        # A few copies are written out where they are, very many by all tasks.
        few = numbered.filter(F.col("__copies") <= CHUNK).select(
            *numbered.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), "__copies")).alias("__nth")
        )
        many = expand_copies(numbered.filter(F.col("__copies") > CHUNK), "__copies", "__nth")
        placed = few.drop("__copies").unionByName(many).select(
            key, day, *carried, (F.col("__before") + F.col("__nth")).alias("__position")
        )
    return (
        placed.withColumn("span_group", F.date_sub(day, F.col("__position").cast("int")))
        .groupBy(key, "span_group")
        .agg(
            F.min(day).alias("span_start_date"),
            F.max(day).alias("span_end_date"),
            F.count(F.lit(1)).alias("consecutive_available_days"),
            *measures,
        )
    )
