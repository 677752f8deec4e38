"""Hot keys: one listing or one night holds most of the rows."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from roostline.operators import as_of_join
from roostline.plans import analyses, facts, intermediate
from roostline.plans.pipeline import Lineage
from roostline.session import tune
from roostline.sources.derived import derived_sources
from tests.lodging import changes, listings, small_sources

# Sizes at which the tiny tables of this test count as large and skewed.
SMALL_SIZES = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@contextmanager
def settings(spark, values):
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key)


@pytest.fixture(scope="module")
def hot(spark):
    """Listing 0 has 40 copies of each of its nights, as many rows as 40 other listings."""
    base = small_sources(spark)
    night = (
        spark.range(40)
        .select(
            F.col("id").alias("listing_id"),
            F.explode(F.expr("sequence(DATE'2022-01-01', DATE'2022-04-30')")).alias("date"),
            F.when(F.col("id") == 0, 40).otherwise(1).alias("copies"),
        )
        .select("*", F.explode(F.expr("sequence(1, copies)")).alias("copy"))
        .select(
            "listing_id",
            "date",
            F.lit("t").alias("available"),
            F.lit(None).cast("long").alias("reservation_id"),
            F.lit(100).cast("decimal(10,2)").alias("price"),
            F.lit(1).alias("minimum_nights"),
            F.lit(0).alias("maximum_nights"),
            F.lit(None).cast("timestamp").alias("_loaded_at"),
        )
        .repartition(16)
    )
    return Lineage(
        base.replacing(
            listings=listings(spark, *[{"id": i} for i in range(40)]),
            calendar=night,
            amenities_changelog=changes(
                spark,
                *[
                    {"listing_id": i, "change_at": "2022-02-01 00:00:00", "amenities": ["x"]}
                    for i in range(40)
                ],
            ),
        )
    )


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_listing_is_spread_over_its_months(spark, hot):
    with settings(spark, SMALL_SIZES):
        plan = final_plan(hot.fct_daily("aggregate").select("listing_id", "listing_name"))
    assert re.search(r"hashpartitioning\(listing_id#\d+L, __month#", plan)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_hot_listing_of_one_month_is_split_in_the_listing_join(spark, hot):
    january = Lineage(hot.sources.replacing(calendar=hot.sources.calendar.filter("date < '2022-02-01'")))
    smaller = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    with settings(spark, SMALL_SIZES | smaller):
        plan = final_plan(january.fct_daily("aggregate").select("listing_id", "listing_name"))
    assert "skewed" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_copies_of_a_night_all_reach_the_fact(spark, hot):
    with settings(spark, SMALL_SIZES):
        assert hot.fct_daily("aggregate").count() == 120 * 39 + 120 * 40


def test_spans_shuffle_one_row_per_night_of_a_hot_listing(spark, hot):
    spans = intermediate.availability_spans(hot.calendar, hot.listings)
    plan = spans._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(i for i, line in enumerate(plan) if "Window" in line)
    assert any("__copies" in line and "Aggregate" in line for line in plan[window:])
    assert spans.filter("listing_id > 0").count() == 39
    assert spans.filter("listing_id = 0").agg(F.sum("consecutive_available_days")).first()[0] == (
        120 * 40
    )


def test_monthly_rollups_aggregate_before_they_shuffle(spark, hot):
    months = facts.fct_monthly_neighborhood(hot.fct_daily("aggregate"))
    plan = final_plan(months.select("neighborhood", "active_listings"))
    assert "partial_sum" in plan or "partial_count" in plan
    assert "Expand" not in plan
    assert {r.active_listings for r in months.collect()} == {40}


def test_a_night_with_most_reviews_is_spread(spark, hot, monkeypatch):
    from roostline.plans import facts as module

    joined = module.left_join_hot_right
    monkeypatch.setattr(
        module,
        "left_join_hot_right",
        lambda left, right, keys: joined(left, right, keys, hot_rows=100, salts=16),
    )
    review = spark.range(3000).select(
        F.lit(None).cast("long").alias("id"),
        F.lit(7).cast("long").alias("listing_id"),
        F.lit("2022-03-03").cast("date").alias("review_date"),
        F.lit(4.0).alias("review_score"),
        F.lit(None).cast("timestamp").alias("_loaded_at"),
    )
    run = Lineage(hot.sources.replacing(generated_reviews=review.repartition(32)))
    fact = run.fct_daily("fanout").filter("listing_id = 7")
    assert fact.count() == 119 + 3000
    assert fact.filter("daily_review_score = 4").count() == 3000


def test_facts_that_spark_takes_for_few_are_not_broadcast(spark):
    # One row by its estimate, ten thousand when written out.
    nights = spark.range(1).select(
        F.lit(1).alias("listing_id"),
        F.explode(F.expr("sequence(DATE'1990-01-01', DATE'2017-05-18')")).alias("date"),
    )
    period = spark.createDataFrame(
        [(1, "a")], "listing_id int, name string"
    ).selectExpr("*", "DATE'0001-01-01' AS valid_from", "DATE'9999-12-31' AS valid_to")
    joined = as_of_join(nights, period, "listing_id", "date")
    assert joined.count() == 10_000
    plan = final_plan(joined)
    assert "SortMergeJoin" in plan and not re.search("BroadcastHashJoin.*BuildLeft", plan)


def test_derived_nights_are_written_out_after_their_reservations_are_found(spark):
    nights = derived_sources(spark, "/root/testdata/sf0.001").calendar
    plan = nights._jdf.queryExecution().optimizedPlan().toString().splitlines()
    days = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    join = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    # Neither the join nor the dealing of suppliers has a row per night.
    assert days < join < next(i for i, line in enumerate(plan) if "Repartition" in line)


def test_a_query_of_many_passes_derives_its_sources_once(spark):
    import __spark_entry__ as entry

    plan = entry.dq_results(spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    # Each place where a source is read would hold the order lines it is derived from.
    assert "l_suppkey" not in plan.optimizedPlan().toString()


def test_the_stays_are_made_once(spark):
    import __spark_entry__ as entry

    for query in (entry.max_stay, entry.max_stay_lockbox_firstaid):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        # The ranks and the overall maximum read the written stays, not the nights.
        assert "Generate explode(sequence(greatest(" not in plan.optimizedPlan().toString()


@pytest.mark.parametrize("reviews", ["fanout", "aggregate"])
def test_nights_dealt_by_month_stay_where_they_are(spark, reviews):
    tune(spark)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        fact = Lineage(derived_sources(spark, "/root/testdata/sf0.001")).fct_daily(reviews)
        plan = fact.select("listing_id", "review_id", "listing_name")._jdf.queryExecution()
        lines = plan.executedPlan().toString().splitlines()
    days = next(i for i, line in enumerate(lines) if "Generate explode(sequence(greatest" in line)
    # Outside the plan of the nights no exchange deals a row per night: those above them would be
    # ancestors, with less indentation.
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    above, least = [], depth[days]
    for i in range(days, -1, -1):
        if depth[i] < least:
            above.append(lines[i])
            least = depth[i]
    assert above and not any("Exchange" in line for line in above)


def test_price_changes_take_one_pass(spark):
    fact = spark.range(100).selectExpr(
        "id % 9 AS listing_id", "if(id % 4 = 0, NULL, string(id % 2)) AS neighborhood",
        "date_add(DATE'2021-07-12', int(id % 3)) AS calendar_date", "decimal(id) AS adjusted_price",
    )
    plan = analyses.listing_price_changes(fact)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
