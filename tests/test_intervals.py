from __future__ import annotations

import datetime
import random
import re

from pyspark.sql import functions as F

from roostline.operators import (
    as_of_join,
    continuous_periods,
    dense_rank_by_value,
    islands,
    left_join_hot_right,
    scd2_intervals,
)


def d(text):
    return datetime.date.fromisoformat(text)


def test_changes_become_abutting_periods(spark, rows):
    changes = spark.createDataFrame(
        [(1, d("2022-01-01"), ["Wifi"]), (1, d("2022-03-15"), ["AC"]), (2, d("2022-02-02"), [])],
        "listing_id long, change_at date, amenities array<string>",
    )
    assert rows(scd2_intervals(changes, "listing_id", "change_at")) == [
        (1, d("2022-01-01"), d("2022-03-14"), ["Wifi"]),
        (1, d("2022-03-15"), d("9999-12-31"), ["AC"]),
        (2, d("2022-02-02"), d("9999-12-31"), []),
    ]


def test_point_in_time_lookup_is_inclusive_on_both_ends(spark, rows):
    history = spark.createDataFrame(
        [(1, d("2022-01-01"), d("2022-03-14"), "a"), (1, d("2022-03-15"), d("9999-12-31"), "b")],
        "id long, valid_from date, valid_to date, state string",
    )
    facts = spark.createDataFrame(
        [(1, d(t)) for t in ("2021-12-31", "2022-01-01", "2022-03-14", "2022-03-15")],
        "id long, day date",
    )
    assert [r[2] for r in rows(as_of_join(facts, history, "id", "day", "left"))] == [
        None,
        "a",
        "a",
        "b",
    ]


def test_periods_without_holes_equal_two_joins(spark, rows):
    """One inner join on the combined periods = inner join to entities + left range join."""
    rng = random.Random(7)
    start = d("2022-01-01")
    entities = spark.createDataFrame(
        [(i, f"n{i}", rng.choice([None, ["own"]])) for i in range(12)],
        "id long, name string, amenities array<string>",
    )
    changes = spark.createDataFrame(
        [
            (i, start + datetime.timedelta(days=day), rng.choice([[], ["x"], None]))
            for i in range(0, 14, 2)
            for day in rng.sample(range(60), 5)
        ],
        "id long, change_at date, amenities array<string>",
    )
    history = scd2_intervals(changes, "id", "change_at")
    facts = spark.createDataFrame(
        [(i, start + datetime.timedelta(days=day - 10)) for i in range(14) for day in range(80)],
        "fid long, day date",
    )
    periods = continuous_periods(entities, history, "id", "amenities")
    one = facts.join(
        periods, F.expr("fid = id AND day BETWEEN valid_from AND valid_to")
    ).select("fid", "day", "name", "amenities")
    known = history.select(F.col("id").alias("hid"), "valid_from", "valid_to", "amenities")
    two = (
        facts.join(entities, F.expr("fid = id"))
        .join(
            known.withColumnRenamed("amenities", "seen"),
            F.expr("fid = hid AND day BETWEEN valid_from AND valid_to"),
            "left",
        )
        .select("fid", "day", "name", F.coalesce("seen", "amenities").alias("amenities"))
    )
    assert rows(one) == rows(two)
    assert one.count() == 12 * 80


def available(spark, *listing_days):
    return spark.createDataFrame(
        [(i, d(t), low, high) for i, t, low, high in listing_days],
        "id long, day date, low int, high int",
    )


def spans(frame, unique_days=False):
    return islands(frame, "id", "day", ["low", "high"], [F.max("low").alias("m")], unique_days)


def test_consecutive_days_form_one_span(spark, rows):
    days = available(
        spark, *[(1, f"2022-01-0{i}", i, 9) for i in (1, 2, 3, 5)], (2, "2022-01-04", 1, 9)
    )
    expected = [
        (1, d("2022-01-01"), d("2022-01-03"), 3, 3),
        (1, d("2022-01-05"), d("2022-01-05"), 1, 5),
        (2, d("2022-01-04"), d("2022-01-04"), 1, 1),
    ]
    for unique_days in (False, True):
        assert rows(spans(days, unique_days).drop("span_group")) == expected


def test_a_repeated_day_starts_another_run_in_both_forms(spark, rows):
    days = available(
        spark,
        (1, "2022-01-01", 1, 9),
        (1, "2022-01-02", 1, 9),
        (1, "2022-01-02", 1, 9),
        (1, "2022-01-03", 1, 9),
    )
    counted = rows(spans(days).drop("span_group"))
    assert counted == rows(spans(days, True).drop("span_group"))
    assert counted == [
        (1, d("2022-01-01"), d("2022-01-02"), 2, 1),
        (1, d("2022-01-02"), d("2022-01-03"), 2, 1),
    ]


def test_copies_of_a_day_are_counted_before_the_window(spark):
    days = available(spark, *[(1, "2022-01-01", 1, 9)] * 500)
    plan = spans(days)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(i for i, line in enumerate(plan) if "Window" in line)
    # The plan is printed from the top: the count comes below the window.
    assert any("Aggregate" in line and "__copies" in line for line in plan[window:])
    assert spans(days).count() == 500


def test_dense_rank_by_value_matches_the_window_function(spark, rows):
    rng = random.Random(3)
    frame = spark.createDataFrame(
        [
            (i, rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3, 5, 8]))
            for i in range(300)
        ],
        "id long, area string, nights long",
    )
    frame.createOrReplaceTempView("stays_to_rank")
    expected = spark.sql(
        """SELECT *, dense_rank() OVER (ORDER BY nights DESC NULLS FIRST) AS r,
        dense_rank() OVER (PARTITION BY area ORDER BY nights DESC NULLS FIRST) AS a
        FROM stays_to_rank"""
    )
    ranked = dense_rank_by_value(frame, "nights", "r", within=("area", "a"))
    assert rows(ranked, *expected.columns) == rows(expected)
    plain = dense_rank_by_value(frame, "nights", "r")
    assert rows(plain, "id", "r") == rows(expected, "id", "r")


def test_hot_right_keys_are_salted_without_changing_the_join(spark, rows):
    left = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k long, name string"
    )
    right = spark.createDataFrame(
        [(1, v) for v in range(50)] + [(1, 7)] * 40 + [(2, 1), (4, 1), (None, 1)],
        "k long, v int",
    ).repartition(4, "v")
    joined = left_join_hot_right(left, right, ["k"], hot_rows=10, salts=8)
    assert rows(joined, "k", "name", "v") == rows(left.join(right, "k", "left"), "k", "name", "v")


def test_hot_rows_spread_over_many_buckets(spark):
    right = spark.range(10_000).select(F.lit(1).alias("k"), F.lit(5).alias("v")).repartition(16)
    left = spark.createDataFrame([(1,)], "k int")
    joined = left_join_hot_right(left, right, ["k"], hot_rows=100, salts=8)
    # Equal copies of one row: the input partition still tells them apart.
    assert joined.count() == 10_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "SPARK_PARTITION_ID" in plan.upper()


def test_as_of_join_equals_a_range_join(spark, rows):
    """Many versions, versions of one day, undated facts, months without starts, open ends."""
    rng = random.Random(11)
    start = d("2021-11-15")
    changes = spark.createDataFrame(
        [(i, start + datetime.timedelta(days=rng.randrange(500)), f"v{n}") for i in range(6) for n in range(i * 30)],
        "id long, change_at date, state string",
    )
    history = scd2_intervals(changes, "id", "change_at")
    facts = spark.createDataFrame(
        [(rng.randrange(8), start + datetime.timedelta(days=rng.randrange(-40, 600)), n) for n in range(800)]
        + [(1, None, 9000), (None, start, 9001)],
        "id long, day date, n long",
    )
    ranged = history.withColumnRenamed("id", "of")
    for how in ("inner", "left"):
        want = facts.join(
            ranged, F.expr("id = of AND day >= valid_from AND day <= valid_to"), how
        ).select("id", "day", "n", "state")
        # Several changes of one date end on the day before: only one of them covers a day.
        assert rows(as_of_join(facts, history, "id", "day", how)) == rows(want)


def test_compared_rows_do_not_grow_with_versions(spark):
    """Rows that the join condition sees: pairs of the same listing and month."""
    facts = spark.sql("SELECT 1 AS id, explode(sequence(DATE'2022-01-01', DATE'2022-12-31')) AS day")
    pairs = {}
    for versions in (10, 3000):
        changes = spark.range(versions).select(
            F.lit(1).alias("id"),
            F.date_sub(F.lit(d("2022-06-30")), F.col("id").cast("int")).alias("change_at"),
            F.col("id").alias("state"),
        )
        joined = as_of_join(facts, scd2_intervals(changes, "id", "change_at"), "id", "day")
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "__month" in plan
        months = joined.groupBy(F.trunc("day", "month")).agg(F.countDistinct("state").alias("n")).collect()
        pairs[versions] = max(r["n"] for r in months)
        assert joined.count() == (366 if versions > 1000 else 194) - (1 if versions > 1000 else 0)
    assert max(pairs.values()) <= 31


def test_many_copies_of_one_day(spark):
    """Ten million copies of a day: as many spans, from pieces that all tasks write out."""
    days = spark.range(10_000_000).select(
        F.lit(1).alias("id"), F.lit(d("2022-01-01")).alias("day"), F.lit(1).alias("low"), F.lit(9).alias("high")
    )
    got = spans(days)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    assert got.agg(F.count("*"), F.sum("consecutive_available_days")).first()[:] == (10_000_000, 10_000_000)


def test_dense_rank_of_many_values_in_many_tasks(spark):
    from pyspark.sql import Window

    df = spark.range(1_000_000).select((F.col("id") * 7 % 1_000_003).alias("v"), (F.col("id") % 3).alias("g"))
    got = dense_rank_by_value(df, "v", "nr", ("g", "nr_in_g"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__range" in plan
    want = df.select(
        "v",
        F.dense_rank().over(Window.orderBy(F.desc("v"))).alias("nr"),
        F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("v"))).alias("nr_in_g"),
    )
    assert got.select(want.columns).exceptAll(want.withColumns({c: F.col(c).cast("long") for c in want.columns})).count() == 0


def test_runs_of_months_make_the_spans_of_whole_listings(spark, rows):
    # Few days, repeated ones, days without a date, runs across months and years.
    days = spark.range(6000).select(
        (F.col("id") % 7).alias("id"),
        F.expr("if(id % 211 = 0, NULL, date_add(DATE'2021-11-01', int(hash(id) % 200)))").alias("day"),
        (F.col("id") % 3).cast("int").alias("low"),
        (F.col("id") % 5).cast("int").alias("high"),
    )
    days = days.filter("id = 3 OR hash(day, id) % 4 <> 0").withColumn("month", F.trunc("day", "month"))
    measures = [F.max("low").alias("m"), F.min("high").alias("h")]
    carried = ["low", "high"]
    plain = islands(days, "id", "day", carried, measures, True)
    merged = [F.max("m").alias("m"), F.min("h").alias("h")]
    got = islands(days, "id", "day", carried, measures, True, "month", merged)
    assert rows(got) == rows(plain) == rows(islands(days, "id", "day", carried, measures))
    assert got.columns == plain.columns
    distinct = days.dropDuplicates(["id", "day"])
    found = rows(islands(distinct, "id", "day", carried, measures, True, "month", merged))
    assert found == rows(islands(distinct, "id", "day", carried, measures)) and len(found) > 100
    windows = got._jdf.queryExecution().optimizedPlan().toString()
    # Runs are dealt to a given number of tasks, which adaptive execution does not put together.
    assert re.search(r"RepartitionByExpression \[id#\d+L\], 4", windows)
    assert "row_number()" in windows and re.search(r"row_number\(\).*\[id#\d+L, month#\d+\]", windows)
