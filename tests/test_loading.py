from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from roostline.plans.pipeline import DAILY, Lineage, load_daily, run_pipeline
from roostline.quality import StaleSourceError
from roostline.sinks import Warehouse, namespace
from roostline.sources import read_sources
from tests.lodging import AS_OF, changes, nights, reviews, small_sources, span

DAY_ONE = datetime.datetime(2022, 7, 10, 6)


def d(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def first_days(sources, last, changelog=None):
    """The sources as they were on an earlier day."""
    kept = {"calendar": sources.calendar.filter(F.col("date") <= F.lit(d(last)))}
    if changelog is not None:
        kept["amenities_changelog"] = changelog
    return Lineage(sources.replacing(**kept))


def without_audit(df):
    return df.drop("updated_at")


def test_layers_route_to_their_namespaces():
    assert namespace("marts") == "mart"
    assert namespace("staging") == "stagging"
    assert namespace("scratch", "sandbox") == "sandbox"
    assert namespace("marts", routes={"marts": " finance "}) == "finance"


def test_incremental_equals_full_inside_the_window(spark, warehouse, rows):
    sources = small_sources(spark)
    load_daily(spark, first_days(sources, "2022-07-10"), warehouse, DAY_ONE, "full_refresh")
    loaded = load_daily(spark, Lineage(sources), warehouse, AS_OF, "incremental")
    full = Lineage(sources).fct_daily("aggregate", Lineage(sources).amenity_names())
    assert rows(without_audit(loaded), *full.columns) == rows(full)
    # Rows before the window keep the time of the load that wrote them.
    stamps = loaded.groupBy("updated_at").agg(F.min("calendar_date").alias("first"))
    assert rows(stamps) == [(DAY_ONE, d("2022-05-28")), (AS_OF, d("2022-07-03"))]


def test_months_before_the_window_keep_their_files(spark, warehouse):
    sources = small_sources(spark)
    load_daily(spark, first_days(sources, "2022-07-10"), warehouse, DAY_ONE, "full_refresh")

    def files(month):
        return {f for f in warehouse.read("marts", DAILY).inputFiles() if f"month={month}" in f}

    before = {m: files(m) for m in ("2022-05-01", "2022-06-01", "2022-07-01")}
    load_daily(spark, Lineage(sources), warehouse, AS_OF, "incremental")
    after = {m: files(m) for m in before}
    assert before["2022-05-01"] == after["2022-05-01"]
    assert before["2022-06-01"] == after["2022-06-01"]
    assert before["2022-07-01"].isdisjoint(after["2022-07-01"])


def test_upsert_updates_inserts_and_never_deletes(spark, warehouse, rows):
    def table(*values):
        return spark.createDataFrame(
            [(i, d(t), d(t).replace(day=1), v) for i, t, v in values],
            "id int, day date, calendar_month date, v string",
        )

    old = table((1, "2022-06-30", "a"), (1, "2022-07-01", "b"), (2, "2022-07-01", "c"))
    warehouse.replace(old, "marts", "t", DAY_ONE, by_month=True)
    new = table((1, "2022-07-01", "B"), (3, "2022-08-02", "new"))
    got = warehouse.upsert(new, "marts", "t", ["id", "day"], d("2022-07-01"), AS_OF)
    assert rows(got, "id", "day", "v", "updated_at") == [
        (1, d("2022-06-30"), "a", DAY_ONE),
        (1, d("2022-07-01"), "B", AS_OF),
        (2, d("2022-07-01"), "c", DAY_ONE),
        (3, d("2022-08-02"), "new", AS_OF),
    ]


def test_a_failing_upsert_leaves_the_target_whole(spark, warehouse, rows):
    sources = small_sources(spark)
    load_daily(spark, first_days(sources, "2022-07-10"), warehouse, DAY_ONE, "full_refresh")
    before = rows(warehouse.read("marts", DAILY))
    broken = warehouse.read("marts", DAILY).drop("updated_at").withColumn(
        "neighborhood", F.raise_error(F.lit("lost")).cast("string")
    )
    with pytest.raises(Exception, match="lost"):
        warehouse.upsert(broken, "marts", DAILY, ["listing_id"], d("2022-07-01"), AS_OF)
    assert rows(warehouse.read("marts", DAILY)) == before


def test_a_new_amenity_is_null_in_rows_the_load_left_alone(spark, warehouse, rows):
    sources = small_sources(spark)
    early = changes(
        spark, {"listing_id": 1, "change_at": "2022-01-01 08:00:00", "amenities": ["Wifi"]}
    )
    later = sources.amenities_changelog
    first = first_days(sources, "2022-07-10", early)
    load_daily(spark, first, warehouse, DAY_ONE, "full_refresh")
    run = Lineage(sources.replacing(amenities_changelog=later))
    loaded = load_daily(spark, run, warehouse, AS_OF, "incremental").filter("listing_id = 1")
    flags = loaded.groupBy("Air conditioning").agg(F.min("calendar_date"), F.max("calendar_date"))
    assert rows(flags) == [
        (None, d("2022-05-28"), d("2022-07-02")),
        (True, d("2022-07-03"), d("2022-07-20")),
    ]
    # A full refresh gives history its true value.
    full = load_daily(spark, run, warehouse, AS_OF, "full_refresh").filter("listing_id = 1")
    assert {r[0] for r in full.select("Air conditioning").distinct().collect()} == {True, False}


def test_a_vanished_amenity_leaves_the_table(spark, warehouse):
    sources = small_sources(spark)
    load_daily(spark, first_days(sources, "2022-07-10"), warehouse, DAY_ONE, "full_refresh")
    only_wifi = changes(
        spark, {"listing_id": 1, "change_at": "2022-01-01 08:00:00", "amenities": ["Wifi"]}
    )
    run = Lineage(sources.replacing(amenities_changelog=only_wifi))
    loaded = load_daily(spark, run, warehouse, AS_OF, "incremental")
    assert "Air conditioning" not in loaded.columns


def test_fanned_out_rows_cannot_be_upserted(spark, warehouse):
    run = Lineage(small_sources(spark))
    full = load_daily(spark, run, warehouse, DAY_ONE, "full_refresh", reviews="fanout")
    assert full.count() == run.fct_daily("aggregate").count() + 1
    with pytest.raises(ValueError, match="aggregate"):
        load_daily(spark, run, warehouse, AS_OF, "incremental", reviews="fanout")


def test_the_daily_run(spark, warehouse):
    sources = small_sources(spark)
    early = sources.replacing(
        calendar=sources.calendar.filter(F.col("date") <= F.lit(d("2022-07-10"))).withColumn(
            "_loaded_at", F.lit(DAY_ONE - datetime.timedelta(hours=60))
        )
    )
    with pytest.raises(StaleSourceError):
        run_pipeline(spark, early, warehouse, DAY_ONE)
    early = early.replacing(
        calendar=early.calendar.withColumn(
            "_loaded_at", F.lit(DAY_ONE - datetime.timedelta(hours=30))
        )
    )
    first = run_pipeline(spark, early, warehouse, DAY_ONE)
    assert (first.freshness, first.strategy) == ("warning", "full_refresh")

    fresh = sources.replacing(
        calendar=sources.calendar.withColumn(
            "_loaded_at",
            F.when(F.col("date") > F.lit(d("2022-07-10")), F.lit(AS_OF)).otherwise(
                F.lit(DAY_ONE - datetime.timedelta(days=9))
            ),
        )
    )
    second = run_pipeline(spark, fresh, warehouse, AS_OF, publish=True)
    assert (second.freshness, second.strategy) == ("passed", "incremental")
    assert second.tables[DAILY].count() == 108
    checks = second.checks.collect()
    assert len(checks) == 63
    assert {r.status for r in checks} == {"pass"}
    assert spark.sql("SELECT count(*) FROM problem_1_amenity_revenue").first()[0] > 0
    assert spark.sql(f"SELECT count(*) FROM mart.{DAILY}").first()[0] == 108
    wide = spark.table("mart.dim_listings")
    assert "Air conditioning" in wide.columns and "updated_at" in wide.columns

    late = fresh.replacing(
        calendar=fresh.calendar.withColumn("_loaded_at", F.lit(AS_OF))
    )
    third = run_pipeline(spark, late, warehouse, AS_OF)
    assert third.strategy == "full_refresh"
    assert third.tables[DAILY].select("updated_at").distinct().count() == 1


@pytest.mark.parametrize("source", ["parquet", "json", "csv"])
def test_sources_read_back_from_files(spark, tmp_path, rows, source):
    sources = small_sources(spark)
    options = {"header": "true", "escape": '"'} if source == "csv" else {}
    for name, df in sources.items():
        df.write.format(source).options(**options).save(str(tmp_path / name))
    again = read_sources(spark, str(tmp_path), source)
    for (_, df), (_, copy) in zip(sources.items(), again.items()):
        assert rows(copy) == rows(df)
        assert copy.schema == df.schema


def test_sources_read_from_the_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_lodging")
    for name, df in small_sources(spark).items():
        df.write.mode("overwrite").saveAsTable(f"raw_lodging.{name}")
    assert read_sources(spark, "raw_lodging", "table").calendar.count() == 108


def test_only_the_reprocess_window_is_read(spark, tmp_path):
    """The bound reaches the scan, as folders of a calendar stored by month and as filter."""
    raw = nights(spark, *span(1, "2022-05-01", "2022-07-31"))
    path = str(tmp_path / "calendar")
    raw.write.parquet(path)
    sources = small_sources(spark).replacing(
        calendar=spark.read.parquet(path), generated_reviews=reviews(spark)
    )
    fact = Lineage(sources).fct_daily("aggregate", since=d("2022-07-24"))
    assert fact.count() == 8
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2022-07-24)" in plan
