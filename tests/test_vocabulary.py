"""The kept vocabulary, measures taken on write, and the sketch of hot keys."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from roostline.operators.skew import hot_hashes, left_join_hot_right
from roostline.plans import pipeline
from roostline.plans.pipeline import DAILY, Lineage, run_pipeline
from roostline.plans.vocabulary import NAME, new_events, rebuild_vocabulary, refresh_vocabulary
from roostline.quality import run_checks
from roostline.sinks import Warehouse
from tests.lodging import AS_OF, changes, small_sources

START = datetime.datetime(2022, 1, 1)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def log(spark, *events):
    """Events (hour of loading or None, names)."""
    frame = changes(
        spark, *[{"listing_id": 1, "change_at": "2022-01-01 08:00:00", "amenities": names} for _, names in events]
    )
    hours = [h for h, _ in events]
    numbered = frame.rdd.zipWithIndex().map(lambda x: (*x[0][:3], x[1])).toDF("listing_id long, change_at timestamp, amenities string, n long")
    times = F.element_at(F.array(*[F.lit(None if h is None else START + datetime.timedelta(hours=h)) for h in hours]), (F.col("n") + 1).cast("int"))
    return numbered.select("listing_id", "change_at", "amenities", times.cast("timestamp").alias("_loaded_at"))


def test_several_loads_equal_the_full_scan(spark, warehouse):
    events = [(0, ["Wifi"]), (1, ["Pool", "it's"]), (1, ["WiFi"]), (2, []), (3, ["Sauna"]), (None, ["Undated"])]
    for upto in (1, 2, 3, 4, 6, 6):
        seen = log(spark, *events[:upto])
        names = refresh_vocabulary(warehouse, seen, AS_OF)
        full = {n for _, listed in events[:upto] for n in listed}
        assert names == sorted(full)
    # The last load found nothing new: no new version.
    assert warehouse.versions("intermediate", NAME).numbers()[-1] == 5
    assert rebuild_vocabulary(warehouse, log(spark, (9, ["Only"])), AS_OF) == ["Only"]


def test_only_new_events_are_read(spark, warehouse, tmp_path):
    path = str(tmp_path / "log")
    log(spark, (0, ["Wifi"]), (5, ["Pool"])).write.parquet(path)
    stored = spark.read.parquet(path)
    refresh_vocabulary(warehouse, stored, AS_OF)
    plan = new_events(stored, START + datetime.timedelta(hours=5))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(_loaded_at" in plan


def test_empty_and_nameless_logs(spark, warehouse):
    assert refresh_vocabulary(warehouse, log(spark, (0, ["x"])).limit(0), AS_OF) == []
    assert refresh_vocabulary(warehouse, log(spark, (4, [])), AS_OF) == []
    assert warehouse.read("intermediate", NAME).first()["seen_until"] == START + datetime.timedelta(hours=4)


def test_a_run_with_a_kept_vocabulary(spark, warehouse):
    sources = small_sources(spark)
    result = run_pipeline(spark, sources, warehouse, AS_OF, keep_vocabulary=True)
    again = run_pipeline(spark, sources, warehouse, AS_OF, keep_vocabulary=True)
    names = Lineage(sources).amenity_names()
    assert set(names) <= set(result.tables[DAILY].columns) & set(again.tables[DAILY].columns)


def test_marts_are_measured_while_written(spark, warehouse, monkeypatch):
    """The checks of marts read them again for uniqueness only, with the results of a full read."""
    sources = small_sources(spark)
    for strategy in ("full_refresh", "incremental"):
        if strategy == "incremental":
            # Nothing arrived late: loaded before the last 48 hours.
            old = F.lit(AS_OF - datetime.timedelta(hours=49)).cast("timestamp")
            sources = sources.replacing(calendar=sources.calendar.withColumn("_loaded_at", old))
            monkeypatch.setattr(pipeline, "freshness_gate", lambda found: "passed")
        result = run_pipeline(spark, sources, warehouse, AS_OF)
        assert result.strategy == strategy
        files = result.checks.inputFiles()
        assert not [f for f in files if f"/{DAILY}/" in f or "/fct_monthly" in f]
        assert [f for f in files if "/dim_hosts/" in f]
        marts = {n: df for n, df in result.tables.items() if n in (DAILY, "dim_date", "dim_hosts", "dim_listings")}
        full = {tuple(r) for r in run_checks(marts).collect()}
        assert full <= {tuple(r) for r in result.checks.collect()}


def test_measures_of_failures_are_not_carried_over(spark, warehouse):
    def rows(*values):
        return spark.createDataFrame(
            [(i, datetime.date(2022, m, 1), datetime.date(2022, m, 1), v) for i, m, v in values],
            "id int, day date, calendar_month date, v string",
        )

    measures = {"not_null v": F.count_if(F.col("v").isNull()), "not_null id": F.count_if(F.col("id").isNull())}
    first = warehouse.prepare(rows((1, 6, None), (1, 7, "a")), "marts", "t", AS_OF, True, measures=measures)
    warehouse.commit(first)
    assert first.manifest.measured == {"not_null v": 1, "not_null id": 0}
    second = warehouse.prepare_upsert(
        rows((2, 7, "b")), "marts", "t", ["id", "day"], datetime.date(2022, 7, 1), AS_OF, measures=measures
    )
    # June still has a failure that this load has not seen: that check has to read the table.
    assert second.manifest.measured == {"not_null id": 0}


def test_hot_keys_are_found_by_the_sketch(spark):
    right = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    assert len(hot_hashes(right, [F.col("k")], 10_000)) == 1
    assert hot_hashes(right, [F.col("k")], 30_000) == []
    left = spark.createDataFrame([(7,), (8,), (None,), (-1,), (7,)], "k bigint")
    got = left_join_hot_right(left, right, ["k"], 10_000, 8)
    assert "__salt" in got._jdf.queryExecution().optimizedPlan().toString()
    want = left.join(right, ["k"], "left")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    plain = left_join_hot_right(left, right, ["k"], 30_000)
    assert "__salt" not in plain._jdf.queryExecution().optimizedPlan().toString()
