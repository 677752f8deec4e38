"""Versions of published tables: what stays, what goes, and who wins."""

from __future__ import annotations

import datetime
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from roostline.plans import pipeline
from roostline.plans.pipeline import DAILY, run_pipeline
from roostline.quality import FailedChecksError
from roostline.sinks import ConcurrentLoadError, Warehouse
from tests.lodging import AS_OF, small_sources

NIGHT_KEY = ["id", "day"]


def d(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path), routes={"marts": f"shop{os.urandom(4).hex()}"})


def nights(spark, *values):
    return spark.createDataFrame(
        [(i, d(t), d(t).replace(day=1) if t else None, v) for i, t, v in values],
        "id int, day date, calendar_month date, v string",
    )


def held(df):
    return sorted((r["id"], str(r["day"]), r["v"]) for r in df.collect())


def loads(warehouse):
    return sorted(os.listdir(warehouse.folder("marts", "t") + "/data"))


def test_a_published_version_outlives_later_loads(spark, warehouse):
    warehouse.replace(spark.range(5), "marts", "t", AS_OF)
    shown = warehouse.publish("marts", "t")
    for n in (6, 7, 8):
        warehouse.replace(spark.range(n), "marts", "t", AS_OF)
        assert spark.newSession().table(shown).count() == 5
    assert warehouse.read("marts", "t").count() == 8
    assert len(loads(warehouse)) == 3
    assert warehouse.publish("marts", "t") == shown
    assert spark.table(shown).count() == 8
    # Nothing holds the first version any more.
    warehouse.replace(spark.range(9), "marts", "t", AS_OF)
    assert spark.table(shown).count() == 8 and len(loads(warehouse)) == 2
    database = shown.split(".")[0]
    assert {t.name for t in spark.catalog.listTables(database)} == {"t", "t__v4"}


def test_publishing_turns_one_view(spark, warehouse, monkeypatch):
    """A failure anywhere before the view is turned leaves what was shown."""
    warehouse.replace(nights(spark, (1, "2022-06-30", "a")), "marts", "t", AS_OF, by_month=True)
    shown = warehouse.publish("marts", "t")
    warehouse.upsert(nights(spark, (2, "2022-07-01", "b")), "marts", "t", NIGHT_KEY, d("2022-07-01"), AS_OF)
    real = type(spark).sql

    def failing(session, text, *a, **k):
        if text.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("catalog is away")
        return real(session, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError, match="away"):
        warehouse.publish("marts", "t")
    monkeypatch.undo()
    assert held(spark.table(shown)) == [(1, "2022-06-30", "a")]
    warehouse.publish("marts", "t")
    assert held(spark.table(shown)) == [(1, "2022-06-30", "a"), (2, "2022-07-01", "b")]
    plan = spark.table(shown).filter("calendar_month = DATE'2022-07-01'")
    assert plan.count() == 1
    assert "PartitionFilters: [isnotnull(calendar_month" in plan._jdf.queryExecution().toString()


def test_a_table_of_the_earlier_layout_becomes_a_view(spark, warehouse):
    warehouse.replace(spark.range(2), "marts", "t", AS_OF)
    database = warehouse.routes["marts"]
    spark.sql(f"CREATE DATABASE {database}")
    spark.range(9).write.saveAsTable(f"{database}.t")
    assert spark.table(warehouse.publish("marts", "t")).count() == 2


def test_of_two_overlapping_loads_one_raises(spark, warehouse):
    first = nights(spark, (1, "2022-06-30", "a"), (2, "2022-07-01", "b"))
    warehouse.replace(first, "marts", "t", AS_OF, by_month=True)
    one = warehouse.prepare_upsert(
        nights(spark, (2, "2022-07-01", "B")), "marts", "t", NIGHT_KEY, d("2022-07-01"), AS_OF
    )
    two = warehouse.prepare_upsert(
        nights(spark, (3, "2022-07-05", "c")), "marts", "t", NIGHT_KEY, d("2022-07-01"), AS_OF
    )
    warehouse.commit(two)
    with pytest.raises(ConcurrentLoadError):
        warehouse.commit(one)
    assert held(warehouse.read("marts", "t")) == [
        (1, "2022-06-30", "a"),
        (2, "2022-07-01", "b"),
        (3, "2022-07-05", "c"),
    ]
    assert f"load={one.load}" not in loads(warehouse)


def test_many_loads_at_once_lose_no_committed_row(spark, warehouse):
    warehouse.replace(nights(spark, (0, "2022-06-30", "a")), "marts", "t", AS_OF, by_month=True)

    def load(i):
        rows = nights(spark, (i, "2022-07-01", "x"))
        try:
            warehouse.upsert(rows, "marts", "t", NIGHT_KEY, d("2022-07-01"), AS_OF)
        except ConcurrentLoadError:
            return None
        return i

    with ThreadPoolExecutor(4) as pool:
        done = [i for i in pool.map(load, range(1, 9)) if i is not None]
    assert done
    assert [r[0] for r in held(warehouse.read("marts", "t"))] == [0, *sorted(done)]


def test_a_failure_before_the_switch_leaves_all_months(spark, warehouse, monkeypatch):
    old = nights(spark, (1, "2022-06-30", "a"), (2, "2022-07-01", "b"), (3, "2022-08-01", "c"))
    warehouse.replace(old, "marts", "t", AS_OF, by_month=True)
    before, kept = held(warehouse.read("marts", "t")), loads(warehouse)
    fresh = nights(spark, (2, "2022-07-01", "B"), (3, "2022-08-01", "C"))
    # All months are written, the switch fails.
    from roostline.sinks.manifests import Files

    monkeypatch.setattr(Files, "create", lambda *a: (_ for _ in ()).throw(OSError("store is away")))
    with pytest.raises(OSError, match="away"):
        warehouse.upsert(fresh, "marts", "t", NIGHT_KEY, d("2022-07-01"), AS_OF)
    monkeypatch.undo()
    assert held(warehouse.read("marts", "t")) == before and loads(warehouse) == kept
    # One month is written, the next fails.
    broken = fresh.withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise("B"))
    with pytest.raises(Exception, match="lost"):
        warehouse.upsert(broken, "marts", "t", NIGHT_KEY, d("2022-07-01"), AS_OF)
    assert held(warehouse.read("marts", "t")) == before and loads(warehouse) == kept


def test_months_without_a_date_and_new_columns(spark, warehouse):
    old = nights(spark, (1, "2022-06-30", "a"), (2, "2022-07-01", "b")).union(
        spark.sql("SELECT 3, CAST(NULL AS DATE), CAST(NULL AS DATE), 'no day'")
    )
    warehouse.replace(old, "marts", "t", AS_OF, by_month=True)
    fresh = nights(spark, (2, "2022-07-02", "x")).withColumn("Wifi", F.lit(True)).drop("v")
    got = warehouse.upsert(fresh, "marts", "t", NIGHT_KEY, d("2022-07-01"), AS_OF)
    assert sorted((r["id"], str(r["Wifi"])) for r in got.collect()) == [
        (1, "None"),
        (2, "None"),
        (2, "True"),
        (3, "None"),
    ]
    assert "v" not in got.columns
    assert warehouse.newest_month("marts", "t") == d("2022-07-01")
    assert spark.table(warehouse.publish("marts", "t")).count() == 4


def test_an_unfinished_manifest_is_no_version(spark, warehouse):
    warehouse.replace(spark.range(3), "marts", "t", AS_OF)
    path = f"{warehouse.folder('marts', 't')}/_manifests/{2:020d}"
    with open(path, "w") as f:
        f.write('{"schema": {"fie')
    assert warehouse.read("marts", "t").count() == 3
    assert warehouse.replace(spark.range(4), "marts", "t", AS_OF).count() == 4
    assert warehouse.versions("marts", "t").numbers() == [1, 2, 3]


def test_readers_and_leftovers(spark, warehouse):
    warehouse.replace(spark.range(3), "marts", "t", AS_OF)
    with warehouse.reading("marts", "t") as df:
        for n in (4, 5, 6):
            warehouse.replace(spark.range(n), "marts", "t", AS_OF)
        assert df.count() == 3
    table = warehouse.versions("marts", "t")
    running = warehouse.prepare(spark.range(1), "marts", "t", AS_OF)
    table.remove_old()
    # The reader is gone; files of a load that still runs stay, old ones without a version go.
    assert len(loads(warehouse)) == 3 and running.df.count() == 1
    table.remove_old(leftover_seconds=-1)
    assert len(loads(warehouse)) == 2


def test_a_failing_gate_changes_nothing_visible(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path), routes={"marts": "gated"})
    run_pipeline(spark, small_sources(spark), warehouse, AS_OF, publish=True)
    before = sorted(map(str, warehouse.read("marts", DAILY).collect()))
    later = AS_OF + datetime.timedelta(days=1)
    gate, calls = pipeline.checks_gate, []

    def failing(results):
        calls.append(results)
        if len(calls) == 2:
            raise FailedChecksError("marts")
        return gate(results)

    monkeypatch.setattr(pipeline, "checks_gate", failing)
    with pytest.raises(FailedChecksError):
        run_pipeline(spark, small_sources(spark), warehouse, later, publish=True)
    assert len(calls) == 2
    assert sorted(map(str, warehouse.read("marts", DAILY).collect())) == before
    assert sorted(map(str, spark.table(f"gated.{DAILY}").collect())) == before
    for name in os.listdir(tmp_path / "gated"):
        assert len(os.listdir(tmp_path / "gated" / name / "data")) == 1
