"""Sources that are written once: their nights stay where they lie, and little is left on disk."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from roostline.plans import intermediate
from roostline.session import staged_dealt
from roostline.sinks import Warehouse

# Sizes say nothing about the tiny tables of this test.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Five suppliers with order lines in the first half of 1995, one line in six returned."""
    root = tmp_path_factory.mktemp("tables")
    number = F.col("id")
    spark.createDataFrame([(0, "ANY")], "n_nationkey int, n_name string").write.parquet(f"{root}/nation.parquet")
    spark.range(5).selectExpr(
        "id AS s_suppkey", "concat('S', id) AS s_name", "0 AS s_nationkey", "100.0D AS s_acctbal"
    ).write.parquet(f"{root}/supplier.parquet")
    spark.createDataFrame(
        [(0, "SMALL"), (1, "PROMO"), (2, "STANDARD")], "p_partkey long, p_type string"
    ).write.parquet(f"{root}/part.parquet")
    spark.range(300).select(
        number.alias("l_orderkey"),
        (number % 5).alias("l_suppkey"),
        (number % 3).alias("l_partkey"),
        ((number % 4) + 1).cast("int").alias("l_linenumber"),
        F.when(number % 6 == 0, "R").otherwise("N").alias("l_returnflag"),
        F.expr("CAST(date_add(DATE'1995-01-02', CAST(id * 7 % 180 AS INT)) AS TIMESTAMP)").alias("l_shipdate"),
    ).write.parquet(f"{root}/lineitem.parquet")
    return str(root)


@pytest.fixture
def large(spark):
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield
    for key in LARGE:
        spark.conf.unset(key)


def above(df, scanned):
    """Per scan of a table, the operators above it, lowest first."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depths = [next((i for i, c in enumerate(line) if c.isalnum()), 0) for line in lines]
    paths = []
    for n, line in enumerate(lines):
        if "Scan parquet" in line and scanned in line:
            path, depth = [], depths[n]
            for at in range(n - 1, -1, -1):
                if depths[at] < depth:
                    depth = depths[at]
                    path.append(lines[at].lstrip(" :+-*").split("(")[0].split()[0])
            paths.append(path)
    assert paths
    return paths


def moved_nights(df):
    """Scans whose nights are dealt or sorted anew before they are joined, grouped or numbered."""
    moved = 0
    for path in above(df, "roostline-calendar"):
        for name in path:
            if name.endswith("Join") or name.endswith("Aggregate") or name == "Window":
                break
            moved += name == "Exchange"
    return moved


def test_stored_nights_are_not_dealt_again(spark, sf_dir, large):
    """every table of the checks meets the nights where they lie."""
    run = entry._stored_lineage(spark, sf_dir)
    assert moved_nights(run.fct_daily("fanout")) == 0
    assert moved_nights(run.fct_daily("aggregate", ["Wifi"])) == 0
    assert moved_nights(run.spans()) == 0
    assert moved_nights(
        intermediate.calendar_enriched(run.calendar, run.listings, run.scd, dated=run.dated)
    ) == 0


def test_stored_nights_give_the_same_rows(spark, sf_dir, rows):
    stored, derived = entry._stored_lineage(spark, sf_dir), entry._lineage(spark, sf_dir)
    assert rows(stored.fct_daily("fanout")) == rows(derived.fct_daily("fanout"))
    assert rows(stored.spans()) == rows(derived.spans())


def test_all_gates_read_one_run_of_the_checks(spark, sf_dir):
    """the gates read written results and written sources, nothing is derived again."""
    verdicts = entry.gate_verdicts(spark, sf_dir)
    files = verdicts.inputFiles()
    assert any("roostline-checks" in f for f in files)
    assert not any("lineitem" in f for f in files)
    assert {r["gate"] for r in verdicts.collect()} == {"freshness", "source_checks", "checks"}


@pytest.mark.parametrize("first", [entry._first_load, lambda run: entry._without_amenity(entry._first_load(run), "Wifi")])
def test_a_load_by_month_sorts_no_wide_rows(spark, sf_dir, large, first):
    """nights come to the writer by month. Sorted there, whole rows went to disk."""
    run = first(entry._stored_lineage(spark, sf_dir))
    fact = run.fct_daily("aggregate", ["Kitchen", "Lockbox"])
    written = fact.sortWithinPartitions("calendar_month")
    for path in above(written, "roostline-calendar"):
        last_join = max(n for n, name in enumerate(path) if name.endswith("Join"))
        assert "Sort" not in path[last_join:] and "Exchange" not in path[last_join:]
    assert moved_nights(written) == 0


def test_a_load_leaves_no_shuffle_files(spark, tmp_path):
    """those of the first load are gone before the next one writes its own."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = manager.getAllBlocks()
        return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}

    before = shuffles()
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.range(100).repartition(3, "id")
    warehouse.replace(rows, "marts", "t", entry.AS_OF)
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before


def test_rows_dealt_into_buckets(spark, rows, large):
    numbers = spark.range(200).selectExpr(
        "if(id % 7 = 0, NULL, id % 11) AS k", "date_add(DATE'2022-01-01', int(id % 13)) AS d", "id AS v"
    )
    tables = {t.name for t in spark.catalog.listTables()}
    table, _ = staged_dealt(numbers, "numbers", "d", "k")
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert rows(table) == rows(numbers)
    sums = table.groupBy("k", "d").agg(F.sum("v").alias("v"))
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    assert rows(sums) == rows(numbers.groupBy("k", "d").agg(F.sum("v").alias("v")))
    # One file for each bucket that has rows.
    assert len(table.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
