"""Cases the derived sources do not hold: undated changes, movers, repeated keys, failures."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roostline.functions import known_names, widen
from roostline.operators import as_of_join, continuous_periods, scd2_intervals
from roostline.plans import analyses, facts
from roostline.plans.pipeline import DAILY, Lineage, load_daily, run_pipeline
from roostline.quality import FailedChecksError, checks_gate, run_checks
from roostline.session import tune
from roostline.sinks import RepeatedKeyError, Warehouse
from tests.lodging import AS_OF, changes, listings, nights, reviews, small_sources, span


def d(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def test_an_undated_change_doubles_no_night(spark):
    entities = spark.createDataFrame([(1, ["Pool"])], "id int, amenities array<string>")
    history = spark.createDataFrame(
        [(1, d("2022-01-01"), ["Wifi"]), (1, None, ["Spa"]), (1, d("2022-02-01"), ["Wifi", "AC"])],
        "id int, changed date, amenities array<string>",
    )
    periods = scd2_intervals(history, "id", "changed")
    ends = {r["valid_from"]: r["valid_to"] for r in periods.collect()}
    assert ends[d("2022-01-01")] == d("2022-01-31")
    assert ends[d("2022-02-01")] == d("9999-12-31")
    days = spark.createDataFrame([(1, d("2022-01-15")), (1, d("2021-05-01"))], "id int, day date")
    full = continuous_periods(entities, periods, "id", "amenities").withColumnRenamed("id", "__id")
    joined = days.join(full, F.expr("id = __id AND day BETWEEN valid_from AND valid_to"))
    assert sorted((r["day"], r["amenities"]) for r in joined.collect()) == [
        (d("2021-05-01"), ["Pool"]),
        (d("2022-01-15"), ["Wifi"]),
    ]
    found = as_of_join(days, periods, "id", "day", "left").collect()
    assert sorted((r["day"], r["amenities"]) for r in found) == [
        (d("2021-05-01"), None),
        (d("2022-01-15"), ["Wifi"]),
    ]


def test_a_listing_that_moved_counts_in_both_neighborhoods(spark):
    rows = [(1, "Old", d("2021-07-12"), Decimal(100)), (1, "New", d("2022-07-11"), Decimal(150))]
    fact = spark.createDataFrame(
        rows, "listing_id long, neighborhood string, calendar_date date, adjusted_price decimal(10,2)"
    )
    report = {r["Neighborhood"]: r for r in analyses.neighborhood_pricing(fact).collect()}
    assert set(report) == {"Old", "New"}
    assert all(r["Avg Price Increase ($)"] == 50.0 and r["Rank by Increase"] == 1 for r in report.values())
    assert analyses.listing_price_changes(fact).count() == 2


def test_a_night_with_three_reviews_counts_three(spark):
    sources = small_sources(spark).replacing(
        generated_reviews=reviews(
            spark,
            *[
                {"id": i, "listing_id": 1, "review_date": "2022-07-18", "review_score": s}
                for i, s in ((1, 5.0), (2, 4.0), (3, 4.0))
            ],
        )
    )
    fact = Lineage(sources).fct_daily("aggregate")
    july = "listing_id = 1 AND calendar_month = DATE '2022-07-01'"
    month = facts.fct_monthly_listing(fact).filter(july).first()
    assert (month.review_count, month.total_review_score) == (3, 13.0)
    place = facts.fct_monthly_neighborhood(fact).filter("neighborhood = 'Back Bay'")
    assert place.filter("calendar_month = DATE '2022-07-01'").first().total_reviews == 3


def test_the_exact_median_of_even_and_odd_counts(spark):
    rows = [("a", p) for p in (1, 2, 3, 10)] + [("b", p) for p in (5, 5, 7)] + [("c", None)]
    nights_ = spark.createDataFrame(rows, "g string, adjusted_price int")
    got = {r["g"]: r["median_nightly_rate"] for r in facts._exact_medians(nights_, ["g"]).collect()}
    assert got == {"a": 2.5, "b": 5.0}


def test_a_failing_replace_leaves_the_table(spark, warehouse):
    good = spark.range(3)
    warehouse.replace(good, "marts", "t", AS_OF)
    broken = spark.range(3).withColumn("id", F.expr("raise_error('broken')").cast("long"))
    with pytest.raises(Exception, match="broken"):
        warehouse.replace(broken, "marts", "t", AS_OF)
    assert warehouse.exists("marts", "t") and warehouse.read("marts", "t").count() == 3
    for n in (5, 6, 7):
        warehouse.replace(spark.range(n), "marts", "t", AS_OF)
    assert warehouse.read("marts", "t").count() == 7
    import os

    assert len(os.listdir(warehouse.folder("marts", "t") + "/data")) == 2
    assert not warehouse.exists("marts", "other")


def test_repeated_keys_stop_an_upsert_and_leave_no_scratch(spark, warehouse, tmp_path):
    rows = [(1, d("2022-07-02"), d("2022-07-01"))]
    schema = "id int, day date, calendar_month date"
    warehouse.replace(spark.createDataFrame(rows, schema), "marts", "t", AS_OF, by_month=True)
    with pytest.raises(RepeatedKeyError, match="'id': 1"):
        warehouse.upsert(
            spark.createDataFrame(rows * 2, schema), "marts", "t", ["id", "day"], d("2022-07-01"), AS_OF
        )
    assert warehouse.read("marts", "t").count() == 1


def test_the_check_gate(spark, warehouse):
    sources = small_sources(spark)
    doubled = sources.replacing(listings=sources.listings.union(sources.listings))
    with pytest.raises(FailedChecksError, match="raw.listings.id unique"):
        run_pipeline(spark, doubled, warehouse, AS_OF)
    assert not warehouse.exists("marts", "dim_date")
    unnamed = sources.replacing(
        generated_reviews=reviews(
            spark, {"id": None, "listing_id": 1, "review_date": "2022-07-18", "review_score": 5.0}
        )
    )
    assert checks_gate(run_checks({"raw.generated_reviews": unnamed.generated_reviews})) == "warning"
    assert checks_gate(run_checks({"raw.listings": sources.listings})) == "passed"


def test_names_that_differ_by_case_are_separate_columns(spark, warehouse):
    tune(spark)
    sources = small_sources(spark).replacing(
        listings=listings(spark, {"id": 1, "amenities": '["Wifi","WiFi","Beds"]'}, {"id": 2}),
        amenities_changelog=changes(
            spark, {"listing_id": 1, "change_at": "2022-01-01 08:00:00", "amenities": ["Wifi", "Beds"]},
            {"listing_id": 2, "change_at": "2022-01-01 08:00:00", "amenities": ["WiFi"]},
        ),
    )
    run = Lineage(sources)
    assert run.amenity_names() == ["Beds", "WiFi", "Wifi"]
    loaded = load_daily(spark, run, warehouse, AS_OF, "full_refresh")
    assert {"beds", "Beds", "WiFi", "Wifi"} <= set(loaded.columns)
    flags = {r["listing_id"]: (r["Wifi"], r["WiFi"], r["Beds"]) for r in loaded.collect()}
    assert flags == {1: (True, False, True), 2: (False, True, False)}


def test_an_array_fact_needs_no_vocabulary(spark, warehouse, monkeypatch):
    monkeypatch.setattr(Lineage, "amenity_names", lambda self: pytest.fail("vocabulary collected"))
    monkeypatch.setattr(Lineage, "listing_amenity_names", lambda self: pytest.fail("vocabulary collected"))
    result = run_pipeline(spark, small_sources(spark), warehouse, AS_OF, wide=False)
    fact = result.tables[DAILY]
    assert dict(fact.dtypes)["amenities"] == "array<string>"
    assert result.tables["problem_1_amenity_revenue"].count() > 0
    again = run_pipeline(spark, small_sources(spark), warehouse, AS_OF, wide=False)
    assert again.tables[DAILY].count() == fact.count()


def test_known_names(spark):
    frame = spark.createDataFrame([(["AC", "Pool"],), (None,), (["Pool"],)], "amenities array<string>")
    assert known_names(frame, ["A/C", "AC"]) == ["AC"]
    assert widen(frame, ["AC"]).columns == ["AC"]


def test_nights_beyond_the_date_dimension_are_left_out_of_revenue(spark):
    from roostline.plans import dimensions

    sources = small_sources(spark).replacing(
        calendar=nights(
            spark,
            *span(1, "2022-07-01", "2022-07-02", available="f", reservation_id=9),
            *span(1, "2031-01-01", "2031-01-02", available="f", reservation_id=9),
        )
    )
    dates = dimensions.dim_date(spark, "2022-08-01")
    revenue = analyses.amenity_revenue(Lineage(sources).fct_daily("aggregate"), dates, ["Air conditioning"])
    assert {r["calendar_month"] for r in revenue.collect()} == {d("2022-07-01")}
