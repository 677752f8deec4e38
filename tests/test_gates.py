from __future__ import annotations

import datetime

import pytest

from roostline.quality import (
    Check,
    StaleSourceError,
    freshness_gate,
    refresh_decision,
    run_checks,
    schema_drift,
    source_freshness,
)
from roostline.streaming import check_late_arrivals, reprocess_bound
from tests.lodging import AS_OF, listings, nights, small_sources


def loaded(hours):
    return AS_OF - datetime.timedelta(hours=hours)


def freshness(spark, **ages):
    return source_freshness(
        [
            (name, spark.createDataFrame([(loaded(h),), (loaded(h + 9),)], "_loaded_at timestamp"))
            for name, h in ages.items()
        ],
        AS_OF,
    )


def test_freshness_thresholds_differ_by_source(spark):
    frame = freshness(spark, listings=24 * 8, calendar=25, generated_reviews=24)
    assert {r.source: (r.status, r.age_hours) for r in frame.collect()} == {
        "listings": ("warn", 192.0),
        "calendar": ("warn", 25.0),
        "generated_reviews": ("pass", 24.0),
    }
    assert freshness_gate(frame) == "warning"


def test_a_stale_source_blocks_the_run(spark):
    with pytest.raises(StaleSourceError, match="calendar"):
        freshness_gate(freshness(spark, listings=1, calendar=49))
    assert freshness_gate(freshness(spark, listings=1, calendar=24)) == "passed"


def test_a_source_without_load_time_is_an_error(spark):
    bare = spark.range(3)
    empty = spark.createDataFrame([], "_loaded_at timestamp")
    frame = source_freshness([("listings", bare), ("calendar", empty)], AS_OF)
    assert {r.status for r in frame.collect()} == {"error"}


def fact(spark, *days):
    return spark.createDataFrame(
        [(datetime.date.fromisoformat(t), datetime.date.fromisoformat(t).replace(day=1))
         for t in days],
        "calendar_date date, calendar_month date",
    )


def test_late_rows_are_old_nights_loaded_recently(spark):
    calendar = nights(
        spark,
        {"listing_id": 1, "date": "2022-07-23", "_loaded_at": loaded(48)},
        {"listing_id": 2, "date": "2022-07-23", "_loaded_at": loaded(49)},
        {"listing_id": 3, "date": "2022-07-24", "_loaded_at": loaded(1)},
        {"listing_id": 4, "date": "2022-01-01", "_loaded_at": loaded(2)},
        {"listing_id": 5, "date": "2022-01-01", "_loaded_at": None},
    )
    target = fact(spark, "2022-07-31", "2022-07-01")
    assert check_late_arrivals(calendar, target, AS_OF).first().late_count == 2
    wider = check_late_arrivals(calendar, target, AS_OF, window_days=8, lookback_hours=49)
    assert wider.first().late_count == 1
    assert check_late_arrivals(calendar, fact(spark), AS_OF).first().late_count == 0
    bare = calendar.drop("_loaded_at")
    assert check_late_arrivals(bare, target, AS_OF).first().late_count == 0


def test_reprocess_bound(spark):
    bound = reprocess_bound(fact(spark, "2022-06-30", "2022-07-02", "2022-07-03"))
    assert bound == datetime.date(2022, 6, 26)
    assert reprocess_bound(fact(spark)) is None


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "amenity_name string")


def test_drift_reports_additions_and_removals(spark, rows):
    found = schema_drift(
        names(spark, "EV Charger", "Heated Pool", "Wifi"),
        ["listing_id", "Wifi", "Sauna"],
        ["listing_id"],
    )
    assert rows(found) == [
        ("EV Charger", "added"),
        ("Heated Pool", "added"),
        ("Sauna", "removed"),
    ]
    assert schema_drift(names(spark, "a", "b"), []).count() == 2


@pytest.mark.parametrize(
    ("target", "late", "expected"),
    [
        (["a"], 0, "incremental"),
        (["a", "gone"], 0, "incremental"),
        ([], 0, "full_refresh"),
        (["a"], 3, "full_refresh"),
    ],
)
def test_refresh_decision(spark, target, late, expected):
    drift = schema_drift(names(spark, "a"), ["id", *target], ["id"])
    count = spark.createDataFrame([(late,)], "late_count long")
    assert refresh_decision(drift, count).first().strategy == expected


def test_checks_count_failures_and_respect_severity(spark):
    frame = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "z"), (None, "z")], "id int, kind string"
    )
    specs = {
        "t": [
            Check("id", "not_null"),
            Check("id", "not_null", severity="warn"),
            Check("id", "unique"),
            Check("kind", "accepted_values", ("a", "b")),
            Check("kind", "accepted_values", ("a", "b", "z")),
        ]
    }
    found = [(r.test, r.failures, r.status) for r in run_checks({"t": frame}, specs).collect()]
    assert sorted(found) == [
        ("accepted_values", 0, "pass"),
        ("accepted_values", 2, "fail"),
        ("not_null", 2, "fail"),
        ("not_null", 2, "warn"),
        ("unique", 1, "fail"),
    ]


def test_known_source_defects_only_warn(spark):
    sources = small_sources(spark)
    raw = dict(sources.items())
    reviews = raw["generated_reviews"]
    raw["generated_reviews"] = reviews.unionByName(
        reviews.selectExpr("CAST(NULL AS BIGINT) AS id", *reviews.columns[1:])
    )
    raw["listings"] = listings(spark, {"id": 1}, {"id": 1})
    found = run_checks({f"raw.{n}": df for n, df in raw.items()}).collect()
    bad = {(r.table, r.column, r.test): r.status for r in found if r.status != "pass"}
    assert bad == {
        ("raw.generated_reviews", "id", "not_null"): "warn",
        ("raw.listings", "id", "unique"): "fail",
    }
