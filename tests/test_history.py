from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from roostline.plans import dimensions, intermediate, staging
from tests.lodging import changes, listings, nights, span


def d(text):
    return datetime.date.fromisoformat(text)


def test_spans_apply_the_night_limits(spark, rows):
    raw = nights(
        spark,
        *span(1, "2022-01-01", "2022-01-03", minimum_nights=2),
        *span(1, "2022-01-05", "2022-01-05", minimum_nights=2),
        *span(2, "2022-01-01", "2022-01-09", minimum_nights=None, maximum_nights=4),
        *span(2, "2022-01-10", "2022-01-10", minimum_nights=3, maximum_nights=9),
        *span(3, "2022-01-01", "2022-01-02", maximum_nights=None),
        *span(4, "2022-01-01", "2022-01-02", available="f"),
        *span(9, "2022-01-01", "2022-01-02"),
    )
    staged = staging.stg_listings(listings(spark, *[{"id": i} for i in (1, 2, 3, 4)]))
    spans = intermediate.availability_spans(staging.stg_calendar(raw), staged)
    assert rows(
        spans,
        "listing_id",
        "span_start_date",
        "consecutive_available_days",
        "min_nights_required",
        "max_nights_allowed",
        "effective_max_stay_nights",
        "is_bookable",
    ) == [
        (1, d("2022-01-01"), 3, 2, None, 3, True),
        (1, d("2022-01-05"), 1, 2, None, 0, False),
        # The strictest limits of the run: largest minimum, smallest maximum.
        (2, d("2022-01-01"), 10, 3, 4, 4, True),
        (3, d("2022-01-01"), 2, 1, None, 2, True),
    ]


def test_latest_host_record_wins_and_null_dates_lose(spark):
    staged = staging.stg_listings(
        listings(
            spark,
            {"id": 1, "host_name": "old", "first_review": "2020-01-01"},
            {"id": 2, "host_name": "new", "first_review": "2021-01-01"},
            {"id": 3, "host_name": "zzz", "first_review": None},
            {"id": 4, "host_id": 5, "host_since": None},
            {"id": 6, "host_id": None},
        )
    )
    hosts = {r.host_id: r for r in intermediate.hosts_history(staged).collect()}
    assert set(hosts) == {1, 5}
    assert hosts[1].host_name == "new"
    assert hosts[1].valid_from == d("2015-05-01")
    assert hosts[5].valid_from == d("1900-01-01")
    assert hosts[5].valid_to == d("9999-12-31")


def history(spark):
    staged = staging.stg_listings(
        listings(spark, {"id": 1}, {"id": 2}, {"id": 3, "first_review": None})
    )
    raw = changes(
        spark,
        {"listing_id": 1, "change_at": "2022-01-01 08:00:00", "amenities": ["Wifi"]},
        {"listing_id": 1, "change_at": "2022-03-15 08:00:00", "amenities": ["AC"]},
    )
    scd = intermediate.listing_amenities_scd(staging.stg_amenities_changelog(raw))
    return intermediate.listings_history(staged, scd), scd


def test_listing_periods_start_on_changes_or_on_creation(spark, rows):
    periods, _ = history(spark)
    assert rows(periods, "listing_id", "valid_from", "valid_to", "is_current") == [
        (1, d("2022-01-01"), d("2022-03-14"), False),
        (1, d("2022-03-15"), d("9999-12-31"), True),
        (2, d("2021-01-15"), d("9999-12-31"), True),
        (3, d("2020-01-01"), d("9999-12-31"), True),
    ]


def test_dimension_without_changes_reads_every_amenity_as_false(spark, rows):
    periods, scd = history(spark)
    dimension = dimensions.dim_listings(periods, scd)
    assert rows(dimension, "listing_id", "valid_from", "amenities") == [
        (1, d("2022-01-01"), ["Wifi"]),
        (1, d("2022-03-15"), ["AC"]),
        (2, d("2021-01-15"), []),
        (3, d("2020-01-01"), []),
    ]


def test_tiers_send_null_to_the_last_label(spark):
    staged = staging.stg_listings(
        listings(
            spark,
            {"id": 1, "price": None, "accommodates": None, "review_scores_rating": None},
            {"id": 2, "price": "$49.99", "accommodates": 2, "review_scores_rating": 4.8},
            {"id": 3, "price": "$50", "accommodates": 3, "review_scores_rating": 4.79},
            {"id": 4, "price": "$499.99", "accommodates": 6, "review_scores_rating": 3.0},
            {"id": 5, "price": "$500", "accommodates": 7, "review_scores_rating": 2.9},
        )
    )
    scd = intermediate.listing_amenities_scd(
        staging.stg_amenities_changelog(
            changes(
                spark, {"listing_id": 77, "change_at": "2022-01-01 00:00:00", "amenities": ["x"]}
            )
        )
    )
    tiers = dimensions.dim_listings(intermediate.listings_history(staged, scd), scd)
    found = {
        r.listing_id: (r.capacity_tier, r.price_tier, r.rating_tier) for r in tiers.collect()
    }
    assert found == {
        1: ("Extra Large (7+)", "Luxury", "Below Average"),
        2: ("Small (1-2)", "Budget", "Exceptional"),
        3: ("Medium (3-4)", "Economy", "Excellent"),
        4: ("Large (5-6)", "Premium", "Average"),
        5: ("Extra Large (7+)", "Luxury", "Below Average"),
    }


def test_host_tenure_counts_calendar_years(spark):
    staged = staging.stg_listings(
        listings(
            spark,
            {"id": 1, "host_id": 1, "host_since": "2021-12-31"},
            {"id": 2, "host_id": 2, "host_since": "2022-01-01"},
            {"id": 3, "host_id": 3, "host_since": "2019-06-01"},
            {"id": 4, "host_id": 4, "host_since": None},
        )
    )
    hosts = dimensions.dim_hosts(intermediate.hosts_history(staged), "2022-01-01")
    found = {r.host_id: (r.host_tenure_years, r.host_experience_tier) for r in hosts.collect()}
    assert found == {
        1: (1, "Established Host"),
        2: (0, "New Host"),
        3: (3, "Veteran Host"),
        4: (None, "Veteran Host"),
    }


def test_date_dimension(spark):
    days = dimensions.dim_date(spark, "2022-08-01")
    assert days.count() == 4018
    row = {
        r.date_iso: r
        for r in days.filter(
            F.col("date_iso").isin("2022-01-02", "2022-03-31", "2022-07-04", "2022-12-31")
        ).collect()
    }
    sunday = row["2022-01-02"]
    assert (sunday.day_of_week, sunday.day_name, sunday.week_of_year) == (0, "Sun", 52)
    assert sunday.week_start_date == d("2021-12-27") and sunday.week_end_date == d("2022-01-02")
    assert (sunday.fiscal_year, sunday.fiscal_quarter, sunday.quarter_name) == (2021, 4, "Q1")
    assert row["2022-03-31"].same_day_last_month == d("2022-02-28")
    holiday = row["2022-07-04"]
    assert holiday.is_holiday and holiday.holiday_name == "Independence Day"
    assert (holiday.fiscal_year, holiday.fiscal_quarter, holiday.days_ago) == (2022, 2, 28)
    assert row["2022-12-31"].season == "Winter" and not row["2022-12-31"].is_peak_season


def test_date_dimension_takes_other_holidays_and_fiscal_years(spark):
    holidays = spark.createDataFrame(
        [(d("2022-02-03"), "Snow Day")], "date_day date, holiday_name string"
    )
    days = dimensions.dim_date(
        spark, "2022-08-01", "2022-02-01", "2022-02-05", holidays, fiscal_start_month=2
    )
    found = [(r.date_day.day, r.is_peak_season, r.fiscal_year, r.fiscal_quarter)
             for r in days.orderBy("date_day").collect()]
    assert found == [
        (1, False, 2022, 1),
        (2, False, 2022, 1),
        (3, True, 2022, 1),
        (4, False, 2022, 1),
        (5, False, 2022, 1),
    ]
