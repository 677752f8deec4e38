from __future__ import annotations

import datetime
import statistics

import pytest
from pyspark.sql import functions as F

from roostline.plans import analyses, dimensions
from roostline.plans.pipeline import Lineage
from tests.lodging import changes, listings, nights, reviews, small_sources, span


def d(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture(scope="module")
def dim_date(spark):
    return dimensions.dim_date(spark, "2022-08-01")


def revenue_fact(spark, *rows):
    """Rows of (date, listing, revenue, amenities)."""
    return spark.createDataFrame(
        [(d(t), d(t).replace(day=1), i, r, 1, a) for t, i, r, a in rows],
        "calendar_date date, calendar_month date, listing_id long, revenue double, "
        "is_occupied int, amenities array<string>",
    ).withColumn("daily_revenue", F.col("revenue").cast("decimal(10,2)"))


def test_revenue_shares_by_segment(spark, dim_date):
    fact = revenue_fact(
        spark,
        ("2022-07-01", 1, 45230.0, ["Air conditioning"]),
        ("2022-07-02", 2, 12150.0, ["Wifi"]),
        ("2021-07-02", 2, 10000.0, ["Wifi"]),
        ("2020-07-02", 3, 0.0, None),
        ("2035-07-02", 3, 77.0, None),
    )
    found = analyses.amenity_revenue(fact, dim_date, ["Air conditioning", "Wifi"]).collect()
    assert [(r.calendar_month.year, r.ac_segment, r.pct_of_monthly_revenue) for r in found] == [
        # A NULL flag is a group of its own under the same label; 2035 has no date row.
        (2020, "Without AC", None),
        (2021, "Without AC", 100.0),
        (2022, "With AC", 78.8),
        (2022, "Without AC", 21.2),
    ]
    assert found[0].has_air_conditioning is None
    assert (found[3].yoy_revenue_change_pct, found[3].listing_count) == (21.5, 1)
    assert found[2].yoy_revenue_change_pct is None
    assert (found[3].season, found[3].fiscal_year, found[3].month_name) == ("Summer", 2022, "Jul")
    assert found[3].ac_column_used == "Air conditioning"


def test_other_spellings_and_unknown_amenity(spark, dim_date):
    fact = revenue_fact(spark, ("2022-07-01", 1, 10.0, ["A/C"]))
    used = analyses.amenity_revenue(fact, dim_date, ["A/C"]).first()
    assert (used.ac_column_used, used.ac_segment) == ("A/C", "With AC")
    unknown = analyses.amenity_revenue(fact, dim_date, ["Pool"]).first()
    assert (unknown.ac_column_used, unknown.has_air_conditioning) == ("NULL", None)


def test_revenue_of_a_published_wide_fact(spark, dim_date):
    fact = revenue_fact(spark, ("2022-07-01", 1, 10.0, None)).drop("amenities")
    wide = fact.withColumn("Air conditioning", F.lit(True))
    row = analyses.amenity_revenue(wide, dim_date, ["Air conditioning"]).first()
    assert row.ac_segment == "With AC"


def price_fact(spark, *rows):
    """Rows of (listing, neighborhood, date, price)."""
    return spark.createDataFrame(
        [(i, n, d(t), p) for i, n, t, p in rows],
        "listing_id long, neighborhood string, calendar_date date, price double",
    ).withColumn("adjusted_price", F.col("price").cast("decimal(10,2)"))


def test_price_change_per_neighborhood(spark):
    fact = price_fact(
        spark,
        (10813, "Back Bay", "2021-07-12", 106.0),
        (10813, "Back Bay", "2022-07-11", 150.0),
        (1, "Fenway", "2021-07-09", 100.0),
        (1, "Fenway", "2021-07-15", 110.0),
        (1, "Fenway", "2021-07-16", 999.0),
        (1, "Fenway", "2022-07-08", 115.0),
        (9000, "Fenway", "2021-07-12", 200.0),
        (9000, "Fenway", "2022-07-14", 230.0),
        (10, "Fenway", "2021-07-12", 50.0),
        (2, "Fenway", "2022-07-11", 50.0),
        (3, "Fenway", "2021-07-12", 0.0),
        (4, "Nowhere", "2021-07-12", 10.0),
        (5, None, "2021-07-12", 10.0),
    )
    found = [r.asDict() for r in analyses.neighborhood_pricing(fact).collect()]
    assert [r["Neighborhood"] for r in found] == ["Back Bay", "Fenway"]
    back_bay, fenway = found
    assert back_bay["Avg Price Increase ($)"] == 44.0
    assert back_bay["Avg Price Increase (%)"] == 41.51
    assert back_bay["Listing IDs"] == "10813"
    assert back_bay["StdDev Price Change"] is None
    assert back_bay["Listings Missing 2022 Data"] == ""
    assert fenway["Total Listings"] == 5
    assert fenway["Listings with Both Dates"] == 2
    assert fenway["Data Completeness (%)"] == 40.0
    # Ids in ascending order of their number, across pieces of the id range.
    assert fenway["Listing IDs"] == "1, 9000"
    assert fenway["Listings Missing 2022 Data"] == "10"
    assert fenway["Avg Price (July 2021)"] == 152.5
    assert fenway["Avg Price Increase ($)"] == 20.0
    # The ratio of the averages, not the average of the ratios.
    assert fenway["Avg Price Increase (%)"] == 13.11
    assert fenway["StdDev Price Change"] == round(statistics.stdev([10.0, 30.0]), 2)
    assert (fenway["Min Price Change ($)"], fenway["Max Price Change ($)"]) == (10.0, 30.0)
    assert [r["Rank by Increase"] for r in found] == [1, 2]


def test_price_anchors_are_parameters(spark):
    fact = price_fact(
        spark, (1, "A", "2020-01-01", 10.0), (1, "A", "2020-02-01", 12.0), (1, "A", "2020-02-02", 99.0)
    )
    row = analyses.neighborhood_pricing(fact, d("2020-01-01"), d("2020-02-01"), radius=0).first()
    assert row["Avg Price Increase ($)"] == 2.0


@pytest.mark.parametrize("reviews_mode", ["fanout", "aggregate"])
def test_prices_of_the_two_weeks_equal_those_of_the_whole_fact(spark, reviews_mode):
    weeks = [("2021-07-09", "2021-07-15"), ("2022-07-08", "2022-07-14")]
    run = Lineage(
        small_sources(spark).replacing(
            listings=listings(
                spark,
                *[{"id": i, "neighborhood": n} for i, n in enumerate(["Fenway", "Fenway", "Fenway", None, "Back Bay", "Back Bay"])],
            ),
            calendar=nights(
                spark,
                # Days around the weeks cost more; listing 2 has nights outside them alone.
                *span(0, "2021-07-01", "2021-07-31", price=100),
                *[{**n, "price": 500} for n in span(0, "2022-07-01", "2022-07-07")],
                *span(0, weeks[1][0], "2022-07-13", price=130),
                {"listing_id": 0, "date": "2022-07-14", "price": 900},
                *span(1, weeks[0][0], weeks[0][1], price=70),
                *span(2, "2022-01-01", "2022-01-03"),
                *span(3, weeks[0][0], weeks[1][1]),
                # Listing 4 has no night, listing 5 one without a date; 99 is unknown.
                {"listing_id": 5, "date": None},
                *span(99, weeks[0][0], weeks[1][1]),
            ),
            generated_reviews=reviews(
                spark,
                # In the fanout the dear night counts three times.
                *[{"id": i, "listing_id": 0, "review_date": "2022-07-14"} for i in range(3)],
                {"id": 9, "listing_id": 0, "review_date": "2022-07-20"},
                {"id": None, "listing_id": 0, "review_date": None},
            ),
            # A change on a day without an hour, inside a week, and an undated one.
            amenities_changelog=changes(
                spark,
                {"listing_id": 0, "change_at": "2022-07-10 00:00:00", "amenities": ["Pool"]},
                {"listing_id": 1, "change_at": None, "amenities": ["Pool"]},
            ),
        )
    )
    bounded = {"fact": run.nights_within(analyses.anchor_weeks(), reviews_mode), "located": run.located()}
    whole = run.fct_daily(reviews_mode)
    found = analyses.neighborhood_pricing(**bounded).collect()
    assert found == analyses.neighborhood_pricing(whole).collect()
    assert [(r["Total Listings"], r["Listing IDs"], r["Listings Missing 2022 Data"]) for r in found] == [(3, "0", "1")]
    assert found[0]["Avg Price (July 2022)"] == (386.67 if reviews_mode == "fanout" else 240.0)
    changed = sorted(analyses.listing_price_changes(**bounded).collect())
    assert changed == sorted(analyses.listing_price_changes(whole).collect())
    assert {(r.listing_id, r.neighborhood) for r in changed} == {(0, "Fenway"), (1, "Fenway"), (2, "Fenway"), (5, "Back Bay")}


@pytest.fixture(scope="module")
def stays(spark):
    sources = small_sources(spark).replacing(
        listings=listings(
            spark,
            {"id": 1, "amenities": ["Lockbox", "First aid kit"]},
            {"id": 2, "amenities": ["Lockbox"]},
            {"id": 3, "neighborhood": "Fenway", "amenities": ["Lockbox", "First aid kit"]},
            {"id": 4, "neighborhood": "Fenway", "amenities": "[]"},
        ),
        calendar=nights(
            spark,
            *span(1, "2022-01-01", "2022-01-03"),
            *span(1, "2022-02-01", "2022-02-03"),
            *span(1, "2022-03-01", "2022-03-01"),
            *span(2, "2022-07-01", "2022-07-06"),
            *span(3, "2022-07-01", "2022-07-05", minimum_nights=9),
            *span(4, "2022-07-01", "2022-07-06"),
        ),
        amenities_changelog=changes(
            spark,
            {"listing_id": 1, "change_at": "2022-01-01 00:00:00", "amenities": ["Lockbox"]},
        ),
    )
    run = Lineage(sources)
    return run.spans(), run.dim_listings(), run.listing_amenity_names()


def test_longest_stay_ranks_ties_and_prefers_the_earliest_span(stays, dim_date):
    spans, dim_listings, _ = stays
    found = analyses.max_stay(spans, dim_listings, dim_date).collect()
    assert [
        (r.listing_id, r.max_possible_stay_nights, r.overall_stay_rank, r.neighborhood_stay_rank)
        for r in found
    ] == [(2, 6, 1, 1), (4, 6, 1, 1), (1, 3, 2, 2), (3, 0, 3, 2)]
    assert [r.longest_stay_flag for r in found] == ["Tied for Longest"] * 2 + [None] * 2
    first = found[2]
    assert (first.best_span_start, first.best_span_end) == (d("2022-01-01"), d("2022-01-03"))
    assert (first.total_availability_spans, first.avg_span_duration) == (3, 2.3)
    assert (first.best_span_season, first.best_span_in_peak_season) == ("Winter", True)


def test_required_amenities_against_the_overall_longest_stay(stays, dim_date):
    spans, dim_listings, names = stays
    found = analyses.max_stay_with_amenities(spans, dim_listings, dim_date, names).collect()
    assert [(r.listing_id, r.stay_rank, r.days_shorter_than_max) for r in found] == [
        (1, 1, -3),
        (3, 2, -6),
    ]
    assert found[0].global_max_stay == 6
    assert found[0].best_span_month == "Jan"
    assert found[0].insight_summary == (
        "Max stay with Lockbox+First Aid Kit is 3 nights, which is 3 nights shorter than "
        "the overall maximum of 6 nights"
    )


def test_unknown_required_amenity_gives_no_rows(stays, dim_date):
    spans, dim_listings, _ = stays
    found = analyses.max_stay_with_amenities(spans, dim_listings, dim_date, ["Lockbox"])
    assert found.count() == 0
