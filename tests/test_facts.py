from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roostline.plans import facts, intermediate
from roostline.plans.pipeline import Lineage
from tests.lodging import changes, listings, nights, reviews, small_sources, span


def d(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture(scope="module")
def lineage(spark):
    return Lineage(small_sources(spark))


def test_revenue_before_and_after_an_amenity_arrives(spark, rows):
    sources = small_sources(spark).replacing(
        calendar=nights(
            spark,
            *span(1, "2022-06-14", "2022-06-16", reservation_id=5, available="f", price=110),
        )
    )
    run = Lineage(sources)
    found = intermediate.calendar_enriched(
        run.calendar, run.listings, run.scd, ["Air conditioning"]
    )
    assert rows(found, "calendar_date", "Air conditioning", "daily_revenue") == [
        (d("2022-06-14"), False, Decimal("110.00")),
        (d("2022-06-15"), True, Decimal("110.00")),
        (d("2022-06-16"), True, Decimal("110.00")),
    ]


def test_nights_before_the_first_change_use_the_listings_own_amenities(spark, rows):
    sources = small_sources(spark).replacing(
        listings=listings(spark, {"id": 1, "amenities": ["Pool", "Sauna"]}, {"id": 2}),
        calendar=nights(
            spark,
            {"listing_id": 1, "date": "2021-12-31"},
            {"listing_id": 1, "date": "2022-01-01"},
            {"listing_id": 2, "date": "2022-01-01"},
            {"listing_id": 3, "date": "2022-01-01"},
            {"listing_id": 1, "date": None},
        ),
    )
    fact = Lineage(sources).fct_daily("aggregate")
    assert rows(fact, "listing_id", "calendar_date", "amenities") == sorted(
        [
            (1, d("2021-12-31"), ["Pool", "Sauna"]),
            (1, d("2022-01-01"), ["Wifi"]),
            (2, d("2022-01-01"), ["Wifi"]),
            (1, None, ["Pool", "Sauna"]),
        ],
        key=str,
    )


def test_two_reviews_of_a_night_repeat_it_or_merge(lineage, rows):
    night = F.col("calendar_date") == F.lit(d("2022-07-18"))
    fanned = lineage.fct_daily("fanout").filter(night & (F.col("listing_id") == 1))
    assert rows(fanned, "review_id", "daily_review_score", "daily_revenue") == [
        (2, 5.0, Decimal("120.00")),
        (3, 2.0, Decimal("120.00")),
    ]
    merged = lineage.fct_daily("aggregate").filter(night & (F.col("listing_id") == 1))
    assert rows(merged, "review_id", "daily_review_score") == [(2, 3.5)]
    with pytest.raises(ValueError, match="fanout"):
        lineage.fct_daily("first")


def test_a_night_without_review_scores_zero(lineage):
    row = lineage.fct_daily("fanout").filter("listing_id = 2").first()
    assert (row.daily_review_score, row.review_id) == (0.0, None)


def test_nightly_flags_and_prices(spark, rows):
    sources = small_sources(spark).replacing(
        calendar=nights(
            spark,
            {"listing_id": 1, "date": "2022-06-01", "price": 100},
            {"listing_id": 1, "date": "2022-06-02", "price": 90, "reservation_id": 1},
            {"listing_id": 1, "date": "2022-06-03", "price": 90, "available": "f"},
            {
                "listing_id": 1,
                "date": "2022-06-04",
                "price": None,
                "available": "f",
                "reservation_id": 2,
            },
        )
    )
    fact = Lineage(sources).fct_daily("aggregate")
    assert rows(
        fact,
        "date_key",
        "price_variance",
        "daily_revenue",
        "is_occupied",
        "available_flag",
        "is_blocked",
    ) == [
        (20220601, Decimal("-25.00"), Decimal("0.00"), 0, 1, 0),
        # Reserved and still listed as available: it counts on both sides.
        (20220602, Decimal("-35.00"), Decimal("90.00"), 1, 1, 0),
        (20220603, Decimal("-35.00"), Decimal("0.00"), 0, 0, 1),
        (20220604, Decimal("-125.00"), None, 1, 0, 0),
    ]
    row = fact.filter("date_key = 20220601").first()
    assert (row.calendar_week, row.calendar_quarter) == (d("2022-05-30"), d("2022-04-01"))


def test_wide_fact_has_one_column_per_changelog_amenity(lineage):
    names = lineage.amenity_names()
    wide = lineage.fct_daily("aggregate", names)
    assert wide.columns == [
        *facts.FACT_COLUMNS,
        *facts.NIGHT_COLUMNS,
        "Air conditioning",
        "Wifi",
    ]
    # Listing 2 has an empty list and no history: unknown, not absent.
    assert wide.filter("listing_id = 2").first()["Wifi"] is None


def test_monthly_listing_figures_and_changes(lineage):
    months = facts.fct_monthly_listing(lineage.fct_daily("aggregate"))
    found = {r.calendar_month.month: r for r in months.filter("listing_id = 1").collect()}
    may, june, july = found[5], found[6], found[7]
    assert (july.total_revenue, july.occupied_nights, july.total_nights) == (2400, 20, 20)
    assert (july.occupancy_rate_pct, july.revpar) == (100.0, 120.0)
    assert (june.occupancy_rate_pct, june.available_nights) == (0.0, 30)
    assert june.price_volatility == 0.0
    # Nothing to compare with, and a zero base: no percentage.
    assert may.prev_month_revenue is None and may.revenue_mom_change_pct is None
    assert july.prev_month_revenue == 0 and july.revenue_mom_change_pct is None
    assert july.occupancy_mom_change_pts == 100.0
    assert july.rate_mom_change_pct == 20.0
    assert (june.review_count, june.total_review_score) == (1, 4.0)


def test_previous_month_is_the_previous_row(spark, rows):
    sources = small_sources(spark).replacing(
        calendar=nights(
            spark,
            *span(1, "2022-01-01", "2022-01-02", reservation_id=1, price=50),
            *span(1, "2022-06-01", "2022-06-01", reservation_id=2, price=150),
        )
    )
    months = facts.fct_monthly_listing(Lineage(sources).fct_daily("aggregate"))
    assert rows(months, "calendar_month", "revenue_mom_change_pct") == [
        (d("2022-01-01"), None),
        (d("2022-06-01"), 50.0),
    ]


def market(spark, *prices):
    """One listing per neighborhood and one June night per price; None is not reserved."""
    ids = range(1, len(prices) + 1)
    return small_sources(spark).replacing(
        listings=listings(
            spark,
            *[
                {
                    "id": i,
                    "neighborhood": f"N{i}",
                    "room_type": ["Shared room", "Private room", "Entire home/apt"][i % 3],
                    "review_scores_rating": None if i == 1 else 4.0 + i / 10,
                }
                for i in ids
            ],
        ),
        calendar=nights(
            spark,
            *[
                {
                    "listing_id": i,
                    "date": "2022-06-01",
                    "price": price,
                    "reservation_id": i,
                    "available": "f",
                }
                for i, price in zip(ids, prices)
            ],
        ),
    )


def test_neighborhood_ranks_place_null_first_except_for_reviews(spark):
    fact = Lineage(market(spark, None, 300, 100, 100)).fct_daily("aggregate")
    found = {r.neighborhood: r for r in facts.fct_monthly_neighborhood(fact).collect()}
    assert [found[f"N{i}"].price_rank for i in (1, 2, 3, 4)] == [1, 2, 3, 3]
    assert [found[f"N{i}"].revenue_rank for i in (1, 2, 3, 4)] == [1, 2, 3, 3]
    assert [found[f"N{i}"].review_rank for i in (1, 2, 3, 4)] == [4, 3, 2, 1]
    assert found["N2"].revenue_market_share_pct == 60.0
    assert found["N2"].listing_market_share_pct == 25.0
    assert found["N1"].revenue_market_share_pct is None
    assert found["N1"].private_room_listings == 1
    assert found["N1"].entire_home_listings == 0


def test_a_market_without_revenue_has_no_shares(spark):
    sources = small_sources(spark).replacing(
        calendar=nights(spark, *span(1, "2022-06-01", "2022-06-02"))
    )
    row = facts.fct_monthly_neighborhood(Lineage(sources).fct_daily("aggregate")).first()
    assert row.revenue_market_share_pct is None and row.listing_market_share_pct == 100.0


def test_neighborhood_median_and_distinct_listings(spark):
    sources = small_sources(spark).replacing(
        listings=listings(spark, {"id": 1}, {"id": 2}, {"id": 3, "neighborhood": None}),
        calendar=nights(
            spark,
            *span(1, "2022-06-01", "2022-06-03", price=100),
            *span(2, "2022-06-01", "2022-06-01", price=180),
            *span(2, "2022-06-02", "2022-06-04", price=200),
            *span(3, "2022-06-01", "2022-06-09", price=999),
        ),
        generated_reviews=reviews(
            spark,
            {"id": 1, "listing_id": 1, "review_date": "2022-06-01", "review_score": 4.0},
        ),
        amenities_changelog=changes(
            spark, {"listing_id": 1, "change_at": "2022-01-01 00:00:00", "amenities": ["x"]}
        ),
    )
    fact = Lineage(sources).fct_daily("fanout")
    (row,) = facts.fct_monthly_neighborhood(fact).collect()
    assert (row.active_listings, row.total_listing_nights, row.total_reviews) == (2, 7, 1)
    assert row.median_nightly_rate == 180.0
    assert row.entire_home_listings == 2
    assert facts.fct_monthly_neighborhood(fact, median="approx").count() == 1
