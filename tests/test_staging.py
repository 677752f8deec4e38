from __future__ import annotations

import datetime
from decimal import Decimal

from roostline.plans import staging
from tests.lodging import changes, listings, nights, reviews


def test_listing_texts_become_typed_values(spark):
    row = staging.stg_listings(
        listings(
            spark,
            {
                "id": 1,
                "price": "$1,234.56",
                "bathrooms_text": "2.5 shared baths",
                "host_since": "unknown",
                "first_review": None,
            },
        )
    ).first()
    assert row.base_price == Decimal("1234.56")
    assert row.bathrooms == Decimal("2.5")
    assert row.host_since_date is None
    assert row.first_review_date is None
    assert row.last_review_date == datetime.date(2022, 1, 15)


def test_text_without_a_number_and_bad_price_are_null(spark):
    row = staging.stg_listings(
        listings(spark, {"id": 1, "bathrooms_text": "Half-bath", "price": "on request"})
    ).first()
    assert row.bathrooms is None
    assert row.base_price is None


def test_duplicate_listings_can_share_their_amenities(spark):
    raw = listings(
        spark,
        {"id": 1, "amenities": ["Wifi"]},
        {"id": 1, "amenities": ["Pool"]},
        {"id": 2, "amenities": "[]"},
    )
    merged = staging.stg_listings(raw, merge_duplicates=True).orderBy("listing_id").collect()
    assert [r.amenities for r in merged] == [["Pool", "Wifi"], ["Pool", "Wifi"], None]


def test_availability_texts_and_reservation_flag(spark, rows):
    raw = nights(
        spark,
        {"listing_id": 1, "date": "2022-01-01", "available": "T"},
        {"listing_id": 2, "date": "2022-01-02", "available": "true"},
        {"listing_id": 3, "date": "2022-01-03", "available": "1", "reservation_id": 7},
        {"listing_id": 4, "date": "2022-01-04", "available": "yes"},
        {"listing_id": 5, "date": "2022-01-05", "available": None},
    )
    staged = staging.stg_calendar(raw)
    assert rows(staged, "listing_id", "is_available", "is_reserved", "day_of_week") == [
        (1, True, False, 6),
        (2, True, False, 0),
        (3, True, True, 1),
        (4, False, False, 2),
        (5, False, False, 3),
    ]
    assert [r.is_weekend for r in staged.orderBy("listing_id").collect()] == [
        True,
        True,
        False,
        False,
        False,
    ]


def test_reviews_keep_null_ids(spark, rows):
    raw = reviews(spark, {"listing_id": 1, "review_date": "2022-01-01", "review_score": 3.0})
    assert rows(staging.stg_reviews(raw), "review_id", "listing_id") == [(None, 1)]


def test_events_of_one_day_merge_to_their_union(spark):
    raw = changes(
        spark,
        {"listing_id": 1, "change_at": "2022-01-01 08:00:00", "amenities": ["Wifi", "Pool"]},
        {"listing_id": 1, "change_at": "2022-01-01 20:00:00", "amenities": ["Wifi", "AC"]},
    )
    row = staging.stg_amenities_changelog(raw).collect()
    assert [(r.change_at, r.amenities) for r in row] == [
        (datetime.date(2022, 1, 1), ["AC", "Pool", "Wifi"])
    ]


def test_an_empty_event_vanishes_unless_kept(spark, rows):
    raw = changes(
        spark,
        {"listing_id": 1, "change_at": "2022-01-01 08:00:00", "amenities": ["Wifi"]},
        {"listing_id": 1, "change_at": "2022-02-01 08:00:00", "amenities": []},
        {"listing_id": 1, "change_at": "2022-03-01 08:00:00", "amenities": [None]},
    )
    days = [r[0].month for r in rows(staging.stg_amenities_changelog(raw), "change_at")]
    assert days == [1, 3]
    kept = staging.stg_amenities_changelog(raw, keep_empty=True)
    assert [(r[0].month, r[1]) for r in rows(kept, "change_at", "amenities")] == [
        (1, ["Wifi"]),
        (2, []),
        (3, []),
    ]
