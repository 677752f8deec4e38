"""Small hand-written sources."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession

from roostline.sources import SCHEMAS, RawSources

LOADED = datetime.datetime(2022, 7, 31, 12)
AS_OF = datetime.datetime(2022, 8, 1, 6)
LISTING = {
    "name": "Flat",
    "neighborhood": "Back Bay",
    "property_type": "Condo",
    "room_type": "Entire home/apt",
    "accommodates": 2,
    "bedrooms": 1,
    "beds": 1,
    "bathrooms_text": "1.5 baths",
    "host_id": 1,
    "host_name": "Ann",
    "host_location": "Boston",
    "host_since": "2015-05-01",
    "price": "$125.00",
    "number_of_reviews": 3,
    "first_review": "2021-01-15",
    "last_review": "2022-01-15",
    "review_scores_rating": 4.5,
    "amenities": '["Wifi"]',
    "_loaded_at": LOADED,
}
NIGHT = {
    "available": "t",
    "price": 100,
    "minimum_nights": 1,
    "maximum_nights": 0,
    "_loaded_at": LOADED,
}


def _as_row(schema: str, values: dict) -> tuple:
    names = [part.split()[0] for part in schema.replace("10,2", "10_2").split(",")]
    return tuple(values.get(n) for n in names)


def frame(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    from decimal import Decimal

    schema = SCHEMAS[table]
    typed = []
    for row in rows:
        row = dict(row)
        if table == "calendar" and row.get("price") is not None:
            row["price"] = Decimal(str(row["price"]))
        for name in ("date", "review_date"):
            if isinstance(row.get(name), str):
                row[name] = datetime.date.fromisoformat(row[name])
        if isinstance(row.get("change_at"), str):
            row["change_at"] = datetime.datetime.fromisoformat(row["change_at"])
        if isinstance(row.get("amenities"), list):
            row["amenities"] = json.dumps(row["amenities"])
        typed.append(_as_row(schema, row))
    return spark.createDataFrame(typed, schema)


def listings(spark: SparkSession, *rows: dict) -> DataFrame:
    return frame(spark, "listings", [{**LISTING, **r} for r in rows])


def nights(spark: SparkSession, *rows: dict) -> DataFrame:
    return frame(spark, "calendar", [{**NIGHT, **r} for r in rows])


def reviews(spark: SparkSession, *rows: dict) -> DataFrame:
    return frame(spark, "generated_reviews", [{"_loaded_at": LOADED, **r} for r in rows])


def changes(spark: SparkSession, *rows: dict) -> DataFrame:
    return frame(spark, "amenities_changelog", [{"_loaded_at": LOADED, **r} for r in rows])


def span(listing_id: int, first: str, last: str, **values) -> list[dict]:
    """One calendar row per day of a range."""
    start, end = datetime.date.fromisoformat(first), datetime.date.fromisoformat(last)
    return [
        {"listing_id": listing_id, "date": start + datetime.timedelta(days=i), **values}
        for i in range((end - start).days + 1)
    ]


def small_sources(spark: SparkSession) -> RawSources:
    """Two listings over two months with bookings, reviews and one amenity change."""
    booked = {"available": "f", "reservation_id": 9}
    return RawSources.of(
        listings=listings(
            spark,
            {"id": 1},
            {"id": 2, "neighborhood": "Fenway", "host_id": 2, "price": "$80.00", "amenities": "[]"},
        ),
        calendar=nights(
            spark,
            *span(1, "2022-05-28", "2022-06-30", price=100),
            *span(1, "2022-07-01", "2022-07-20", price=120, **booked),
            *span(2, "2022-05-28", "2022-07-20", price=80),
        ),
        generated_reviews=reviews(
            spark,
            {"id": 1, "listing_id": 1, "review_date": "2022-06-01", "review_score": 4.0},
            {"id": 2, "listing_id": 1, "review_date": "2022-07-18", "review_score": 5.0},
            {"id": 3, "listing_id": 1, "review_date": "2022-07-18", "review_score": 2.0},
        ),
        amenities_changelog=changes(
            spark,
            {"listing_id": 1, "change_at": "2022-01-01 08:00:00", "amenities": ["Wifi"]},
            {
                "listing_id": 1,
                "change_at": "2022-06-15 08:00:00",
                "amenities": ["Wifi", "Air conditioning"],
            },
        ),
    )
