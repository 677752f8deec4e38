"""The four raw tables: schemas and readers."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

LISTINGS = """
    id BIGINT, name STRING, neighborhood STRING, property_type STRING, room_type STRING,
    accommodates INT, bedrooms INT, beds INT, bathrooms_text STRING, host_id BIGINT,
    host_name STRING, host_location STRING, host_since STRING, host_verifications STRING,
    price STRING, number_of_reviews INT, first_review STRING, last_review STRING,
    review_scores_rating DOUBLE, amenities STRING, _loaded_at TIMESTAMP
"""
CALENDAR = """
    listing_id BIGINT, date DATE, available STRING, reservation_id BIGINT,
    price DECIMAL(10,2), minimum_nights INT, maximum_nights INT, _loaded_at TIMESTAMP
"""
GENERATED_REVIEWS = """
    id BIGINT, listing_id BIGINT, review_date DATE, review_score DOUBLE, _loaded_at TIMESTAMP
"""
AMENITIES_CHANGELOG = """
    listing_id BIGINT, change_at TIMESTAMP, amenities STRING, _loaded_at TIMESTAMP
"""

SCHEMAS = {
    "listings": LISTINGS,
    "calendar": CALENDAR,
    "generated_reviews": GENERATED_REVIEWS,
    "amenities_changelog": AMENITIES_CHANGELOG,
}


class RawSources:
    """The four raw tables; each is opened on first use and then kept."""

    def __init__(self, open_table: Callable[[str], DataFrame]) -> None:
        self._open = cache(open_table)

    @classmethod
    def of(cls, **tables: DataFrame) -> RawSources:
        return cls(tables.__getitem__)

    def replacing(self, **tables: DataFrame) -> RawSources:
        """The same sources with some tables exchanged."""
        return RawSources(lambda name: tables[name] if name in tables else self._open(name))

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, self._open(name)) for name in SCHEMAS]

    @property
    def listings(self) -> DataFrame:
        return self._open("listings")

    @property
    def calendar(self) -> DataFrame:
        return self._open("calendar")

    @property
    def generated_reviews(self) -> DataFrame:
        return self._open("generated_reviews")

    @property
    def amenities_changelog(self) -> DataFrame:
        return self._open("amenities_changelog")


def read_table(
    spark: SparkSession, name: str, location: str, source: str = "parquet", **options: str
) -> DataFrame:
    """One raw table with its fixed schema, from files or from a catalog table."""
    if source == "table":
        return spark.table(location)
    if source == "csv":
        # JSON lists hold commas and doubled quotes.
        options = {"header": "true", "quote": '"', "escape": '"', **options}
    return spark.read.format(source).schema(SCHEMAS[name]).options(**options).load(location)


def read_sources(
    spark: SparkSession, root: str, source: str = "parquet", **options: str
) -> RawSources:
    """All raw tables below one folder, or in one catalog namespace (``source='table'``)."""
    joiner = "." if source == "table" else "/"
    return RawSources(
        lambda name: read_table(spark, name, f"{root}{joiner}{name}", source, **options)
    )
