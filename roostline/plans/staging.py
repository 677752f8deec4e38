"""Staging: cleaned sources. Projections only, except the daily merge of change events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roostline.functions import is_weekend, parse_amenities, weekday

# Fixed value: the leading number of a bathroom text such as "1.5 baths".
NUMBER_PATTERN = r"[0-9]+\.?[0-9]*"
# Texts that mean "available", compared in lower case.
AVAILABLE_TEXTS = ("t", "true", "1")


def stg_listings(
    listings: DataFrame, json_mode: str = "failfast", merge_duplicates: bool = False
) -> DataFrame:
    """One row per listing: typed price, bathrooms and dates, amenities as a sorted set.

    Listing ids are unique (checked by the source tests), so parsing is a plain projection.
    With ``merge_duplicates=True`` rows that share an id all carry the union of their
    amenities, as a group-by on the id would give; that costs an exchange.
    """
    staged = listings.select(
        F.col("id").alias("listing_id"),
        F.col("name").alias("listing_name"),
        "neighborhood",
        "property_type",
        "room_type",
        "accommodates",
        "bedrooms",
        "beds",
        F.regexp_substr("bathrooms_text", F.lit(NUMBER_PATTERN))
        .try_cast("decimal(10,1)")
        .alias("bathrooms"),
        F.col("bathrooms_text").alias("bathrooms_raw"),
        "host_id",
        "host_name",
        "host_location",
        F.col("host_since").cast("string").try_cast("date").alias("host_since_date"),
        "host_verifications",
        F.regexp_replace("price", "[$,]", "").try_cast("decimal(10,2)").alias("base_price"),
        "number_of_reviews",
        F.col("first_review").try_cast("date").alias("first_review_date"),
        F.col("last_review").try_cast("date").alias("last_review_date"),
        "review_scores_rating",
        F.col("amenities").alias("amenities_raw"),
        parse_amenities("amenities", json_mode).alias("amenities"),
    )
    if not merge_duplicates:
        return staged
    united = (
        staged.select(F.col("listing_id").alias("__id"), F.explode("amenities").alias("__name"))
        .groupBy("__id")
        .agg(F.sort_array(F.collect_set("__name")).alias("__amenities"))
    )
    return (
        staged.join(united, staged["listing_id"] == united["__id"], "left")
        .withColumn("amenities", F.coalesce("__amenities", "amenities"))
        .drop("__id", "__amenities")
    )


def stg_calendar(calendar: DataFrame) -> DataFrame:
    """One row per listing and date with flags and date parts. A calendar that is stored or dealt
    by month has its ``calendar_month`` already."""
    known = "calendar_month" in calendar.columns
    month = F.col("calendar_month") if known else F.trunc("date", "month")
    return calendar.select(
        "listing_id",
        F.col("date").alias("calendar_date"),
        # Most texts are in lower case already.
        F.coalesce(
            F.col("available").isin(*AVAILABLE_TEXTS) | F.lower("available").isin(*AVAILABLE_TEXTS),
            F.lit(False),
        ).alias("is_available"),
        "reservation_id",
        F.col("reservation_id").isNotNull().alias("is_reserved"),
        F.col("price").alias("daily_price"),
        "minimum_nights",
        "maximum_nights",
        month.alias("calendar_month"),
        F.trunc("date", "year").alias("calendar_year"),
        weekday("date").alias("day_of_week"),
        is_weekend("date").alias("is_weekend"),
    )


def stg_reviews(generated_reviews: DataFrame) -> DataFrame:
    """One row per review; review ids may be NULL."""
    return generated_reviews.select(
        F.col("id").alias("review_id"),
        "listing_id",
        F.col("review_date").cast("date").alias("review_date"),
        "review_score",
    )


def parsed_changelog(changelog: DataFrame, json_mode: str = "failfast") -> DataFrame:
    """Change events with their day and amenity array, before events of a day are merged."""
    return changelog.select(
        "listing_id",
        F.col("change_at").cast("date").alias("change_at"),
        parse_amenities("amenities", json_mode).alias("amenities"),
    )


def stg_amenities_changelog(
    changelog: DataFrame, json_mode: str = "failfast", keep_empty: bool = False
) -> DataFrame:
    """One row per listing and change day; events of the same day merge to their union.

    An event with an empty list has no names and vanishes, so the earlier state keeps
    running. ``keep_empty=True`` records it as "all removed" instead. The sets are built
    name by name: a day with any number of events needs the space of its distinct names.
    """
    # The outer explode keeps the text parsed once: an inner one adds a filter on the parsed
    # list below itself, and so a second parse. Empty events go after the merge instead.
    merged = (
        parsed_changelog(changelog, json_mode)
        .withColumn("listed", F.col("amenities").isNotNull())
        .select("listing_id", "change_at", "listed", F.explode_outer("amenities").alias("name"))
        .groupBy("listing_id", "change_at")
        .agg(
            F.sort_array(F.collect_set("name")).alias("amenities"),
            F.bool_or("listed").alias("listed"),
        )
    )
    return (merged if keep_empty else merged.filter("listed")).drop("listed")
