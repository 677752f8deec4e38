"""History intervals, availability spans and the enriched calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roostline.functions import OPEN_END, widen
from roostline.operators import as_of_join, continuous_periods, islands, scd2_intervals

# Start dates used when a listing or host has no first date.
LISTING_EPOCH = "2020-01-01"
HOST_EPOCH = "1900-01-01"

SPAN_ATTRIBUTES = (
    "listing_name",
    "neighborhood",
    "property_type",
    "room_type",
    "accommodates",
)
ENRICHED_ATTRIBUTES = (
    "listing_name",
    "neighborhood",
    "property_type",
    "room_type",
    "accommodates",
    "bedrooms",
    "beds",
    "bathrooms",
    "base_price",
    "host_id",
    "host_name",
    "review_scores_rating",
    "number_of_reviews",
)


def listing_amenities_scd(changelog: DataFrame) -> DataFrame:
    """Type-2 periods of the amenity set of each listing."""
    return scd2_intervals(changelog, "listing_id", "change_at").select(
        "listing_id", "valid_from", "valid_to", "amenities"
    )


def availability_spans(
    calendar: DataFrame, listings: DataFrame, unique_days: bool = False
) -> DataFrame:
    """Runs of available days with the longest stay their night limits allow.

    The strictest limits of the run count: the largest minimum and the smallest maximum,
    where a maximum of 0 means no limit.
    """
    spans = islands(
        calendar.filter("is_available"),
        key="listing_id",
        day="calendar_date",
        carried=["minimum_nights", "maximum_nights"],
        measures=[
            F.max("minimum_nights").alias("min_nights_required"),
            F.min(F.nullif(F.col("maximum_nights"), F.lit(0))).alias("max_nights_allowed"),
        ],
        unique_days=unique_days,
        month="calendar_month",
        merged=[
            F.max("min_nights_required").alias("min_nights_required"),
            F.min("max_nights_allowed").alias("max_nights_allowed"),
        ],
    ).drop("span_group")
    length = F.col("consecutive_available_days")
    bookable = F.coalesce(length >= F.col("min_nights_required"), F.lit(True))
    capped = F.when(
        F.col("max_nights_allowed") > 0, F.least(length, F.col("max_nights_allowed"))
    ).otherwise(length)
    return spans.withColumns(
        {
            "effective_max_stay_nights": F.when(bookable, capped).otherwise(F.lit(0)),
            "is_bookable": bookable,
        }
    ).join(listings.select("listing_id", *SPAN_ATTRIBUTES, "amenities"), "listing_id")


def with_listing_periods(
    calendar: DataFrame,
    listings: DataFrame,
    scd: DataFrame,
    attributes: tuple[str, ...],
    vocabulary: list[str] | None = None,
    dated: bool = False,
) -> DataFrame:
    """Calendar rows with listing attributes and the amenities of their date.

    Listing and history are first combined to periods without holes, so the calendar, by far
    the largest input, goes through a single join on listing and month. Nights of unknown
    listings drop out. With a vocabulary the boolean columns are made once per period,
    before the join, and not once per night.

    ``dated`` says that every night has a date and a month. Spark cannot know it of a table in
    files, whose nights, dealt by month and listing, then stay where they are.
    """
    periods = continuous_periods(
        listings.select("listing_id", *attributes, "amenities"), scd, "listing_id", "amenities"
    )
    if vocabulary is not None:
        periods = widen(periods, vocabulary)
    if dated:
        return as_of_join(
            calendar, periods, "listing_id", "calendar_date", month=F.col("calendar_month")
        )
    # A night without a date is in no known period: it takes the listing's own amenities.
    beginning = F.lit("0001-01-01").cast("date")
    night, month = F.coalesce("calendar_date", beginning), F.coalesce("calendar_month", beginning)
    return as_of_join(calendar, periods, "listing_id", night, month=month)


def calendar_enriched(
    calendar: DataFrame,
    listings: DataFrame,
    scd: DataFrame,
    vocabulary: list[str] | None = None,
    dated: bool = False,
) -> DataFrame:
    """Calendar with listing attributes, point-in-time amenities and nightly revenue."""
    return with_listing_periods(
        calendar, listings, scd, ENRICHED_ATTRIBUTES, vocabulary, dated
    ).withColumns(
        {
            "daily_revenue": F.when(F.col("is_reserved"), F.col("daily_price")).otherwise(0),
            "is_occupied": F.col("is_reserved").cast("int"),
        }
    )


def hosts_history(listings: DataFrame) -> DataFrame:
    """The latest record of each host as one open period.

    The latest record is an aggregate, not a window: a host with very many listings is
    reduced on the map side. Records observed on the same date are told apart by their
    values, so the choice is stable.
    """
    record = F.struct(
        F.col("first_review_date").alias("record_observed_date"),
        "host_name",
        "host_location",
        "host_since_date",
    )
    return (
        listings.filter(F.col("host_id").isNotNull())
        .groupBy("host_id")
        .agg(F.max(record).alias("latest"))
        .select(
            "host_id",
            "latest.host_name",
            "latest.host_location",
            "latest.host_since_date",
            "latest.record_observed_date",
            F.coalesce("latest.host_since_date", F.lit(HOST_EPOCH).cast("date")).alias(
                "valid_from"
            ),
            F.lit(OPEN_END).cast("date").alias("valid_to"),
            F.lit(True).alias("is_current"),
        )
    )


def listings_history(listings: DataFrame, scd: DataFrame) -> DataFrame:
    """Listing periods driven by amenity change dates.

    A listing without changes has one period from its first review, or from the epoch.
    A listing with changes has no period before the first one.
    """
    changes = scd.select(
        F.col("listing_id").alias("__id"), F.col("valid_from").alias("__changed")
    ).distinct()
    created = F.coalesce("first_review_date", F.lit(LISTING_EPOCH).cast("date"))
    timeline = listings.join(changes, listings["listing_id"] == changes["__id"], "left").select(
        "listing_id",
        "listing_name",
        "neighborhood",
        "property_type",
        "room_type",
        "accommodates",
        "beds",
        "host_id",
        "base_price",
        "number_of_reviews",
        "review_scores_rating",
        F.coalesce("__changed", created).alias("valid_from"),
    )
    following = F.lead("valid_from").over(
        Window.partitionBy("listing_id").orderBy("valid_from")
    )
    return timeline.withColumns(
        {
            "valid_to": F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END).cast("date")),
            "is_current": following.isNull(),
        }
    )
