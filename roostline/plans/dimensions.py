"""Date, host and listing dimensions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.functions import date_key, is_weekend, surrogate_key, weekday, years_between
from roostline.operators import as_of_join

# Bounds of the date dimension and the start of the fiscal year.
FIRST_DAY = "2020-01-01"
LAST_DAY = "2030-12-31"
FISCAL_START_MONTH = 4
# Default holidays (month, day, name) and the years they are listed for.
HOLIDAYS = (
    (1, 1, "New Year's Day"),
    (7, 4, "Independence Day"),
    (12, 25, "Christmas Day"),
)
HOLIDAY_YEARS = (2021, 2025)
# Tiers as (exclusive upper bound, label), last label for the rest and NULL.
HOST_TIERS = ((1, "New Host"), (3, "Established Host"))
HOST_TIER_REST = "Veteran Host"
PRICE_TIERS = ((50, "Budget"), (100, "Economy"), (200, "Mid-Range"), (500, "Premium"))
PRICE_TIER_REST = "Luxury"
# Tiers as (inclusive upper bound, label).
CAPACITY_TIERS = ((2, "Small (1-2)"), (4, "Medium (3-4)"), (6, "Large (5-6)"))
CAPACITY_TIER_REST = "Extra Large (7+)"
# Tiers as (inclusive lower bound, label).
RATING_TIERS = ((4.8, "Exceptional"), (4.5, "Excellent"), (4.0, "Good"), (3.0, "Average"))
RATING_TIER_REST = "Below Average"
# Seasons of the northern hemisphere by month.
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}
PEAK_MONTHS = (6, 7, 8)


def ladder(conditions: list[tuple[Column, str]], rest: str) -> Column:
    """The label of the first condition that holds; NULL input falls through to the rest."""
    result = F.lit(rest)
    for condition, label in reversed(conditions):
        result = F.when(condition, F.lit(label)).otherwise(result)
    return result


def default_holidays(spark: SparkSession) -> DataFrame:
    first, last = HOLIDAY_YEARS
    names = F.array(
        *[
            F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(name).alias("holiday_name"))
            for m, d, name in HOLIDAYS
        ]
    )
    return (
        spark.range(first, last + 1)
        .select(F.col("id").cast("int").alias("year"), F.inline(names))
        .select(F.make_date("year", "m", "d").alias("date_day"), "holiday_name")
    )


def dim_date(
    spark: SparkSession,
    as_of: datetime.date | str,
    start: str = FIRST_DAY,
    end: str = LAST_DAY,
    holidays: DataFrame | None = None,
    fiscal_start_month: int = FISCAL_START_MONTH,
) -> DataFrame:
    """One row per calendar day."""
    spine = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
        ).alias("date_day")
    )
    known = default_holidays(spark) if holidays is None else holidays
    day, month, year = F.col("date_day"), F.month("date_day"), F.year("date_day")
    quarter = F.quarter(day)
    fiscal_month = F.pmod(month - fiscal_start_month, F.lit(12))
    season = F.coalesce(
        *[F.when(month.isin(*months), F.lit(name)) for name, months in SEASONS.items()]
    )
    is_holiday = F.col("holiday_name").isNotNull()
    return spine.join(known.select("date_day", "holiday_name"), "date_day", "left").select(
        "date_day",
        weekday(day).alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.trunc(day, "week").alias("week_start_date"),
        F.date_add(F.trunc(day, "week"), 6).alias("week_end_date"),
        month.alias("month_number"),
        F.monthname(day).alias("month_name"),
        F.trunc(day, "month").alias("month_start_date"),
        F.last_day(day).alias("month_end_date"),
        quarter.alias("quarter_number"),
        F.concat(F.lit("Q"), quarter.cast("string")).alias("quarter_name"),
        F.trunc(day, "quarter").alias("quarter_start_date"),
        year.alias("calendar_year"),
        F.trunc(day, "year").alias("year_start_date"),
        # The fiscal year is named after the calendar year it starts in.
        (year - (month < fiscal_start_month).cast("int")).alias("fiscal_year"),
        (F.floor(fiscal_month / 3) + 1).cast("int").alias("fiscal_quarter"),
        is_weekend(day).alias("is_weekend"),
        (~is_weekend(day)).alias("is_weekday"),
        is_holiday.alias("is_holiday"),
        "holiday_name",
        season.alias("season"),
        (month.isin(*PEAK_MONTHS) | is_holiday).alias("is_peak_season"),
        F.date_sub(day, 7).alias("same_day_last_week"),
        F.add_months(day, -1).alias("same_day_last_month"),
        F.add_months(day, -12).alias("same_day_last_year"),
        F.datediff(F.lit(str(as_of)).cast("date"), day).alias("days_ago"),
        F.date_format(day, "yyyy-MM-dd").alias("date_iso"),
        date_key(day).alias("date_key"),
    )


def dim_hosts(hosts_history: DataFrame, as_of: datetime.date | str) -> DataFrame:
    """Host periods with surrogate key, tenure in calendar years and experience tier."""
    tenure = years_between("host_since_date", F.lit(str(as_of)).cast("date"))
    return hosts_history.select(
        surrogate_key("host_id", "valid_from").alias("host_sk"),
        "host_id",
        "host_name",
        "host_location",
        "host_since_date",
        tenure.alias("host_tenure_years"),
        ladder([(tenure < top, label) for top, label in HOST_TIERS], HOST_TIER_REST).alias(
            "host_experience_tier"
        ),
        "valid_from",
        "valid_to",
        "is_current",
    )


def dim_listings(listings_history: DataFrame, scd: DataFrame) -> DataFrame:
    """Listing periods with surrogate key, tiers and the amenities of the period.

    The amenities are those of the period that covers the start of the listing period; a
    listing has few of either. A period without known amenities has the empty set: every flag
    reads false, not NULL.
    """
    amenities = scd.select("listing_id", "valid_from", "valid_to", "amenities")
    accommodates, price = F.col("accommodates"), F.col("base_price")
    rating = F.col("review_scores_rating")
    # The history has columns of the same names: its own period is put aside for the join.
    own = {"valid_from": "period_start", "valid_to": "period_end"}
    covered = as_of_join(
        listings_history.withColumnsRenamed(own), amenities, "listing_id", "period_start", "left"
    ).withColumnsRenamed({new: old for old, new in own.items()})
    return covered.select(
        surrogate_key("listing_id", "valid_from").alias("listing_sk"),
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
        ladder(
            [(accommodates <= top, label) for top, label in CAPACITY_TIERS], CAPACITY_TIER_REST
        ).alias("capacity_tier"),
        ladder([(price < top, label) for top, label in PRICE_TIERS], PRICE_TIER_REST).alias(
            "price_tier"
        ),
        ladder([(rating >= low, label) for low, label in RATING_TIERS], RATING_TIER_REST).alias(
            "rating_tier"
        ),
        F.coalesce("amenities", F.array().cast("array<string>")).alias("amenities"),
        "valid_from",
        "valid_to",
        "is_current",
    )
