"""Four ready analyses over the published tables."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roostline.functions import amenity_flag, ratio, resolve_alias, round_half_up, sample_stddev
from roostline.operators import dense_rank_by_value
from roostline.session import staged

# Accepted spellings of the amenities, in order of preference.
AIR_CONDITIONING = ("Air conditioning", "AC", "A/C", "Air Conditioning")
LOCKBOX = ("Lockbox", "Self check-in")
FIRST_AID_KIT = ("First aid kit", "First Aid Kit")
# The two price anchors and the days around each of them.
EARLIER_ANCHOR = datetime.date(2021, 7, 12)
LATER_ANCHOR = datetime.date(2022, 7, 11)
ANCHOR_RADIUS = 3
# Ids per partial list; a bucket of the id range holds at most this many distinct ids.
ID_BUCKET = 4096


def amenity_revenue(
    fact: DataFrame,
    dim_date: DataFrame,
    vocabulary: Sequence[str],
    candidates: Sequence[str] = AIR_CONDITIONING,
) -> DataFrame:
    """Monthly revenue with and without air conditioning, its share and yearly change.

    The month total is a window sum over the few segment rows, not a second pass.
    """
    name = resolve_alias(candidates, vocabulary)
    # Days with the same texts are known by the first of them: nights are summed up by that date
    # and get the texts after that.
    texts = ["calendar_year", "month_name", "quarter_name", "fiscal_year", "season"]
    days = dim_date.select(
        "date_day", *texts, F.min("date_day").over(Window.partitionBy(*texts)).alias("first_day")
    )
    parts = days.filter(F.col("date_day") == F.col("first_day")).select("first_day", *texts).distinct()
    nights = fact.select(
        "calendar_date",
        "calendar_month",
        "listing_id",
        "daily_revenue",
        "is_occupied",
        amenity_flag(fact, name).alias("has_air_conditioning"),
    )
    dated = nights.join(
        days.select("date_day", "first_day"), nights["calendar_date"] == days["date_day"]
    )
    segments = (
        dated.groupBy("calendar_month", "first_day", "has_air_conditioning", "listing_id")
        .agg(F.sum("daily_revenue").alias("revenue"), F.sum("is_occupied").alias("occupied"))
        .groupBy("calendar_month", "first_day", "has_air_conditioning")
        .agg(
            F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"),
            F.count("listing_id").alias("listing_count"),
            F.sum("occupied").alias("occupied_nights"),
        )
        .join(parts, "first_day")
    )
    month = Window.partitionBy("calendar_month")
    same_month = Window.partitionBy("has_air_conditioning", F.month("calendar_month")).orderBy(
        "calendar_month"
    )
    revenue, total, before = (
        F.col("total_revenue"),
        F.col("month_total_revenue"),
        F.col("same_month_last_year_revenue"),
    )
    return (
        segments.withColumns(
            {
                "month_total_revenue": F.sum("total_revenue").over(month),
                "same_month_last_year_revenue": F.lag("total_revenue").over(same_month),
            }
        )
        .select(
            "calendar_month",
            "calendar_year",
            "month_name",
            "quarter_name",
            "fiscal_year",
            "season",
            "has_air_conditioning",
            F.when(F.col("has_air_conditioning"), "With AC")
            .otherwise("Without AC")
            .alias("ac_segment"),
            "total_revenue",
            "listing_count",
            "occupied_nights",
            "month_total_revenue",
            round_half_up(ratio(revenue, total) * 100, 1).alias("pct_of_monthly_revenue"),
            round_half_up(ratio(revenue, F.col("listing_count")), 2).alias(
                "avg_revenue_per_listing"
            ),
            "same_month_last_year_revenue",
            round_half_up(ratio(revenue - before, before) * 100, 1).alias(
                "yoy_revenue_change_pct"
            ),
            F.lit(name or "NULL").alias("ac_column_used"),
        )
        .orderBy("calendar_month", F.desc_nulls_first("has_air_conditioning"))
    )


def anchor_weeks(
    earlier: datetime.date = EARLIER_ANCHOR,
    later: datetime.date = LATER_ANCHOR,
    radius: int = ANCHOR_RADIUS,
) -> list[tuple[datetime.date, datetime.date]]:
    """First and last days of the weeks around the two anchor dates."""
    span = datetime.timedelta(days=radius)
    return [(anchor - span, anchor + span) for anchor in (earlier, later)]


def listing_price_changes(
    fact: DataFrame,
    earlier: datetime.date = EARLIER_ANCHOR,
    later: datetime.date = LATER_ANCHOR,
    radius: int = ANCHOR_RADIUS,
    located: DataFrame | None = None,
) -> DataFrame:
    """One row per listing and neighborhood it was ever in, with its mean prices in the weeks
    around two anchor dates: the long form of the price analysis, for publishing.

    Both weeks come from one pass: each listing keeps its two conditional price sums. Prices
    belong to the listing, so a listing that moved counts in both neighborhoods. A mean price
    has eight decimals, as a decimal average has in the source dialect.

    A fact that is not stored need not be made whole for that: nights outside these weeks tell
    only which listings have nights. With those and their neighborhoods in ``located``, ``fact``
    may be the nights of :func:`anchor_weeks` alone.
    """
    before, after = anchor_weeks(earlier, later, radius)

    def price(week: tuple[datetime.date, datetime.date]) -> Column:
        first, last = week
        in_week = F.col("calendar_date").between(F.lit(first), F.lit(last))
        return F.when(in_week & (F.col("adjusted_price") > 0), F.col("adjusted_price"))

    if located is not None:
        fact = fact.select(
            "listing_id", "neighborhood", "calendar_date", "adjusted_price"
        ).unionByName(located.select("listing_id", "neighborhood"), allowMissingColumns=True)
    # One pass over the nights: a listing and neighborhood each, few rows for the window.
    places = fact.groupBy("listing_id", "neighborhood").agg(
        F.sum(price(before)).alias("sum_before"),
        F.count(price(before)).alias("nights_before"),
        F.sum(price(after)).alias("sum_after"),
        F.count(price(after)).alias("nights_after"),
    )
    listing = Window.partitionBy("listing_id")

    def mean_price(total: str, nights: str) -> Column:
        # The type of a single sum: the quotient keeps its digits.
        whole = F.sum(total).over(listing).cast(places.schema[total].dataType)
        return (whole / F.nullif(F.sum(nights).over(listing), F.lit(0))).cast("decimal(18,8)")

    return (
        places.select(
            "listing_id",
            "neighborhood",
            mean_price("sum_before", "nights_before").alias("price_before"),
            mean_price("sum_after", "nights_after").alias("price_after"),
        )
        .filter(F.col("neighborhood").isNotNull())
        .withColumn("difference", F.col("price_after") - F.col("price_before"))
    )


def neighborhood_pricing(
    fact: DataFrame,
    earlier: datetime.date = EARLIER_ANCHOR,
    later: datetime.date = LATER_ANCHOR,
    radius: int = ANCHOR_RADIUS,
    located: DataFrame | None = None,
) -> DataFrame:
    """Average price change per neighborhood between the weeks around two anchor dates. For
    ``located`` see :func:`listing_price_changes`."""
    listings = listing_price_changes(fact, earlier, later, radius, located)
    both = F.col("difference").isNotNull()
    missing = F.col("price_before").isNotNull() & F.col("price_after").isNull()
    # The difference as a whole number of its last decimal, for an exact sum of squares.
    whole = (F.col("difference") * F.lit(100_000_000)).cast("decimal(19,0)")

    def ids(wanted: Column) -> Column:
        chosen = F.sort_array(F.collect_set(F.when(wanted, F.col("listing_id"))))
        return F.array_join(chosen.cast("array<string>"), ", ")

    def joined(piece: str) -> Column:
        pieces = F.sort_array(F.collect_list(F.struct("bucket", F.col(piece).alias("ids"))))
        filled = F.filter(F.transform(pieces, lambda p: p["ids"]), lambda text: text != "")
        return F.array_join(filled, ", ")

    # The id list of a neighborhood is the result itself, one text in one cell. Its ids are
    # distinct, so every bucket of the id range is bounded; only finished pieces meet.
    pieces = listings.groupBy(
        "neighborhood", F.floor(F.col("listing_id") / ID_BUCKET).alias("bucket")
    ).agg(
        F.count("listing_id").alias("listings"),
        F.count("difference").alias("n"),
        F.sum(F.when(both, F.col("price_before"))).alias("before"),
        F.sum(F.when(both, F.col("price_after"))).alias("after"),
        F.sum("difference").alias("change"),
        F.min("difference").alias("min_change"),
        F.max("difference").alias("max_change"),
        F.sum(whole).cast("decimal(38,0)").alias("total"),
        F.sum(whole * whole).cast("decimal(38,0)").alias("squares"),
        ids(both).alias("ids_both"),
        ids(missing).alias("ids_missing"),
    )
    sums = pieces.groupBy("neighborhood").agg(
        F.sum("listings").alias("listings"),
        F.sum("n").alias("n"),
        ratio(F.sum("before"), F.sum("n")).alias("before"),
        ratio(F.sum("after"), F.sum("n")).alias("after"),
        ratio(F.sum("change"), F.sum("n")).alias("change"),
        F.min("min_change").alias("min_change"),
        F.max("max_change").alias("max_change"),
        F.sum("total").cast("decimal(38,0)").alias("total"),
        F.sum("squares").cast("decimal(38,0)").alias("squares"),
        joined("ids_both").alias("ids_both"),
        joined("ids_missing").alias("ids_missing"),
    )
    deviation = sample_stddev(F.col("total"), F.col("squares"), F.col("n")) / 1_000_000
    report = sums.filter(F.col("n") > 0).select(
        F.col("neighborhood").alias("Neighborhood"),
        F.col("listings").alias("Total Listings"),
        F.col("n").alias("Listings with Both Dates"),
        round_half_up(ratio(F.col("n") * 100, "listings"), 1).alias("Data Completeness (%)"),
        F.col("ids_both").alias("Listing IDs"),
        round_half_up("before", 2).alias("Avg Price (July 2021)"),
        round_half_up("after", 2).alias("Avg Price (July 2022)"),
        round_half_up("change", 2).alias("Avg Price Increase ($)"),
        round_half_up(ratio("change", "before") * 100, 2).alias("Avg Price Increase (%)"),
        round_half_up("min_change", 2).alias("Min Price Change ($)"),
        round_half_up("max_change", 2).alias("Max Price Change ($)"),
        round_half_up(deviation, 2).alias("StdDev Price Change"),
        F.col("ids_missing").alias("Listings Missing 2022 Data"),
    )
    # The rank runs over neighborhoods and increases alone, not over the texts of ids.
    by_increase = Window.orderBy(F.desc_nulls_last("Avg Price Increase ($)"))
    ranks = report.select(
        F.col("Neighborhood").alias("__neighborhood"),
        F.rank().over(by_increase).cast("long").alias("Rank by Increase"),
    )
    return (
        report.join(ranks, F.col("Neighborhood") == F.col("__neighborhood"))
        .drop("__neighborhood")
        .orderBy(F.desc_nulls_last("Avg Price Increase ($)"), "Neighborhood")
    )


def _longest_stays(spans: DataFrame, *carried: str) -> DataFrame:
    """Per listing the longest stay and the span that allows it, the earliest on a tie."""
    nights = F.col("effective_max_stay_nights")
    best = F.max_by(
        F.struct("span_start_date", "span_end_date"),
        F.struct(nights, -F.unix_date("span_start_date"), -F.unix_date("span_end_date")),
    )
    mean = round_half_up(ratio(F.sum(nights), F.count(nights)), 1)
    return (
        spans.groupBy("listing_id", "listing_name", "neighborhood", *carried)
        .agg(
            F.max(nights).alias("max_possible_stay_nights"),
            best.alias("best"),
            F.count(F.lit(1)).alias("total_availability_spans"),
            mean.alias("avg_span_duration"),
        )
        .withColumns(
            {
                "best_span_start": F.col("best.span_start_date"),
                "best_span_end": F.col("best.span_end_date"),
            }
        )
        .drop("best")
    )


def _with_dimensions(
    stays: DataFrame, dim_listings: DataFrame, dim_date: DataFrame, days: dict[str, str]
) -> DataFrame:
    current = dim_listings.filter("is_current").select(
        F.col("listing_id").alias("__id"),
        F.col("neighborhood").alias("__neighborhood"),
        "property_type",
        "room_type",
        "accommodates",
        "capacity_tier",
        "price_tier",
        "rating_tier",
        "base_price",
        "review_scores_rating",
    )
    dates = dim_date.select(
        F.col("date_day").alias("__day"), *[F.col(c).alias(a) for c, a in days.items()]
    )
    return (
        stays.join(current, stays["listing_id"] == current["__id"], "left")
        .join(dates, F.col("best_span_start") == F.col("__day"), "left")
        .drop("__id", "__day")
    )


def max_stay(spans: DataFrame, dim_listings: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The longest bookable stay of each listing, ranked overall and per neighborhood.

    The stays, one row per listing, are written once: the ranks read them three times, and each
    would run over all nights again.
    """
    stays, _ = staged(
        _with_dimensions(
            _longest_stays(spans),
            dim_listings,
            dim_date,
            {"season": "best_span_season", "is_peak_season": "best_span_in_peak_season"},
        ),
        "stays",
    )
    ranked = dense_rank_by_value(
        stays,
        "max_possible_stay_nights",
        "overall_stay_rank",
        within=("__neighborhood", "neighborhood_stay_rank"),
    )
    return ranked.select(
        "listing_id",
        "listing_name",
        "neighborhood",
        "property_type",
        "room_type",
        "accommodates",
        "capacity_tier",
        "price_tier",
        "rating_tier",
        "base_price",
        "review_scores_rating",
        "max_possible_stay_nights",
        "best_span_start",
        "best_span_end",
        "best_span_season",
        "best_span_in_peak_season",
        "total_availability_spans",
        "avg_span_duration",
        "overall_stay_rank",
        "neighborhood_stay_rank",
        F.when(F.col("overall_stay_rank") == 1, "Tied for Longest").alias("longest_stay_flag"),
    ).orderBy(F.desc_nulls_first("max_possible_stay_nights"), "listing_id")


def max_stay_with_amenities(
    spans: DataFrame,
    dim_listings: DataFrame,
    dim_date: DataFrame,
    vocabulary: Sequence[str],
    lockbox: Sequence[str] = LOCKBOX,
    first_aid_kit: Sequence[str] = FIRST_AID_KIT,
) -> DataFrame:
    """The longest stay of listings with both required amenities, against the overall one.

    An amenity without any known spelling leaves no listing that has it.
    """
    names = [resolve_alias(lockbox, vocabulary), resolve_alias(first_aid_kit, vocabulary)]
    qualified = F.lit(True)
    for name in names:
        qualified = qualified & (F.lit(False) if name is None else amenity_flag(spans, name))
    # One aggregate per listing, written once, serves the overall maximum, the qualified listings
    # and their ranks.
    longest_of_all, _ = staged(
        _longest_stays(spans.withColumn("__qualified", qualified), "__qualified"), "stays"
    )
    overall = longest_of_all.agg(F.max("max_possible_stay_nights"))
    qualified_stays = longest_of_all.filter("__qualified").drop("__qualified")
    # The ranks need no dimension: it joins last, once.
    stays = _with_dimensions(
        dense_rank_by_value(qualified_stays, "max_possible_stay_nights", "stay_rank"),
        dim_listings,
        dim_date,
        {"season": "best_span_season", "month_name": "best_span_month"},
    )
    nights, longest = F.col("max_possible_stay_nights"), F.col("global_max_stay")
    shorter = F.col("days_shorter_than_max")
    summary = F.concat(
        F.lit("Max stay with Lockbox+First Aid Kit is "),
        nights.cast("string"),
        F.lit(" nights, which is "),
        F.abs(shorter).cast("string"),
        F.lit(" nights shorter than the overall maximum of "),
        longest.cast("string"),
        F.lit(" nights"),
    )
    return (
        stays.withColumn("global_max_stay", overall.scalar())
        .withColumn("days_shorter_than_max", nights - longest)
        .select(
            "listing_id",
            "listing_name",
            "neighborhood",
            "property_type",
            "room_type",
            "accommodates",
            "capacity_tier",
            "price_tier",
            "base_price",
            "review_scores_rating",
            F.lit(True).alias("has_lockbox"),
            F.lit(True).alias("has_first_aid_kit"),
            "max_possible_stay_nights",
            "best_span_start",
            "best_span_end",
            "best_span_season",
            "best_span_month",
            "total_availability_spans",
            "avg_span_duration",
            "stay_rank",
            "global_max_stay",
            "days_shorter_than_max",
            summary.alias("insight_summary"),
            F.lit(names[0] or "NOT FOUND").alias("lockbox_column_used"),
            F.lit(names[1] or "NOT FOUND").alias("first_aid_kit_column_used"),
        )
        .orderBy(F.desc_nulls_first("max_possible_stay_nights"), "listing_id")
    )
