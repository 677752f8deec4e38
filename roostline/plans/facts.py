"""The nightly fact and its monthly rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roostline.functions import (
    date_key,
    exact_average,
    exact_sum,
    pct_change,
    ratio,
    round_half_up,
    sample_stddev,
)
from roostline.functions.amenities import quoted
from roostline.operators import left_join_hot_right
from roostline.plans.intermediate import ENRICHED_ATTRIBUTES, with_listing_periods

FACT_KEY = ("listing_id", "calendar_date")
FACT_COLUMNS = (
    "listing_id",
    "calendar_date",
    "date_key",
    "is_available",
    "is_reserved",
    "reservation_id",
    "minimum_nights",
    "maximum_nights",
    "adjusted_price",
    "base_price",
    "price_variance",
    "listing_name",
    "neighborhood",
    "property_type",
    "room_type",
    "accommodates",
    "bedrooms",
    "beds",
    "bathrooms",
    "host_id",
    "host_name",
    "number_of_reviews",
    "review_scores_rating",
    "daily_review_score",
    "review_id",
    "daily_revenue",
    "is_occupied",
    "available_flag",
    "is_blocked",
    "calendar_week",
    "calendar_month",
    "calendar_quarter",
    "calendar_year",
    "day_of_week",
    "is_weekend",
)
# Of the keyed fact only: all reviews of the night and the sum of their scores.
NIGHT_COLUMNS = ("night_review_count", "night_review_score")
# Room types counted by name.
ROOM_TYPES = {
    "entire_home_listings": "Entire home/apt",
    "private_room_listings": "Private room",
    "shared_room_listings": "Shared room",
}


def _with_reviews(calendar: DataFrame, reviews: DataFrame, mode: str) -> DataFrame:
    # The month follows from the date; with it among the keys, nights that are dealt by listing
    # and month stay where they are, in this join and in that of the listing periods.
    keys = ["calendar_month", "listing_id", "calendar_date"]
    dated = reviews.select(
        "listing_id",
        F.trunc("review_date", "month").alias("calendar_month"),
        F.col("review_date").alias("calendar_date"),
        "review_score",
        "review_id",
    )
    if mode == "fanout":
        joined = left_join_hot_right(calendar, dated, keys)
    elif mode == "aggregate":
        daily = dated.groupBy(*keys).agg(
            exact_average("review_score").alias("review_score"),
            F.min("review_id").alias("review_id"),
            F.count("review_id").alias("night_review_count"),
            exact_sum("review_score").alias("night_review_score"),
        )
        joined = calendar.join(daily, keys, "left").withColumns(
            {
                "night_review_count": F.coalesce("night_review_count", F.lit(0).cast("long")),
                "night_review_score": F.coalesce(
                    "night_review_score", F.lit(0).cast("decimal(38,12)")
                ),
            }
        )
    else:
        raise ValueError(f"reviews must be 'fanout' or 'aggregate', not {mode!r}")
    return joined.withColumn("daily_review_score", F.coalesce("review_score", F.lit(0.0))).drop(
        "review_score"
    )


def fct_daily(
    calendar: DataFrame,
    listings: DataFrame,
    scd: DataFrame | None,
    stg_reviews: DataFrame,
    reviews: str = "fanout",
    vocabulary: list[str] | None = None,
    dated: bool = False,
) -> DataFrame:
    """Nightly revenue, occupancy, price, reviews and point-in-time amenities.

    ``reviews='fanout'`` repeats a night once per review of that night. ``'aggregate'``
    keeps one row per listing and night (mean score, smallest review id, number of reviews
    and sum of their scores, from which the rollups count every review); a keyed upsert needs
    it. Reviews join first, while a calendar row is still narrow; the listing join
    comes last, so the result is already partitioned by listing for the monthly rollup.

    With a vocabulary the amenities become one boolean column per name, otherwise they stay
    one array column. Without a history (``scd=None``) the fact has no amenities: its other columns
    are those of the listing on every date, so the rows are the same and no periods are made.
    ``dated`` as in :func:`with_listing_periods`.
    """
    reviewed = _with_reviews(calendar, stg_reviews, reviews)
    if scd is None:
        # Spark takes written out nights for as few as their months, and would broadcast them.
        known = listings.select("listing_id", *ENRICHED_ATTRIBUTES)
        nights = reviewed.hint("merge").join(known, "listing_id")
    else:
        nights = with_listing_periods(
            reviewed, listings, scd, ENRICHED_ATTRIBUTES, vocabulary, dated
        )
    reserved, available = F.col("is_reserved"), F.col("is_available")
    price = F.col("daily_price")
    zero = F.lit(0).cast("decimal(10,2)")
    if scd is None:
        amenities = []
    elif vocabulary is None:
        amenities = [F.col("amenities")]
    else:
        amenities = [quoted(name) for name in vocabulary]
    computed = {
        "date_key": date_key("calendar_date"),
        "adjusted_price": price,
        "price_variance": F.coalesce(price, zero) - F.coalesce("base_price", zero),
        "daily_revenue": F.when(reserved, price).otherwise(zero),
        "is_occupied": reserved.cast("int"),
        "available_flag": available.cast("int"),
        "is_blocked": (~available & ~reserved).cast("int"),
        "calendar_week": F.trunc("calendar_date", "week"),
        "calendar_quarter": F.trunc("calendar_date", "quarter"),
    }
    extra = NIGHT_COLUMNS if reviews == "aggregate" else ()
    return nights.select(
        *[computed.get(name, F.col(name)).alias(name) for name in (*FACT_COLUMNS, *extra)],
        *amenities,
    )


def _review_count(fact: DataFrame) -> Column:
    if "night_review_count" in fact.columns:
        return F.sum("night_review_count")
    return F.count("review_id")


def _review_score(fact: DataFrame) -> Column:
    if "night_review_score" in fact.columns:
        return F.sum("night_review_score")
    return exact_sum("daily_review_score")


def _occupancy_rate(occupied: str, available: str) -> Column:
    return round_half_up(ratio(occupied, F.col(occupied) + F.col(available)) * 100, 2)


def fct_monthly_listing(fact: DataFrame) -> DataFrame:
    """Monthly figures per listing with the change against its previous month on record."""
    cents = (F.col("adjusted_price") * 100).cast("decimal(18,0)")
    sums = fact.groupBy("listing_id", "calendar_month", "calendar_year").agg(
        *[
            F.max(c).alias(c)
            for c in (
                "listing_name",
                "neighborhood",
                "property_type",
                "room_type",
                "accommodates",
                "beds",
                "host_id",
            )
        ],
        F.sum("daily_revenue").alias("total_revenue"),
        F.count("daily_revenue").alias("__revenue_nights"),
        F.max("daily_revenue").alias("max_daily_revenue"),
        F.sum("adjusted_price").alias("__price"),
        F.count("adjusted_price").alias("__price_nights"),
        F.sum("base_price").alias("__base_price"),
        F.count("base_price").alias("__base_price_nights"),
        F.sum("is_occupied").alias("occupied_nights"),
        F.sum("available_flag").alias("available_nights"),
        F.sum("is_blocked").alias("blocked_nights"),
        F.count(F.lit(1)).alias("total_nights"),
        exact_average("review_scores_rating").alias("avg_review_score"),
        _review_count(fact).alias("review_count"),
        _review_score(fact).cast("double").alias("total_review_score"),
        F.min("adjusted_price").alias("min_nightly_rate"),
        F.max("adjusted_price").alias("max_nightly_rate"),
        F.sum(cents).cast("decimal(38,0)").alias("__cents"),
        F.sum(cents * cents).cast("decimal(38,0)").alias("__squares"),
    )
    nights = F.col("occupied_nights") + F.col("available_nights")
    metrics = sums.select(
        "listing_id",
        "calendar_month",
        "calendar_year",
        "listing_name",
        "neighborhood",
        "property_type",
        "room_type",
        "accommodates",
        "beds",
        "host_id",
        "total_revenue",
        ratio("total_revenue", "__revenue_nights").alias("avg_daily_revenue"),
        "max_daily_revenue",
        ratio("__price", "__price_nights").alias("avg_nightly_rate"),
        ratio("__base_price", "__base_price_nights").alias("avg_base_price"),
        "occupied_nights",
        "available_nights",
        "blocked_nights",
        "total_nights",
        _occupancy_rate("occupied_nights", "available_nights").alias("occupancy_rate_pct"),
        "avg_review_score",
        "review_count",
        "total_review_score",
        "min_nightly_rate",
        "max_nightly_rate",
        sample_stddev(F.col("__cents"), F.col("__squares"), F.col("__price_nights")).alias(
            "price_volatility"
        ),
        round_half_up(ratio("total_revenue", nights), 2).alias("revpar"),
    )
    previous = Window.partitionBy("listing_id").orderBy("calendar_month")
    return (
        metrics.withColumns(
            {
                "prev_month_revenue": F.lag("total_revenue").over(previous),
                "prev_month_occupancy_rate": F.lag("occupancy_rate_pct").over(previous),
                "prev_month_avg_rate": F.lag("avg_nightly_rate").over(previous),
            }
        )
        .withColumn("revenue_mom_change_pct", pct_change("total_revenue", "prev_month_revenue"))
        .withColumn(
            "occupancy_mom_change_pts",
            F.col("occupancy_rate_pct") - F.col("prev_month_occupancy_rate"),
        )
        .withColumn("rate_mom_change_pct", pct_change("avg_nightly_rate", "prev_month_avg_rate"))
    )


def _exact_medians(nights: DataFrame, group: list[str]) -> DataFrame:
    prices = (
        nights.filter(F.col("adjusted_price").isNotNull())
        .groupBy(*group, "adjusted_price")
        .agg(F.count(F.lit(1)).alias("__copies"))
    )
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("adjusted_price").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = prices.withColumns(
        {"__last": F.sum("__copies").over(upto), "__all": F.sum("__copies").over(whole)}
    )
    price = F.col("adjusted_price").cast("double")
    low = F.min(F.when(F.col("__last") * 2 >= F.col("__all"), price))
    high = F.min(F.when(F.col("__last") * 2 > F.col("__all"), price))
    return placed.groupBy(*group).agg(((low + high) / 2).alias("median_nightly_rate"))


def _approximate_medians(nights: DataFrame, group: list[str]) -> DataFrame:
    middle = F.percentile_approx("adjusted_price", F.lit(0.5)).cast("double")
    return nights.groupBy(*group).agg(middle.alias("median_nightly_rate"))


def fct_monthly_neighborhood(fact: DataFrame, median: str = "exact") -> DataFrame:
    """Monthly figures per neighborhood: ranks, market shares, change against last month.

    Distinct listings are counted by first rolling up to listing and month, so the nights
    are neither expanded once per distinct count nor gathered by neighborhood. The exact
    median counts equal prices before the shuffle and runs over these counts in order, in a
    window that may spill; ``median='approx'`` is an opt-in that keeps a sketch instead.
    """
    located = fact.filter(F.col("neighborhood").isNotNull())
    group = ["neighborhood", "calendar_month", "calendar_year"]
    per_listing = located.groupBy(*group, "listing_id").agg(
        F.sum("daily_revenue").alias("revenue"),
        F.count("daily_revenue").alias("revenue_nights"),
        F.sum("is_occupied").alias("occupied"),
        F.sum("available_flag").alias("available"),
        F.sum("is_blocked").alias("blocked"),
        F.count(F.lit(1)).alias("nights"),
        F.sum("adjusted_price").alias("price"),
        F.count("adjusted_price").alias("price_nights"),
        F.min("adjusted_price").alias("min_price"),
        F.max("adjusted_price").alias("max_price"),
        *[
            F.max((F.col("room_type") == value).cast("int")).alias(name)
            for name, value in ROOM_TYPES.items()
        ],
        exact_sum("review_scores_rating").alias("rating"),
        F.count("review_scores_rating").alias("rating_nights"),
        _review_count(fact).alias("reviews"),
    )
    sums = per_listing.groupBy(*group).agg(
        F.count("listing_id").alias("active_listings"),
        F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.sum("revenue_nights").alias("__revenue_nights"),
        F.sum("occupied").alias("total_occupied_nights"),
        F.sum("available").alias("total_available_nights"),
        F.sum("blocked").alias("total_blocked_nights"),
        F.sum("nights").alias("total_listing_nights"),
        F.sum("price").alias("__price"),
        F.sum("price_nights").alias("__price_nights"),
        F.min("min_price").alias("min_nightly_rate"),
        F.max("max_price").alias("max_nightly_rate"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ROOM_TYPES],
        ratio(F.sum("rating"), F.sum("rating_nights")).alias("avg_review_score"),
        F.sum("reviews").alias("total_reviews"),
    )
    medians = {"exact": _exact_medians, "approx": _approximate_medians}[median](located, group)
    same = F.lit(True)
    for c in group:
        same = same & sums[c].eqNullSafe(medians[c])
    nights = F.col("total_occupied_nights") + F.col("total_available_nights")
    metrics = sums.join(medians, same, "left").select(
        *[sums[c] for c in group],
        "active_listings",
        "total_revenue",
        ratio("total_revenue", "__revenue_nights").alias("avg_daily_revenue_per_listing"),
        "total_occupied_nights",
        "total_available_nights",
        "total_blocked_nights",
        "total_listing_nights",
        _occupancy_rate("total_occupied_nights", "total_available_nights").alias(
            "avg_occupancy_rate_pct"
        ),
        ratio("__price", "__price_nights").alias("avg_nightly_rate"),
        "median_nightly_rate",
        "min_nightly_rate",
        "max_nightly_rate",
        *ROOM_TYPES,
        "avg_review_score",
        "total_reviews",
        round_half_up(ratio("total_revenue", nights), 2).alias("neighborhood_revpar"),
    )
    # From here on there is one row per neighborhood and month.
    month = Window.partitionBy("calendar_month")
    trend = Window.partitionBy("neighborhood").orderBy("calendar_month")

    def rank(order: Column) -> Column:
        return F.rank().over(month.orderBy(order)).cast("long")

    def share(part: str) -> Column:
        return round_half_up(ratio(part, F.sum(part).over(month)) * 100, 2)

    return (
        metrics.withColumns(
            {
                # Without a NULLS clause the source dialect puts NULL first in descending order.
                "revenue_rank": rank(F.desc_nulls_first("total_revenue")),
                "occupancy_rank": rank(F.desc_nulls_first("avg_occupancy_rate_pct")),
                "price_rank": rank(F.desc_nulls_first("avg_nightly_rate")),
                "review_rank": rank(F.desc_nulls_last("avg_review_score")),
                "revenue_market_share_pct": share("total_revenue"),
                "listing_market_share_pct": share("active_listings"),
                "prev_month_revenue": F.lag("total_revenue").over(trend),
                "prev_month_occupancy": F.lag("avg_occupancy_rate_pct").over(trend),
            }
        )
        .withColumn("revenue_mom_change_pct", pct_change("total_revenue", "prev_month_revenue"))
        .withColumn(
            "occupancy_mom_change_pts",
            F.col("avg_occupancy_rate_pct") - F.col("prev_month_occupancy"),
        )
    )
