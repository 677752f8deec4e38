"""Lodging sources derived from the order tables, for tests, checks and the benchmark.

A supplier plays a listing, its order lines play reservations (or reviews, when returned)
and their parts name amenities: a name is kept when the line numbers of its lines add up to an
even number. Every order line reaches a source, and the calendar spans all their dates.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.sources.raw import RawSources

# Ship dates move into the range of the date dimension (1995-01-02 -> 2020-01-02).
SHIFT_DAYS = 9131
# The moment the sources are looked at.
AS_OF = "2022-08-01 06:00:00"

# The amenity of a part by its type, any other type being the first of these, in the order of
# their names. One name carries a blank that staging has to trim.
AMENITIES = {
    None: " Pool",
    "ECONOMY": "Air conditioning",
    "MEDIUM": "First aid kit",
    "STANDARD": "Kitchen",
    "SMALL": "Lockbox",
    "PROMO": "Wifi",
}
SHIP_DAY = f"date_add(CAST(l_shipdate AS DATE), {SHIFT_DAYS})"

# Opens one of the given tables.
Tables = Callable[[str], DataFrame]


def _amenity_lists(tables: Tables, **keys: str) -> DataFrame:
    """Per key the JSON list of the names that are kept, from all lines; none gives '[]'.

    A name is a bit: a key's lines are grouped once, into the names that they have and the names
    whose line numbers add up to an odd number.
    """
    place = F.lit(1)
    for n, kind in enumerate(AMENITIES):
        if kind is not None:
            place = F.when(F.col("p_type") == kind, F.lit(1 << n)).otherwise(place)
    parts = tables("part").select("p_partkey", place.alias("place"))
    # A line without a number adds nothing and has no name.
    number = F.col("l_linenumber")
    counted = (
        tables("lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(*[F.expr(value).alias(name) for name, value in keys.items()])
        .agg(
            F.bit_or(F.when(number.isNotNull(), F.col("place")).otherwise(0)).alias("named"),
            F.bit_xor(F.when(number % 2 != 0, F.col("place")).otherwise(0)).alias("odd"),
        )
    )
    kept = F.col("named").bitwiseAND(F.bitwise_not("odd"))
    names = [
        F.when(kept.bitwiseAND(F.lit(1 << n)) != 0, F.lit(name))
        for n, name in enumerate(AMENITIES.values())
    ]
    return counted.select(*keys, F.to_json(F.array_compact(F.array(*names))).alias("amenities"))


def listings(tables: Tables) -> DataFrame:
    owned = _amenity_lists(tables, l_suppkey="l_suppkey").withColumnRenamed("amenities", "owned")
    return (
        tables("supplier")
        .withColumnRenamed("s_suppkey", "k")
        .join(tables("nation"), F.expr("s_nationkey = n_nationkey"))
        .join(owned, F.expr("k = l_suppkey"), "left")
        .selectExpr(
            "k AS id",
            "s_name AS name",
            "n_name AS neighborhood",
            "elt(int(k % 4) + 1, 'Condo', 'Apartment', 'House', 'Loft') AS property_type",
            "elt(int(k % 3) + 1, 'Entire home/apt', 'Private room', 'Shared room') AS room_type",
            "int(k % 8 + 1) AS accommodates",
            "int(k % 4 + 1) AS bedrooms",
            "int(k % 5 + 1) AS beds",
            "if(k % 7 = 0, 'Half-bath', concat(k % 3 + 1, '.5 baths')) AS bathrooms_text",
            "k % 40 AS host_id",
            "concat('Host ', k % 40) AS host_name",
            "n_name AS host_location",
            "if(k % 40 = 3, 'unknown', concat(2010 + k % 16, '-0', k % 9 + 1, '-15'))"
            " AS host_since",
            """'["email", "phone"]' AS host_verifications""",
            "if(s_acctbal >= 0, concat('$', format_number(floor(s_acctbal), 0), '.50'), NULL)"
            " AS price",
            "int(k % 50) AS number_of_reviews",
            "if(k % 11 = 0, NULL, concat('2021-0', k % 9 + 1, '-01')) AS first_review",
            "'2022-06-15' AS last_review",
            "if(k % 13 = 0, NULL, 2.5D + (k % 26) / 10.0D) AS review_scores_rating",
            "if(k % 17 = 0, '[]', coalesce(owned, '[]')) AS amenities",
            f"TIMESTAMP '{AS_OF}' - make_dt_interval(int(k % 5 + 1)) AS _loaded_at",
        )
    )


def calendar(tables: Tables) -> DataFrame:
    # A given number of tasks, before and after their months are written out: by their bytes, the
    # suppliers would be put together in one, and the months in few. Nights keep that dealing, by
    # month and listing, for all joins on both, and come to them by month.
    lines = tables("lineitem")
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Nights meet their reservations as whole months, at most 31 to a row, and are written out
    # after that: neither one task nor an exchange has a row per night. Reservations are dealt to
    # their months once, hardly any two share a night.
    taken = (
        lines.filter("l_returnflag <> 'R' AND l_shipdate IS NOT NULL")
        .selectExpr("l_suppkey AS k", f"{SHIP_DAY} AS day", "l_orderkey")
        .withColumn("month", F.trunc("day", "month"))
        .repartition(tasks, "month", "k")
        .groupBy("k", "month", "day")
        .agg(F.min("l_orderkey").alias("reservation_id"))
        .groupBy("k", "month")
        .agg(F.map_from_entries(F.collect_list(F.struct("day", "reservation_id"))).alias("taken"))
    )
    days = tables("lineitem").selectExpr(f"{SHIP_DAY} AS day")
    first, last = days.agg(F.min("day")).scalar(), days.agg(F.max("day")).scalar()
    month = F.make_ym_interval(months=F.lit(1))
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), month)
    listed = (
        tables("supplier")
        .select(F.col("s_suppkey").alias("k"))
        .repartition(tasks)
        .select("k", F.explode(months).alias("month"))
        .repartition(tasks, "month", "k")
    )
    in_month = F.sequence(F.greatest("month", first), F.least(F.last_day("month"), last))
    nights = listed.join(taken, ["month", "k"], "left").select(
        "k", "month", "taken", F.explode(in_month).alias("day")
    )
    return nights.withColumn("reservation_id", F.col("taken")[F.col("day")]).selectExpr(
        "k AS listing_id",
        "day AS date",
        "if(reservation_id IS NULL AND (k * 7 + dayofyear(day)) % 11 <> 0, 't', 'f')"
        " AS available",
        "reservation_id",
        "CAST((k * 13) % 400 + month(day) * 3 + 50 AS DECIMAL(10,2)) AS price",
        "int(k % 5 + 1) AS minimum_nights",
        "int(if(k % 9 = 0, 0, k % 30 + 3)) AS maximum_nights",
        # Some nights were loaded again shortly before the sources are looked at.
        f"if((k * 31 + dayofyear(day)) % 97 = 0, TIMESTAMP '{AS_OF}' - INTERVAL 5 HOURS,"
        " timestamp_seconds(unix_date(day) * 86400L + 25 * 3600)) AS _loaded_at",
        "month AS calendar_month",
    )


def generated_reviews(tables: Tables) -> DataFrame:
    return (
        tables("lineitem")
        .filter("l_returnflag = 'R'")
        .selectExpr(
            "if(l_orderkey % 997 = 0, NULL, l_orderkey * 8 + l_linenumber) AS id",
            "l_suppkey AS listing_id",
            f"{SHIP_DAY} AS review_date",
            "double(l_linenumber % 5 + 1) AS review_score",
            f"least(CAST({SHIP_DAY} AS TIMESTAMP), TIMESTAMP '{AS_OF}' - INTERVAL 9 DAYS)"
            " AS _loaded_at",
        )
    )


def amenities_changelog(tables: Tables) -> DataFrame:
    lists = _amenity_lists(tables, listing_id="l_suppkey", quarter=f"trunc({SHIP_DAY}, 'quarter')")
    return lists.selectExpr(
        "listing_id",
        "CAST(quarter AS TIMESTAMP) AS change_at",
        "amenities",
        f"least(CAST(quarter AS TIMESTAMP), TIMESTAMP '{AS_OF}' - INTERVAL 3 DAYS) AS _loaded_at",
    )


def derived_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    tables: Tables = cache(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    makers = {
        "listings": listings,
        "calendar": calendar,
        "generated_reviews": generated_reviews,
        "amenities_changelog": amenities_changelog,
    }
    return RawSources(lambda name: makers[name](tables))
