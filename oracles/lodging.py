"""One statement per registered query; every column is cast to a type both engines share."""

from __future__ import annotations

from oracles.relations import (
    NAMES,
    NOW,
    deviation,
    flags,
    ratio,
    rounded,
    statement,
)

DATES = {
    "calendar_date", "calendar_month", "calendar_year", "calendar_week", "calendar_quarter",
    "review_date", "change_at", "valid_from", "valid_to", "host_since_date",
    "first_review_date", "last_review_date", "record_observed_date", "span_start_date",
    "span_end_date", "best_span_start", "best_span_end", "date_day", "week_start_date",
    "week_end_date", "month_start_date", "month_end_date", "quarter_start_date",
    "year_start_date", "same_day_last_week", "same_day_last_month", "same_day_last_year",
}
DOUBLES = {
    "bathrooms", "base_price", "review_scores_rating", "daily_price", "review_score",
    "daily_revenue", "adjusted_price", "price_variance", "daily_review_score",
    "total_revenue", "max_daily_revenue", "min_nightly_rate", "max_nightly_rate",
    "total_review_score", "prev_month_revenue", "month_total_revenue",
    "same_month_last_year_revenue", "night_review_score", "price_before", "price_after",
    "difference",
}
AS_IS = {
    "listing_name", "neighborhood", "property_type", "room_type", "bathrooms_raw", "host_name",
    "host_location", "host_verifications", "amenities_raw", "is_available", "is_reserved",
    "is_weekend", "is_bookable", "is_current", "day_name", "month_name", "quarter_name",
    "is_weekday", "is_holiday", "holiday_name", "season", "is_peak_season", "date_iso",
    "host_sk", "listing_sk", "host_experience_tier", "capacity_tier", "price_tier",
    "rating_tier", "has_air_conditioning", "ac_segment", "ac_column_used",
    "pct_of_monthly_revenue", "avg_revenue_per_listing", "yoy_revenue_change_pct",
    "avg_span_duration", "best_span_season", "best_span_in_peak_season", "best_span_month",
    "longest_stay_flag", "has_lockbox", "has_first_aid_kit", "insight_summary",
    "lockbox_column_used", "first_aid_kit_column_used", "avg_daily_revenue",
    "avg_nightly_rate", "avg_base_price", "occupancy_rate_pct", "avg_review_score",
    "price_volatility", "revpar", "prev_month_occupancy_rate", "prev_month_avg_rate",
    "revenue_mom_change_pct", "occupancy_mom_change_pts", "rate_mom_change_pct",
    "avg_daily_revenue_per_listing", "avg_occupancy_rate_pct", "median_nightly_rate",
    "neighborhood_revpar", "revenue_market_share_pct", "listing_market_share_pct",
    "prev_month_occupancy",
}


def columns(names: str, table: str = "") -> str:
    """Typed select list; names that are neither dates, doubles nor as-is are integers."""
    result = []
    for name in names.split():
        ref = f"{table}.{name}" if table else name
        if name in AS_IS:
            result.append(f"{ref} AS {name}")
        else:
            kind = "VARCHAR" if name in DATES else "DOUBLE" if name in DOUBLES else "BIGINT"
            if name == "calendar_year" and table == "d":
                kind = "BIGINT"
            result.append(f"CAST({ref} AS {kind}) AS {name}")
    return ", ".join(result)


STG_CALENDAR = """listing_id calendar_date is_available reservation_id is_reserved daily_price
    minimum_nights maximum_nights calendar_month calendar_year day_of_week is_weekend"""
FACT = """listing_id calendar_date date_key is_available is_reserved reservation_id
    minimum_nights maximum_nights adjusted_price base_price price_variance listing_name
    neighborhood property_type room_type accommodates bedrooms beds bathrooms host_id host_name
    number_of_reviews review_scores_rating daily_review_score review_id daily_revenue
    is_occupied available_flag is_blocked calendar_week calendar_month calendar_quarter
    calendar_year day_of_week is_weekend"""
NIGHTLY = FACT + " night_review_count night_review_score"
HOSTS = """host_id host_name host_location host_since_date record_observed_date valid_from
    valid_to is_current"""
LISTINGS_HISTORY = """listing_id listing_name neighborhood property_type room_type accommodates
    beds host_id base_price number_of_reviews review_scores_rating valid_from valid_to
    is_current"""
DATE_COLUMNS = """date_day day_of_week day_name day_of_month day_of_year week_of_year
    week_start_date week_end_date month_number month_name month_start_date month_end_date
    quarter_number quarter_name quarter_start_date calendar_year year_start_date fiscal_year
    fiscal_quarter is_weekend is_weekday is_holiday holiday_name season is_peak_season
    same_day_last_week same_day_last_month same_day_last_year days_ago date_iso date_key"""
LISTING_MONTHS = """listing_id calendar_month calendar_year listing_name neighborhood
    property_type room_type accommodates beds host_id total_revenue avg_daily_revenue
    max_daily_revenue avg_nightly_rate avg_base_price occupied_nights available_nights
    blocked_nights total_nights occupancy_rate_pct avg_review_score review_count
    total_review_score min_nightly_rate max_nightly_rate price_volatility revpar
    prev_month_revenue prev_month_occupancy_rate prev_month_avg_rate revenue_mom_change_pct
    occupancy_mom_change_pts rate_mom_change_pct"""
NEIGHBORHOOD_MONTHS = """neighborhood calendar_month calendar_year active_listings total_revenue
    avg_daily_revenue_per_listing total_occupied_nights total_available_nights
    total_blocked_nights total_listing_nights avg_occupancy_rate_pct avg_nightly_rate
    median_nightly_rate min_nightly_rate max_nightly_rate entire_home_listings
    private_room_listings shared_room_listings avg_review_score total_reviews
    neighborhood_revpar revenue_rank occupancy_rank price_rank review_rank
    revenue_market_share_pct listing_market_share_pct prev_month_revenue prev_month_occupancy
    revenue_mom_change_pct occupancy_mom_change_pts"""

STATEMENTS: dict[str, str] = {}

STATEMENTS["stg_listings"] = f"""
    SELECT {columns('''listing_id listing_name neighborhood property_type room_type accommodates
        bedrooms beds bathrooms bathrooms_raw host_id host_name host_location host_since_date
        host_verifications base_price number_of_reviews first_review_date last_review_date
        review_scores_rating amenities_raw''')}, {flags('amenities')}
    FROM listings"""
STATEMENTS["stg_calendar"] = f"SELECT {columns(STG_CALENDAR)} FROM calendar"
STATEMENTS["stg_reviews"] = (
    f"SELECT {columns('review_id listing_id review_date review_score')} FROM reviews"
)
STATEMENTS["stg_amenities_changelog"] = f"""
    SELECT {columns('listing_id change_at')}, {flags('amenities')} FROM changelog"""
STATEMENTS["amenity_vocabulary"] = "SELECT DISTINCT amenity_name FROM change_names"
STATEMENTS["listing_amenity_vocabulary"] = "SELECT DISTINCT amenity_name FROM listing_names"
STATEMENTS["listing_amenities_scd"] = f"""
    SELECT {columns('listing_id valid_from valid_to')}, {flags('amenities')} FROM scd"""
STATEMENTS["availability_spans"] = f"""
    SELECT {columns('''listing_id span_start_date span_end_date consecutive_available_days
        min_nights_required max_nights_allowed effective_max_stay_nights is_bookable
        listing_name neighborhood property_type room_type accommodates''')},
        {flags('amenities')}
    FROM spans"""
STATEMENTS["calendar_enriched"] = f"""
    SELECT {columns(STG_CALENDAR + ''' listing_name neighborhood property_type room_type
        accommodates bedrooms beds bathrooms base_price host_id host_name review_scores_rating
        number_of_reviews''')}, {flags('amenities')},
        CAST(CASE WHEN is_reserved THEN daily_price ELSE 0 END AS DOUBLE) AS daily_revenue,
        CAST(CASE WHEN is_reserved THEN 1 ELSE 0 END AS BIGINT) AS is_occupied
    FROM enriched"""
STATEMENTS["hosts_history"] = f"SELECT {columns(HOSTS)} FROM hosts_history"
STATEMENTS["listings_history"] = f"SELECT {columns(LISTINGS_HISTORY)} FROM listings_history"
STATEMENTS["dim_date"] = f"""
    SELECT {columns(DATE_COLUMNS, 'd')}, CAST(coalesce(n.nights, 0) AS BIGINT) AS nights
    FROM dim_date d LEFT JOIN (SELECT calendar_date, count(*) AS nights FROM calendar GROUP BY 1)
        n ON d.date_day = n.calendar_date"""
STATEMENTS["dim_hosts"] = f"""
    SELECT {columns('''host_sk host_id host_name host_location host_since_date
        host_tenure_years host_experience_tier valid_from valid_to is_current''')}
    FROM dim_hosts"""
STATEMENTS["dim_listings"] = f"""
    SELECT {columns('listing_sk ' + LISTINGS_HISTORY + ' capacity_tier price_tier rating_tier')},
        {flags('amenities')}
    FROM dim_listings"""
STATEMENTS["fct_daily"] = f"SELECT {columns(FACT)}, {flags('amenities')} FROM fact"
STATEMENTS["fct_daily_nightly"] = STATEMENTS["fct_daily_incremental"] = (
    f"SELECT {columns(NIGHTLY)}, {flags('amenities')} FROM nightly_fact"
)
EARLY = tuple(n for n in NAMES if n != "Wifi")
# The first load ends a week before the calendar, the window reaches a week behind that.
REPROCESSED = "(SELECT max(calendar_date) - 14 FROM calendar)"
STATEMENTS["fct_daily_schema_growth"] = f"""
    SELECT {columns(NIGHTLY)}, {flags('amenities')}
    FROM nightly_fact WHERE calendar_date >= {REPROCESSED}
    UNION ALL BY NAME
    SELECT {columns(NIGHTLY)}, {flags('amenities', EARLY)}, CAST(NULL AS BOOLEAN) AS "Wifi"
    FROM early_fact WHERE calendar_date < {REPROCESSED}"""
STATEMENTS["fct_monthly_listing"] = f"SELECT {columns(LISTING_MONTHS)} FROM listing_months"
STATEMENTS["fct_monthly_neighborhood"] = (
    f"SELECT {columns(NEIGHBORHOOD_MONTHS)} FROM neighborhood_months"
)
STATEMENTS["fct_monthly_listing_nightly"] = (
    f"SELECT {columns(LISTING_MONTHS)} FROM nightly_listing_months"
)
STATEMENTS["fct_monthly_neighborhood_nightly"] = (
    f"SELECT {columns(NEIGHBORHOOD_MONTHS)} FROM nightly_neighborhood_months"
)
STATEMENTS["daily_audit"] = f"""
    SELECT CASE
            WHEN calendar_date < {REPROCESSED} THEN '2022-07-01 06:00:00'
            ELSE '2022-08-01 06:00:00' END AS loaded_at,
        count(*) AS nights, CAST(min(calendar_date) AS VARCHAR) AS first_date,
        CAST(max(calendar_date) AS VARCHAR) AS last_date
    FROM nightly_fact GROUP BY 1"""


def amenity_revenue(segments: str) -> str:
    return f"""
    SELECT CAST(s.calendar_month AS VARCHAR) AS calendar_month,
        CAST(s.calendar_year AS BIGINT) AS calendar_year, month_name, quarter_name,
        CAST(fiscal_year AS BIGINT) AS fiscal_year, season, has_air_conditioning,
        CASE WHEN has_air_conditioning THEN 'With AC' ELSE 'Without AC' END AS ac_segment,
        {columns('total_revenue listing_count occupied_nights month_total_revenue')},
        {rounded(ratio('total_revenue', 'month_total_revenue') + ' * 100', 1)}
            AS pct_of_monthly_revenue,
        {rounded(ratio('total_revenue', 'listing_count'), 2)} AS avg_revenue_per_listing,
        {columns('same_month_last_year_revenue')},
        {rounded(ratio('total_revenue - same_month_last_year_revenue',
                       'same_month_last_year_revenue') + ' * 100', 1)} AS yoy_revenue_change_pct,
        'Air conditioning' AS ac_column_used
    FROM (SELECT *, lag(total_revenue) OVER (PARTITION BY has_air_conditioning,
            month(calendar_month) ORDER BY calendar_month) AS same_month_last_year_revenue
        FROM {segments}) s
    JOIN (SELECT calendar_month, sum(total_revenue) AS month_total_revenue FROM {segments}
        GROUP BY calendar_month) t ON s.calendar_month = t.calendar_month"""


STATEMENTS["amenity_revenue"] = amenity_revenue("segments")
STATEMENTS["amenity_revenue_nightly"] = amenity_revenue("nightly_segments")
PRICE_WINDOW = """avg_price AS price FROM (
        SELECT listing_id, CAST(sum(adjusted_price) / count(*) AS DECIMAL(18,8)) AS avg_price
        FROM {} WHERE calendar_date BETWEEN DATE '{}' AND DATE '{}' AND adjusted_price > 0
        GROUP BY listing_id)"""
DIFFERENCE = "price_after - price_before"
BOTH = f"({DIFFERENCE}) IS NOT NULL"
MEAN_BEFORE = ratio(f"sum(CASE WHEN {BOTH} THEN price_before END)", f"count({DIFFERENCE})")
MEAN_AFTER = ratio(f"sum(CASE WHEN {BOTH} THEN price_after END)", f"count({DIFFERENCE})")
MEAN_CHANGE = ratio(f"sum({DIFFERENCE})", f"count({DIFFERENCE})")


def price_pairs(fact: str) -> str:
    before = PRICE_WINDOW.format(fact, "2021-07-09", "2021-07-15")
    after = PRICE_WINDOW.format(fact, "2022-07-08", "2022-07-14")
    return f"""SELECT a.listing_id, a.neighborhood, b.price AS price_before,
                c.price AS price_after
            FROM (SELECT DISTINCT listing_id, neighborhood FROM {fact}
                WHERE neighborhood IS NOT NULL) a
            LEFT JOIN (SELECT listing_id, {before}) b ON a.listing_id = b.listing_id
            LEFT JOIN (SELECT listing_id, {after}) c ON a.listing_id = c.listing_id"""


def neighborhood_pricing(fact: str) -> str:
    return f"""
    SELECT *, rank() OVER (ORDER BY "Avg Price Increase ($)" DESC NULLS LAST)
        AS "Rank by Increase"
    FROM (SELECT neighborhood AS "Neighborhood", count(*) AS "Total Listings",
            count({DIFFERENCE}) AS "Listings with Both Dates",
            {rounded(ratio(f'count({DIFFERENCE}) * 100', 'count(*)'), 1)}
                AS "Data Completeness (%)",
            coalesce(string_agg(CASE WHEN {BOTH} THEN CAST(listing_id AS VARCHAR) END, ', '
                ORDER BY listing_id), '') AS "Listing IDs",
            {rounded(MEAN_BEFORE, 2)} AS "Avg Price (July 2021)",
            {rounded(MEAN_AFTER, 2)} AS "Avg Price (July 2022)",
            {rounded(MEAN_CHANGE, 2)} AS "Avg Price Increase ($)",
            {rounded(ratio(MEAN_CHANGE, MEAN_BEFORE) + ' * 100', 2)}
                AS "Avg Price Increase (%)",
            {rounded(f'min({DIFFERENCE})', 2)} AS "Min Price Change ($)",
            {rounded(f'max({DIFFERENCE})', 2)} AS "Max Price Change ($)",
            {rounded(deviation(f'(({DIFFERENCE}) * 100000000)') + ' / 100000000', 2)}
                AS "StdDev Price Change",
            coalesce(string_agg(CASE WHEN price_before IS NOT NULL AND price_after IS NULL
                THEN CAST(listing_id AS VARCHAR) END, ', ' ORDER BY listing_id), '')
                AS "Listings Missing 2022 Data"
        FROM ({price_pairs(fact)})
        GROUP BY neighborhood HAVING count({DIFFERENCE}) > 0)"""


STATEMENTS["neighborhood_pricing"] = neighborhood_pricing("fact")
STATEMENTS["neighborhood_pricing_nightly"] = neighborhood_pricing("nightly_fact")
STATEMENTS["listing_price_changes"] = f"""
    SELECT {columns('listing_id neighborhood price_before price_after')},
        CAST({DIFFERENCE} AS DOUBLE) AS difference
    FROM ({price_pairs('nightly_fact')})"""


def stays(where: str) -> str:
    """Longest stay per listing; the earliest span wins a tie."""
    return f"""(SELECT listing_id, listing_name, neighborhood,
            max(effective_max_stay_nights) AS max_possible_stay_nights,
            first(span_start_date ORDER BY effective_max_stay_nights DESC, span_start_date,
                span_end_date) AS best_span_start,
            first(span_end_date ORDER BY effective_max_stay_nights DESC, span_start_date,
                span_end_date) AS best_span_end,
            count(*) AS total_availability_spans,
            {rounded(ratio('sum(effective_max_stay_nights)', 'count(*)'), 1)}
                AS avg_span_duration
        FROM spans WHERE {where} GROUP BY listing_id, listing_name, neighborhood)"""


STATEMENTS["max_stay"] = f"""
    SELECT {columns('listing_id listing_name neighborhood', 's')},
        {columns('''property_type room_type accommodates capacity_tier price_tier rating_tier
        base_price review_scores_rating''', 'l')},
        {columns('max_possible_stay_nights best_span_start best_span_end', 's')},
        season AS best_span_season, is_peak_season AS best_span_in_peak_season,
        {columns('total_availability_spans avg_span_duration', 's')},
        dense_rank() OVER (ORDER BY max_possible_stay_nights DESC) AS overall_stay_rank,
        dense_rank() OVER (PARTITION BY l.neighborhood ORDER BY max_possible_stay_nights DESC)
            AS neighborhood_stay_rank,
        CASE WHEN dense_rank() OVER (ORDER BY max_possible_stay_nights DESC) = 1
            THEN 'Tied for Longest' END AS longest_stay_flag
    FROM {stays('true')} s
    LEFT JOIN dim_listings l ON s.listing_id = l.listing_id AND l.is_current
    LEFT JOIN dim_date d ON best_span_start = date_day"""
REQUIRED = "list_contains(amenities, 'Lockbox') AND list_contains(amenities, 'First aid kit')"
STATEMENTS["max_stay_lockbox_firstaid"] = f"""
    SELECT {columns('listing_id listing_name neighborhood', 's')},
        {columns('''property_type room_type accommodates capacity_tier price_tier base_price
        review_scores_rating''', 'l')},
        true AS has_lockbox, true AS has_first_aid_kit,
        {columns('max_possible_stay_nights best_span_start best_span_end', 's')},
        season AS best_span_season, month_name AS best_span_month,
        {columns('total_availability_spans avg_span_duration', 's')},
        dense_rank() OVER (ORDER BY max_possible_stay_nights DESC) AS stay_rank,
        CAST(longest AS BIGINT) AS global_max_stay,
        CAST(max_possible_stay_nights - longest AS BIGINT) AS days_shorter_than_max,
        'Max stay with Lockbox+First Aid Kit is ' || max_possible_stay_nights
            || ' nights, which is ' || abs(max_possible_stay_nights - longest)
            || ' nights shorter than the overall maximum of ' || longest || ' nights'
            AS insight_summary,
        'Lockbox' AS lockbox_column_used, 'First aid kit' AS first_aid_kit_column_used
    FROM {stays(REQUIRED)} s
    CROSS JOIN (SELECT max(effective_max_stay_nights) AS longest FROM spans)
    LEFT JOIN dim_listings l ON s.listing_id = l.listing_id AND l.is_current
    LEFT JOIN dim_date d ON best_span_start = date_day"""
LATE = f"""(SELECT count(*) AS late_count FROM raw_calendar
    WHERE date < (SELECT max(calendar_date) FROM nightly_fact) - INTERVAL 7 DAY
        AND _loaded_at >= {NOW} - INTERVAL 48 HOUR)"""
STATEMENTS["late_arrivals"] = f"SELECT CAST(late_count AS BIGINT) AS late_count FROM {LATE}"
NEW_NAMES = """SELECT DISTINCT amenity_name FROM change_names WHERE amenity_name NOT IN (
    SELECT amenity_name FROM early_names)"""
STATEMENTS["schema_drift"] = f"""
    SELECT amenity_name, 'added' AS change FROM ({NEW_NAMES})
    UNION ALL SELECT 'Sauna', 'removed'"""
STATEMENTS["refresh_decision"] = f"""
    SELECT new_amenities > 0 AS schema_changed, late_count > 0 AS late_arrivals, new_amenities,
        late_count, CASE WHEN new_amenities > 0 OR late_count > 0 THEN 'full_refresh'
            ELSE 'incremental' END AS strategy
    FROM (SELECT count(*) AS new_amenities FROM ({NEW_NAMES})), {LATE}"""
SOURCES = {
    "listings": ("raw_listings", 168, 336),
    "calendar": ("raw_calendar", 24, 48),
    "generated_reviews": ("raw_reviews", 168, 336),
    "amenities_changelog": ("raw_changelog", 168, 336),
}
STATEMENTS["source_freshness"] = f"""
    SELECT source, strftime(loaded, '%Y-%m-%d %H:%M:%S') AS max_loaded_at,
        CAST(warn AS BIGINT) AS warn_after_hours, CAST(error AS BIGINT) AS error_after_hours,
        age AS age_hours, CASE WHEN age IS NULL OR age > error THEN 'error'
            WHEN age > warn THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT *, CAST(epoch_us({NOW}) - epoch_us(loaded) AS DOUBLE) / 3600000000 AS age
        FROM (""" + " UNION ALL ".join(
    f"SELECT '{name}' AS source, max(_loaded_at) AS loaded, {warn} AS warn, {error} AS error "
    f"FROM {table}"
    for name, (table, warn, error) in SOURCES.items()
) + "))"

CHECKED = {
    "raw.listings": "raw_listings",
    "raw.calendar": "raw_calendar",
    "raw.generated_reviews": "raw_reviews",
    "raw.amenities_changelog": "raw_changelog",
    "stg_listings": "listings",
    "stg_calendar": "calendar",
    "stg_reviews": "reviews",
    "stg_amenities_changelog": "changelog",
    "int_listing_amenities_scd": "scd",
    "int_calendar_enriched": "enriched",
    "int_availability_spans": "spans",
    "int_hosts_history": "hosts_history",
    "int_listings_history": "listings_history",
    "dim_date": "dim_date",
    "dim_hosts": "dim_hosts",
    "dim_listings": "dim_listings",
    "fct_daily_listing_performance": "fact",
    "fct_monthly_listing_performance": "listing_months",
    "fct_monthly_neighborhood_summary": "neighborhood_months",
}


# Table, then its checks as column:test[:values][!] with ! for a mere warning.
CHECK_LIST = """
raw.listings | id:unique id:not_null host_id:not_null
raw.calendar | listing_id:not_null date:not_null available:not_null
raw.generated_reviews | id:unique id:not_null!
raw.amenities_changelog | listing_id:not_null change_at:not_null amenities:not_null
stg_listings | listing_id:unique listing_id:not_null
stg_calendar | listing_id:not_null calendar_date:not_null
stg_reviews | review_id:unique review_id:not_null! listing_id:not_null
stg_amenities_changelog | listing_id:not_null change_at:not_null
int_listing_amenities_scd | listing_id:not_null valid_from:not_null valid_to:not_null
int_calendar_enriched | listing_id:not_null calendar_date:not_null
int_availability_spans | listing_id:not_null span_start_date:not_null span_end_date:not_null
int_hosts_history | host_id:unique host_id:not_null valid_from:not_null valid_to:not_null
int_listings_history | listing_id:not_null valid_from:not_null valid_to:not_null
dim_date | date_day:unique date_key:unique date_day:not_null date_key:not_null
dim_date | is_weekend:not_null season:in:Winter,Spring,Summer,Fall
dim_hosts | host_sk:unique host_sk:not_null host_id:not_null is_current:not_null
dim_hosts | host_experience_tier:in:New_Host,Established_Host,Veteran_Host
dim_listings | listing_sk:unique listing_sk:not_null listing_id:not_null is_current:not_null
dim_listings | capacity_tier:in:Small_(1-2),Medium_(3-4),Large_(5-6),Extra_Large_(7+)
dim_listings | price_tier:in:Budget,Economy,Mid-Range,Premium,Luxury
dim_listings | rating_tier:in:Exceptional,Excellent,Good,Average,Below_Average!
fct_daily_listing_performance | listing_id:not_null calendar_date:not_null date_key:not_null
fct_daily_listing_performance | is_occupied:in:0,1 available_flag:in:0,1 is_blocked:in:0,1
fct_monthly_listing_performance | listing_id:not_null calendar_month:not_null
fct_monthly_neighborhood_summary | neighborhood:not_null calendar_month:not_null
"""


def check_sql(table: str, check: str) -> str:
    severity = "warn" if check.endswith("!") else "error"
    column, test, *values = check.rstrip("!").split(":")
    source = CHECKED[table]
    if test == "not_null":
        failing = f"SELECT count(*) FROM {source} WHERE {column} IS NULL"
    elif test == "unique":
        failing = f"""SELECT count(*) FROM (SELECT {column} FROM {source}
            WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"""
    else:
        test = "accepted_values"
        listed = ", ".join(f"'{v.replace('_', ' ')}'" for v in values[0].split(","))
        failing = f"""SELECT count(*) FROM {source}
            WHERE CAST({column} AS VARCHAR) NOT IN ({listed})"""
    return (
        f"SELECT '{table}' AS tbl, '{column}' AS col, '{test}' AS test, "
        f"({failing}) AS failures, '{severity}' AS severity"
    )


STATEMENTS["dq_results"] = """
    SELECT tbl AS "table", col AS "column", test, CAST(failures AS BIGINT) AS failures, severity,
        CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END
            AS status
    FROM (""" + " UNION ALL ".join(
    check_sql(table.strip(), check)
    for table, checks in (line.split(" | ") for line in CHECK_LIST.strip().splitlines())
    for check in checks.split()
) + ")"
STATEMENTS["gate_verdicts"] = f"""
    SELECT gate, CASE WHEN bool_or(status IN ('error', 'fail')) THEN 'failed'
                      WHEN bool_or(status = 'warn') THEN 'warning' ELSE 'passed' END AS verdict,
        CAST(count(*) FILTER (status <> 'pass') AS BIGINT) AS findings
    FROM (SELECT 'freshness' AS gate, status FROM ({STATEMENTS["source_freshness"]})
          UNION ALL SELECT 'checks', status FROM ({STATEMENTS["dq_results"]})
          UNION ALL SELECT 'source_checks', status FROM ({STATEMENTS["dq_results"]})
              WHERE "table" LIKE 'raw.%')
    GROUP BY gate"""
STATEMENTS["catalog_views"] = f"""
    SELECT n.listing_id, listing_name, calendar_month, count(*) AS nights, sum(daily_revenue) AS revenue,
        CAST(count(*) FILTER ("Wifi") AS BIGINT) AS wifi_nights, longest_stay
    FROM ({STATEMENTS["calendar_enriched"]}) n
    LEFT JOIN (SELECT listing_id, max(effective_max_stay_nights) AS longest_stay
               FROM ({STATEMENTS["availability_spans"]}) GROUP BY 1) USING (listing_id)
    GROUP BY ALL"""
STATEMENTS["surrogate_keys"] = """
    SELECT listing_id, CAST(calendar_date AS VARCHAR) AS calendar_date,
        md5(listing_id || '|' || CAST(calendar_date AS VARCHAR)) AS night_sk,
        md5(listing_id || '|' || coalesce(CAST(reservation_id AS VARCHAR), ''))
            AS reservation_sk
    FROM calendar"""

STATEMENTS["kept_vocabulary"] = STATEMENTS["amenity_vocabulary"]

ORACLES = {name: statement(sql) for name, sql in STATEMENTS.items()}
