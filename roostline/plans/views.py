"""Staging and intermediate tables as stored SQL: catalog views in the namespaces of their layers.

A catalog view outlives the session that creates it and computes when it is read. Its text names
catalog tables only: the raw tables, registered once as external tables, and views before it. The
same relations as DataFrames are in ``staging.py`` and ``intermediate.py``; a registered query and
the tests hold both against each other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from roostline.functions import OPEN_END
from roostline.plans.intermediate import (
    ENRICHED_ATTRIBUTES,
    HOST_EPOCH,
    LISTING_EPOCH,
    SPAN_ATTRIBUTES,
)
from roostline.plans.staging import AVAILABLE_TEXTS, NUMBER_PATTERN
from roostline.sinks.tables import NAMESPACES
from roostline.sources.raw import SCHEMAS


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _parsed(column: str) -> str:
    """The amenity set of a JSON text; malformed text stops the query."""
    listed = f"nullif(from_json({column}, 'array<string>', map('mode', 'FAILFAST')), CAST(array() AS ARRAY<STRING>))"
    return f"sort_array(array_distinct(filter(transform({listed}, x -> trim(x)), x -> x IS NOT NULL)))"


def _flags(names: Sequence[str], column: str = "amenities") -> str:
    """One boolean per name, or the array itself without names."""
    if not names:
        return f"{column} AS amenities"
    return ", ".join(f"array_contains({column}, {_text(n)}) AS {_name(n)}" for n in names)


def view_texts(
    raw: str, staging: str, intermediate: str, changelog_names: Sequence[str] = (), listing_names: Sequence[str] = ()
) -> dict[str, str]:
    """The SQL of every view by its qualified name, in an order in which each finds those it
    reads. The sets behind the booleans are views of their own, named ``..._sets``."""
    listing_sets, change_sets = f"{staging}.stg_listings_sets", f"{staging}.stg_amenities_changelog_sets"
    scd_sets, calendar = f"{intermediate}.int_listing_amenities_scd_sets", f"{staging}.stg_calendar"
    listing_columns = """listing_id, listing_name, neighborhood, property_type, room_type, accommodates, bedrooms,
        beds, bathrooms, bathrooms_raw, host_id, host_name, host_location, host_since_date, host_verifications,
        base_price, number_of_reviews, first_review_date, last_review_date, review_scores_rating, amenities_raw"""
    available = ", ".join(map(_text, AVAILABLE_TEXTS))
    enriched = ", ".join(f"l.{a}" for a in ENRICHED_ATTRIBUTES)
    spanned = ", ".join(f"l.{a}" for a in SPAN_ATTRIBUTES)
    return {
        listing_sets: f"""
            SELECT id AS listing_id, name AS listing_name, neighborhood, property_type, room_type, accommodates,
                bedrooms, beds,
                TRY_CAST(regexp_substr(bathrooms_text, {_text(NUMBER_PATTERN)}) AS DECIMAL(10,1)) AS bathrooms,
                bathrooms_text AS bathrooms_raw, host_id, host_name, host_location,
                TRY_CAST(CAST(host_since AS STRING) AS DATE) AS host_since_date, host_verifications,
                TRY_CAST(regexp_replace(price, '[$,]', '') AS DECIMAL(10,2)) AS base_price, number_of_reviews,
                TRY_CAST(first_review AS DATE) AS first_review_date,
                TRY_CAST(last_review AS DATE) AS last_review_date, review_scores_rating,
                amenities AS amenities_raw, {_parsed("amenities")} AS amenities
            FROM {raw}.listings""",
        f"{staging}.stg_listings": f"SELECT {listing_columns}, {_flags(listing_names)} FROM {listing_sets}",
        calendar: f"""
            SELECT listing_id, date AS calendar_date,
                coalesce(available IN ({available}) OR lower(available) IN ({available}), FALSE) AS is_available,
                reservation_id, reservation_id IS NOT NULL AS is_reserved, price AS daily_price,
                minimum_nights, maximum_nights, trunc(date, 'month') AS calendar_month,
                trunc(date, 'year') AS calendar_year, dayofweek(date) - 1 AS day_of_week,
                coalesce(dayofweek(date) IN (1, 7), FALSE) AS is_weekend
            FROM {raw}.calendar""",
        f"{staging}.stg_reviews": f"""
            SELECT id AS review_id, listing_id, CAST(review_date AS DATE) AS review_date, review_score
            FROM {raw}.generated_reviews""",
        change_sets: f"""
            SELECT listing_id, change_at, amenities FROM (
                SELECT listing_id, change_at, sort_array(collect_set(name)) AS amenities, bool_or(listed) AS listed
                FROM (SELECT listing_id, change_at, amenities IS NOT NULL AS listed, explode_outer(amenities) AS name
                      FROM (SELECT listing_id, CAST(change_at AS DATE) AS change_at, {_parsed("amenities")} AS amenities
                            FROM {raw}.amenities_changelog))
                GROUP BY listing_id, change_at)
            WHERE listed""",
        f"{staging}.stg_amenities_changelog": f"""
            SELECT listing_id, change_at, {_flags(changelog_names)} FROM {change_sets}""",
        scd_sets: f"""
            SELECT listing_id, change_at AS valid_from,
                coalesce(date_sub(lead(change_at) OVER (PARTITION BY listing_id ORDER BY change_at NULLS LAST), 1),
                         DATE'{OPEN_END}') AS valid_to,
                amenities
            FROM {change_sets}""",
        f"{intermediate}.int_listing_amenities_scd": f"""
            SELECT listing_id, valid_from, valid_to, {_flags(changelog_names)} FROM {scd_sets}""",
        f"{intermediate}.int_availability_spans": f"""
            WITH placed AS (
                SELECT listing_id, calendar_date, minimum_nights, maximum_nights,
                    date_sub(calendar_date, CAST(row_number() OVER (
                        PARTITION BY listing_id ORDER BY calendar_date, minimum_nights, maximum_nights) AS INT)) AS run
                FROM {calendar} WHERE is_available),
            spans AS (
                SELECT listing_id, min(calendar_date) AS span_start_date, max(calendar_date) AS span_end_date,
                    count(*) AS consecutive_available_days, max(minimum_nights) AS min_nights_required,
                    min(nullif(maximum_nights, 0)) AS max_nights_allowed
                FROM placed GROUP BY listing_id, run),
            judged AS (
                SELECT *, coalesce(consecutive_available_days >= min_nights_required, TRUE) AS is_bookable FROM spans)
            SELECT s.listing_id, span_start_date, span_end_date, consecutive_available_days, min_nights_required,
                max_nights_allowed,
                CASE WHEN NOT is_bookable THEN 0
                     WHEN max_nights_allowed > 0 THEN least(consecutive_available_days, max_nights_allowed)
                     ELSE consecutive_available_days END AS effective_max_stay_nights,
                is_bookable, {spanned}, {_flags(listing_names, "l.amenities")}
            FROM judged s JOIN {listing_sets} l ON s.listing_id = l.listing_id""",
        f"{intermediate}.int_calendar_enriched": f"""
            WITH covered AS (
                SELECT c.*, {enriched}, coalesce(h.amenities, l.amenities) AS amenities
                FROM {calendar} c JOIN {listing_sets} l ON c.listing_id = l.listing_id
                LEFT JOIN {scd_sets} h ON c.listing_id = h.listing_id
                    AND c.calendar_date BETWEEN h.valid_from AND h.valid_to)
            SELECT * EXCEPT (amenities), {_flags(changelog_names)},
                CASE WHEN is_reserved THEN daily_price ELSE 0 END AS daily_revenue,
                CAST(is_reserved AS INT) AS is_occupied
            FROM covered""",
        f"{intermediate}.int_hosts_history": f"""
            SELECT host_id, latest.host_name, latest.host_location, latest.host_since_date,
                latest.record_observed_date,
                coalesce(latest.host_since_date, DATE'{HOST_EPOCH}') AS valid_from,
                DATE'{OPEN_END}' AS valid_to, TRUE AS is_current
            FROM (SELECT host_id, max(struct(first_review_date AS record_observed_date, host_name, host_location,
                                             host_since_date)) AS latest
                  FROM {listing_sets} WHERE host_id IS NOT NULL GROUP BY host_id)""",
        f"{intermediate}.int_listings_history": f"""
            WITH timeline AS (
                SELECT l.listing_id, listing_name, neighborhood, property_type, room_type, accommodates, beds, host_id,
                    base_price, number_of_reviews, review_scores_rating,
                    coalesce(h.valid_from, first_review_date, DATE'{LISTING_EPOCH}') AS valid_from
                FROM {listing_sets} l
                LEFT JOIN (SELECT DISTINCT listing_id, valid_from FROM {scd_sets}) h ON l.listing_id = h.listing_id)
            SELECT *, coalesce(date_sub(lead(valid_from) OVER w, 1), DATE'{OPEN_END}') AS valid_to,
                lead(valid_from) OVER w IS NULL AS is_current
            FROM timeline WINDOW w AS (PARTITION BY listing_id ORDER BY valid_from)""",
    }


def register_sources(spark: SparkSession, root: str, database: str) -> None:
    """The raw tables below a folder as external catalog tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in SCHEMAS.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} ({schema}) USING parquet LOCATION '{root.rstrip('/')}/{name}'")


def create_views(
    spark: SparkSession,
    raw: str,
    changelog_names: Sequence[str] = (),
    listing_names: Sequence[str] = (),
    routes: Mapping[str, str] = NAMESPACES,
) -> list[str]:
    """Create or replace all views in the namespaces of their layers; each is one catalog change."""
    staging, intermediate = routes["staging"], routes["intermediate"]
    for database in (staging, intermediate):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    texts = view_texts(raw, staging, intermediate, changelog_names, listing_names)
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
    return list(texts)
