"""

Every query derives the four lodging sources from the given tables, see
``roostline/sources/derived.py``, and runs an operator of the library over all of them.
"""

from __future__ import annotations

import datetime
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The packages lie beside this file, wherever it is loaded from.
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracles import ORACLES
from roostline.functions import surrogate_key, vocabulary_frame, widen
from roostline.functions.amenities import quoted
from roostline.plans import analyses, dimensions, facts, intermediate
from roostline.plans.pipeline import DAILY, LISTING_MONTHS, NEIGHBORHOOD_MONTHS, Lineage, load_daily
from roostline.plans.views import create_views, register_sources
from roostline.plans.vocabulary import refresh_vocabulary
from roostline.quality import refresh_decision, run_checks, schema_drift, source_freshness, verdict
from roostline.session import scratch_dir, staged, staged_dealt, tune
from roostline.sinks import NAMESPACES, Warehouse
from roostline.sinks.tables import AUDIT_COLUMN
from roostline.sources.derived import AS_OF, derived_sources
from roostline.streaming import check_late_arrivals

# The operators for training data are an optional part: without their package and
# corpus_pipeline.py, the queries of the library itself remain.
try:
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
    from corpus_pipeline import run as run_corpus_pipeline
    from roostline.llm.queries import QUERIES as LLM_QUERIES
    from roostline.llm.queries import SQL as LLM_SQL
except ImportError:
    # The package, or a library that only it needs, is not there.
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": run_corpus_pipeline}
    if PIPELINE_SQL:
        LLM_SQL = {**LLM_SQL, "pipeline": PIPELINE_SQL}

Query = Callable[[SparkSession, str], DataFrame]
TODAY = datetime.date.fromisoformat(AS_OF[:10])
# The first load of the incremental scenarios ends this long before the calendar does.
FIRST_LOAD_GAP = datetime.timedelta(days=7)
# The amenity that is not tracked yet in the first load of the schema scenarios.
LATER_AMENITY = "Wifi"


def plain(df: DataFrame) -> DataFrame:
    """Types both engines share: decimals as double, integers as long, dates as text."""

    def shared(field: T.StructField) -> F.Column:
        column = quoted(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("long")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column.alias(field.name)

    return df.select(*[shared(f) for f in df.schema.fields if f.name != AUDIT_COLUMN])


def _lineage(spark: SparkSession, sf_dir: str) -> Lineage:
    """The lineage of the derived sources. Their calendar has a night of a listing once, so spans
    need no count of copies; were there copies, the plain row number would still place them."""
    return Lineage(derived_sources(tune(spark), sf_dir), unique_days=True)


def _named_lineage(spark: SparkSession, sf_dir: str) -> Lineage:
    """The lineage with the amenity log written once: for queries that look names up in it before
    they can be planned, and read it again after that."""
    run = _lineage(spark, sf_dir)
    log, _ = staged(run.sources.amenities_changelog, "amenities_changelog")
    return Lineage(run.sources.replacing(amenities_changelog=log), unique_days=True)


def _stored_lineage(spark: SparkSession, sf_dir: str) -> Lineage:
    """The lineage of sources that are written once, as a daily run finds them: for queries that
    read them in many places, each of which would derive them again, in its plan and its tasks."""
    run = _lineage(spark, sf_dir)
    tables = {name: staged(df, name)[0] for name, df in run.sources.items() if name != "calendar"}
    # Nights are dealt once, while they are derived, and meet everything else where they lie.
    tables["calendar"], _ = staged_dealt(run.sources.calendar, "calendar", "calendar_month", "listing_id")
    return replace(run, sources=run.sources.replacing(**tables), dated=True)


def stg_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _lineage(spark, sf_dir)
    return widen(run.listings, run.listing_amenity_names())


def stg_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage(spark, sf_dir).calendar


def stg_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage(spark, sf_dir).reviews


def stg_amenities_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _named_lineage(spark, sf_dir)
    return widen(run.changelog, run.amenity_names())


def amenity_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary_frame(_lineage(spark, sf_dir).events())


def kept_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of the log after three loads into a kept table, each reading new events only."""
    log = _lineage(spark, sf_dir).sources.amenities_changelog
    # The derived log carries one load time; here an event is loaded when it happens.
    dated = log.withColumn("_loaded_at", F.col("change_at"))
    first, last = dated.agg(F.min("change_at"), F.max("change_at")).first()
    warehouse = Warehouse(spark, scratch_dir(spark, "vocabulary"))
    for part in (1, 2, 3):
        seen = dated.filter(F.col("change_at") <= F.lit(first + (last - first) * part / 3))
        refresh_vocabulary(warehouse, seen, AS_OF)
    return warehouse.read("intermediate", "amenity_vocabulary").select("amenity_name")


def listing_amenity_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary_frame(_lineage(spark, sf_dir).listings)


def listing_amenities_scd(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _named_lineage(spark, sf_dir)
    return widen(run.scd, run.amenity_names())


def availability_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _lineage(spark, sf_dir)
    return widen(run.spans(), run.listing_amenity_names())


def calendar_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _named_lineage(spark, sf_dir)
    return intermediate.calendar_enriched(
        run.calendar, run.listings, run.scd, run.amenity_names()
    )


def hosts_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.hosts_history(_lineage(spark, sf_dir).listings)


def listings_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage(spark, sf_dir).listings_history()


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension with the calendar nights on each day, 0 where there are none."""
    nights = _lineage(spark, sf_dir).calendar.groupBy("calendar_date").agg(
        F.count(F.lit(1)).alias("nights")
    )
    days = dimensions.dim_date(spark, TODAY)
    return (
        days.join(nights, days["date_day"] == nights["calendar_date"], "left")
        .drop("calendar_date")
        .withColumn("nights", F.coalesce("nights", F.lit(0)))
    )


def dim_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_hosts(hosts_history(spark, sf_dir), TODAY)


def dim_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _named_lineage(spark, sf_dir)
    return widen(run.dim_listings(), run.amenity_names())


def fct_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _named_lineage(spark, sf_dir)
    return run.fct_daily("fanout", run.amenity_names())


def fct_daily_nightly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as the daily run publishes it: one row per listing and night."""
    run = _named_lineage(spark, sf_dir)
    return run.fct_daily("aggregate", run.amenity_names())


def fct_monthly_listing_nightly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fct_monthly_listing(_lineage(spark, sf_dir).fct_daily("aggregate"))


def fct_monthly_neighborhood_nightly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fct_monthly_neighborhood(_lineage(spark, sf_dir).fct_daily("aggregate"))


def amenity_revenue_nightly(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _named_lineage(spark, sf_dir)
    known = run.known_names(*analyses.AIR_CONDITIONING)
    return analyses.amenity_revenue(
        run.fct_daily("aggregate"), dimensions.dim_date(spark, TODAY), known
    )


def _priced(spark: SparkSession, sf_dir: str, reviews: str) -> dict[str, DataFrame]:
    """What the price analysis needs of the fact: the nights of its two weeks, and every listing
    that has a night on any date."""
    run = _lineage(spark, sf_dir)
    return {
        "fact": run.nights_within(analyses.anchor_weeks(), reviews),
        "located": run.located(),
    }


def neighborhood_pricing_nightly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.neighborhood_pricing(**_priced(spark, sf_dir, "aggregate"))


def listing_price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.listing_price_changes(**_priced(spark, sf_dir, "aggregate"))


def fct_monthly_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fct_monthly_listing(_lineage(spark, sf_dir).fct_daily("fanout"))


def fct_monthly_neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fct_monthly_neighborhood(_lineage(spark, sf_dir).fct_daily("fanout"))


def amenity_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _named_lineage(spark, sf_dir)
    known = run.known_names(*analyses.AIR_CONDITIONING)
    return analyses.amenity_revenue(
        run.fct_daily("fanout"), dimensions.dim_date(spark, TODAY), known
    )


def neighborhood_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.neighborhood_pricing(**_priced(spark, sf_dir, "fanout"))


def max_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _lineage(spark, sf_dir)
    return analyses.max_stay(run.spans(), run.dim_listings(), dimensions.dim_date(spark, TODAY))


def max_stay_lockbox_firstaid(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _lineage(spark, sf_dir)
    return analyses.max_stay_with_amenities(
        run.spans(),
        run.dim_listings(),
        dimensions.dim_date(spark, TODAY),
        run.known_listing_names(*analyses.LOCKBOX, *analyses.FIRST_AID_KIT),
    )


def _first_load(run: Lineage) -> Lineage:
    """What the sources showed on the first load: no later nights, no booking of the last
    week yet, and the later amenity not tracked."""
    end = run.sources.calendar.agg(F.max("date")).first()[0] - FIRST_LOAD_GAP
    known = F.col("date") < F.lit(end - datetime.timedelta(days=6))
    calendar = run.sources.calendar.filter(F.col("date") <= F.lit(end)).withColumn(
        "reservation_id", F.when(known, F.col("reservation_id"))
    )
    return replace(run, sources=run.sources.replacing(calendar=calendar))


def _without_amenity(run: Lineage, name: str) -> Lineage:
    names = F.from_json("amenities", "array<string>")
    changelog = run.sources.amenities_changelog.withColumn(
        "amenities", F.to_json(F.array_remove(names, name))
    )
    return replace(run, sources=run.sources.replacing(amenities_changelog=changelog))


def fct_daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load, then an upsert of the reprocess window: equals the full load."""
    run = _stored_lineage(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_dir(spark, "incremental"))
    load_daily(spark, _first_load(run), warehouse, AS_OF, "full_refresh")
    return load_daily(spark, run, warehouse, AS_OF, "incremental")


def fct_daily_schema_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An amenity that appears after the first load: NULL in rows that load left alone."""
    run = _stored_lineage(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_dir(spark, "growth"))
    first = _without_amenity(_first_load(run), LATER_AMENITY)
    load_daily(spark, first, warehouse, AS_OF, "full_refresh")
    return load_daily(spark, run, warehouse, AS_OF, "incremental")


def daily_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nights of a published fact by the time of the load that wrote them."""
    run = _stored_lineage(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_dir(spark, "audit"))
    load_daily(spark, _first_load(run), warehouse, "2022-07-01 06:00:00", "full_refresh")
    loaded = load_daily(spark, run, warehouse, AS_OF, "incremental")
    return loaded.groupBy(F.col(AUDIT_COLUMN).alias("loaded_at")).agg(
        F.count(F.lit(1)).alias("nights"),
        F.min("calendar_date").alias("first_date"),
        F.max("calendar_date").alias("last_date"),
    )


def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _lineage(spark, sf_dir)
    return check_late_arrivals(run.sources.calendar, run.fct_daily("aggregate"), AS_OF)


def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _lineage(spark, sf_dir)
    # The published fact lacks one name and has another that nothing has any more.
    published = [*_without_amenity(run, LATER_AMENITY).amenity_names(), "Sauna"]
    return schema_drift(
        vocabulary_frame(run.events()), [*facts.FACT_COLUMNS, *published], facts.FACT_COLUMNS
    )


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_freshness(_lineage(spark, sf_dir).sources.items(), AS_OF)


def decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh_decision(drift(spark, sf_dir), late_arrivals(spark, sf_dir))


def catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched calendar and the spans of a fresh session, read through catalog views."""
    derived = _lineage(spark, sf_dir).sources
    root = scratch_dir(spark, "sources")
    for name, df in derived.items():
        df.write.parquet(f"{root}/{name}")
    # Names come from what is written, not from a second derivation.
    run = Lineage(
        derived.replacing(
            **{name: spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, df in derived.items()}
        )
    )
    mark = uuid.uuid4().hex[:8]
    routes = {layer: f"{name}_{mark}" for layer, name in NAMESPACES.items()}
    register_sources(spark, root, f"raw_{mark}")
    create_views(spark, f"raw_{mark}", run.amenity_names(), run.listing_amenity_names(), routes)
    fresh = tune(spark.newSession())
    nights = fresh.table(f"{routes['intermediate']}.int_calendar_enriched")
    spans = fresh.table(f"{routes['intermediate']}.int_availability_spans")
    longest = spans.groupBy("listing_id").agg(F.max("effective_max_stay_nights").alias("longest_stay"))
    return (
        nights.groupBy("listing_id", "listing_name", "calendar_month")
        .agg(
            F.count(F.lit(1)).alias("nights"),
            F.sum("daily_revenue").alias("revenue"),
            F.count_if("Wifi").alias("wifi_nights"),
        )
        .join(longest, "listing_id", "left")
    )


def gate_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gates say: to the age of the sources, to the checks of the sources, to all checks."""
    run = _stored_lineage(spark, sf_dir)
    # Two gates look at the results, which are few rows of much work.
    checks, _ = staged(_checked(spark, run), "checks")
    return (
        verdict(source_freshness(run.sources.items(), AS_OF), "freshness", "error")
        .unionByName(verdict(checks.filter(F.col("table").startswith("raw.")), "source_checks", "fail"))
        .unionByName(verdict(checks, "checks", "fail"))
    )


def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, _stored_lineage(spark, sf_dir))


def _checked(spark: SparkSession, run: Lineage) -> DataFrame:
    """The checks of all tables of a lineage."""
    hosts = intermediate.hosts_history(run.listings)
    daily = run.fct_daily("fanout")
    tables = {
        **{f"raw.{name}": df for name, df in run.sources.items()},
        "stg_listings": run.listings,
        "stg_calendar": run.calendar,
        "stg_reviews": run.reviews,
        "stg_amenities_changelog": run.changelog,
        "int_listing_amenities_scd": run.scd,
        "int_calendar_enriched": intermediate.calendar_enriched(
            run.calendar, run.listings, run.scd, dated=run.dated
        ),
        "int_availability_spans": run.spans(),
        "int_hosts_history": hosts,
        "int_listings_history": run.listings_history(),
        "dim_date": dimensions.dim_date(spark, TODAY),
        "dim_hosts": dimensions.dim_hosts(hosts, TODAY),
        "dim_listings": run.dim_listings(),
        DAILY: daily,
        LISTING_MONTHS: facts.fct_monthly_listing(daily),
        NEIGHBORHOOD_MONTHS: facts.fct_monthly_neighborhood(daily),
    }
    return run_checks(tables)


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = _lineage(spark, sf_dir).calendar
    return calendar.select(
        "listing_id",
        "calendar_date",
        surrogate_key("listing_id", "calendar_date").alias("night_sk"),
        surrogate_key("listing_id", "reservation_id").alias("reservation_sk"),
    )


QUERIES: dict[str, Query] = {
    "stg_listings": stg_listings,
    "stg_calendar": stg_calendar,
    "stg_reviews": stg_reviews,
    "stg_amenities_changelog": stg_amenities_changelog,
    "amenity_vocabulary": amenity_vocabulary,
    "kept_vocabulary": kept_vocabulary,
    "listing_amenity_vocabulary": listing_amenity_vocabulary,
    "listing_amenities_scd": listing_amenities_scd,
    "availability_spans": availability_spans,
    "calendar_enriched": calendar_enriched,
    "hosts_history": hosts_history,
    "listings_history": listings_history,
    "dim_date": dim_date,
    "dim_hosts": dim_hosts,
    "dim_listings": dim_listings,
    "fct_daily": fct_daily,
    "fct_daily_nightly": fct_daily_nightly,
    "fct_monthly_listing_nightly": fct_monthly_listing_nightly,
    "fct_monthly_neighborhood_nightly": fct_monthly_neighborhood_nightly,
    "amenity_revenue_nightly": amenity_revenue_nightly,
    "neighborhood_pricing_nightly": neighborhood_pricing_nightly,
    "listing_price_changes": listing_price_changes,
    "daily_audit": daily_audit,
    "fct_daily_incremental": fct_daily_incremental,
    "fct_daily_schema_growth": fct_daily_schema_growth,
    "fct_monthly_listing": fct_monthly_listing,
    "fct_monthly_neighborhood": fct_monthly_neighborhood,
    "amenity_revenue": amenity_revenue,
    "neighborhood_pricing": neighborhood_pricing,
    "max_stay": max_stay,
    "max_stay_lockbox_firstaid": max_stay_lockbox_firstaid,
    "late_arrivals": late_arrivals,
    "schema_drift": drift,
    "source_freshness": freshness,
    "refresh_decision": decision,
    "dq_results": dq_results,
    "gate_verdicts": gate_verdicts,
    "catalog_views": catalog_views,
    "surrogate_keys": surrogate_keys,
}


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(spark, sf_dir))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Revenue by month with and without air conditioning."""
    return plain(amenity_revenue(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    return {**{name: _registered(query) for name, query in QUERIES.items()}, **LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the same tables."""
    return {**ORACLES, **LLM_SQL}
