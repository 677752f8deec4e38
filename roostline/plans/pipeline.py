"""The whole daily run: gates, staging, history, marts, analyses and checks."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.functions import known_names, vocabulary, vocabulary_frame, widen
from roostline.plans import analyses, dimensions, facts, intermediate, staging
from roostline.plans.vocabulary import refresh_vocabulary
from roostline.quality import (
    checks_gate,
    freshness_gate,
    measures,
    refresh_decision,
    run_checks,
    schema_drift,
    source_freshness,
)
from roostline.sinks import Candidate, Warehouse
from roostline.sinks.tables import AUDIT_COLUMN, last_month
from roostline.sources import RawSources
from roostline.streaming import check_late_arrivals, reprocess_bound

DAILY = "fct_daily_listing_performance"
LISTING_MONTHS = "fct_monthly_listing_performance"
NEIGHBORHOOD_MONTHS = "fct_monthly_neighborhood_summary"


@dataclass
class Lineage:
    """Staging and history of one set of sources, all lazy and built on first use."""

    sources: RawSources
    json_mode: str = "failfast"
    unique_days: bool = False
    dated: bool = False

    @cached_property
    def listings(self) -> DataFrame:
        return staging.stg_listings(self.sources.listings, self.json_mode)

    @cached_property
    def calendar(self) -> DataFrame:
        return staging.stg_calendar(self.sources.calendar)

    @cached_property
    def reviews(self) -> DataFrame:
        return staging.stg_reviews(self.sources.generated_reviews)

    @cached_property
    def changelog(self) -> DataFrame:
        return staging.stg_amenities_changelog(self.sources.amenities_changelog, self.json_mode)

    @cached_property
    def scd(self) -> DataFrame:
        return intermediate.listing_amenities_scd(self.changelog)

    def events(self) -> DataFrame:
        return staging.parsed_changelog(self.sources.amenities_changelog, self.json_mode)

    def amenity_names(self) -> list[str]:
        """Names in the changelog: the amenity columns of history, fact and dimension."""
        return vocabulary(self.events())

    def listing_amenity_names(self) -> list[str]:
        """Names in the listings: the amenity columns of listings and spans."""
        return vocabulary(self.listings)

    def known_names(self, *candidates: str) -> list[str]:
        """Which of these spellings the changelog has."""
        return known_names(self.events(), candidates)

    def known_listing_names(self, *candidates: str) -> list[str]:
        """Which of these spellings the listings have."""
        return known_names(self.listings, candidates)

    def spans(self) -> DataFrame:
        return intermediate.availability_spans(self.calendar, self.listings, self.unique_days)

    def listings_history(self) -> DataFrame:
        return intermediate.listings_history(self.listings, self.scd)

    def dim_listings(self) -> DataFrame:
        return dimensions.dim_listings(self.listings_history(), self.scd)

    def fct_daily(
        self,
        reviews: str,
        names: list[str] | None = None,
        since: datetime.date | None = None,
    ) -> DataFrame:
        calendar = self.calendar
        if since is not None:
            # The month bound lets a calendar stored by month skip whole folders.
            calendar = calendar.filter(
                (F.col("calendar_date") >= F.lit(since))
                & (F.col("calendar_month") >= F.lit(since.replace(day=1)))
            )
        return facts.fct_daily(
            calendar, self.listings, self.scd, self.reviews, reviews, names, self.dated
        )

    def nights_within(
        self, spans: Sequence[tuple[datetime.date, datetime.date]], reviews: str
    ) -> DataFrame:
        """The nights of the fact in these spans of days, without amenities. Nights, their
        reservations and their reviews are bounded before anything is joined or written out."""

        def within(column: str, whole_months: bool = False) -> Column:
            return reduce(
                or_,
                [
                    F.col(column).between(F.lit(a.replace(day=1) if whole_months else a), F.lit(b))
                    for a, b in spans
                ],
            )

        nights = self.calendar.filter(within("calendar_date") & within("calendar_month", True))
        return facts.fct_daily(
            nights, self.listings, None, self.reviews.filter(within("review_date")), reviews=reviews
        )

    def located(self) -> DataFrame:
        """The listings of the fact and their neighborhoods: all that have a night, since periods
        leave no date of a listing out."""
        nights = self.calendar.select("listing_id").distinct()
        return self.listings.select("listing_id", "neighborhood").join(
            nights, "listing_id", "left_semi"
        )


def _listed(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "amenity_name string")


@dataclass
class RunResult:
    freshness: str
    strategy: str
    tables: dict[str, DataFrame]
    checks: DataFrame


def prepare_daily(
    spark: SparkSession,
    lineage: Lineage,
    warehouse: Warehouse,
    run_ts: datetime.datetime | str,
    strategy: str,
    names: list[str] | None = None,
    reviews: str = "aggregate",
    wide: bool = True,
) -> Candidate:
    """Build the nightly fact in full, or upsert the reprocess window into it, as a candidate
    that nobody sees before it is committed.

    Both modes keep one row per listing and night by default, so they agree on every row. An
    incremental load into a missing or empty table is a full load. ``reviews='fanout'``
    repeats a night per review, which only a full load can store. ``wide=False`` stores the
    amenities as one array column, for vocabularies that cannot be columns.
    """
    if not wide:
        names = None
    elif names is None:
        names = lineage.amenity_names()
    table = warehouse.versions("marts", DAILY)
    begun = table.begin()
    bound = None
    if strategy == "incremental" and begun[0] is not None:
        bound = reprocess_bound(table.frame(begun[0]), month=last_month(begun[0]))
    if bound is not None and reviews != "aggregate":
        raise ValueError("an upsert needs one row per listing and night: reviews='aggregate'")
    rows = lineage.fct_daily(reviews, names, since=bound)
    if bound is None:
        return warehouse.prepare(
            rows, "marts", DAILY, run_ts, by_month=True, begun=begun, measures=measures(DAILY)
        )
    return warehouse.prepare_upsert(
        rows, "marts", DAILY, facts.FACT_KEY, since=bound, run_ts=run_ts, begun=begun, measures=measures(DAILY)
    )


def load_daily(
    spark: SparkSession,
    lineage: Lineage,
    warehouse: Warehouse,
    run_ts: datetime.datetime | str,
    strategy: str,
    names: list[str] | None = None,
    reviews: str = "aggregate",
    wide: bool = True,
) -> DataFrame:
    """Prepare the nightly fact and commit it, see :func:`prepare_daily`."""
    return warehouse.commit(
        prepare_daily(spark, lineage, warehouse, run_ts, strategy, names, reviews, wide)
    )


def run_pipeline(
    spark: SparkSession,
    sources: RawSources,
    warehouse: Warehouse,
    as_of: datetime.datetime,
    json_mode: str = "failfast",
    reviews: str = "aggregate",
    publish: bool = False,
    gate: bool = True,
    wide: bool = True,
    keep_vocabulary: bool = False,
) -> RunResult:
    """One daily run. ``as_of`` is the run time: gates, tenure, ages and audit use it.

    Order: freshness (an error stops the run), source checks, staging and history, late rows
    and amenity drift, load mode, dimensions, fact, rollups, all other checks, committing and
    publishing, analyses. Marts are written as candidates and become visible only after their
    checks; the other layers are views. With ``gate`` a check of error severity that finds rows
    stops the run: of a source before anything is loaded, of another table before any mart is
    committed, and the candidates go. ``wide=False`` keeps amenities as array columns in all
    tables and needs no vocabulary. ``keep_vocabulary`` reads only new events of the amenity log
    for its names, see ``vocabulary.py``; the log must then only grow.
    """
    freshness = freshness_gate(source_freshness(sources.items(), as_of))
    lineage = Lineage(sources, json_mode)
    tables: dict[str, DataFrame] = {f"raw.{name}": df for name, df in sources.items()}
    if gate:
        checks_gate(run_checks(tables))
    names = None
    if wide and keep_vocabulary:
        names = refresh_vocabulary(warehouse, sources.amenities_changelog, as_of, json_mode)
    elif wide:
        names = lineage.amenity_names()
    listing_names = lineage.listing_amenity_names() if wide else None

    def widened(df: DataFrame, columns: list[str] | None) -> DataFrame:
        return df if columns is None else widen(df, columns)

    spans, hosts = lineage.spans(), intermediate.hosts_history(lineage.listings)
    views = {
        "stg_listings": widened(lineage.listings, listing_names),
        "stg_calendar": lineage.calendar,
        "stg_reviews": lineage.reviews,
        "stg_amenities_changelog": widened(lineage.changelog, names),
        "int_listing_amenities_scd": widened(lineage.scd, names),
        "int_availability_spans": widened(spans, listing_names),
        "int_calendar_enriched": intermediate.calendar_enriched(
            lineage.calendar, lineage.listings, lineage.scd, names
        ),
        "int_hosts_history": hosts,
        "int_listings_history": lineage.listings_history(),
    }
    for name, df in views.items():
        tables[name] = warehouse.view(df, name)

    strategy = "full_refresh"
    if warehouse.exists("marts", DAILY):
        target = warehouse.read("marts", DAILY)
        known = (*facts.FACT_COLUMNS, *facts.NIGHT_COLUMNS, "amenities", AUDIT_COLUMN)
        found = _listed(spark, names) if names is not None else vocabulary_frame(lineage.events())
        # An array column takes any name.
        drift = schema_drift(found if wide else found.limit(0), target.columns, known)
        late = check_late_arrivals(sources.calendar, target, as_of)
        strategy = refresh_decision(drift, late).first().strategy

    candidates: dict[str, Candidate] = {}

    def mart(name: str, candidate: Candidate) -> None:
        candidates[name] = candidate
        tables[name] = candidate.df

    def prepared(df: DataFrame, name: str) -> None:
        mart(name, warehouse.prepare(df, "marts", name, as_of, measures=measures(name)))

    try:
        prepared(dimensions.dim_date(spark, as_of.date()), "dim_date")
        prepared(dimensions.dim_hosts(hosts, as_of.date()), "dim_hosts")
        prepared(widened(lineage.dim_listings(), names), "dim_listings")
        mart(DAILY, prepare_daily(spark, lineage, warehouse, as_of, strategy, names, reviews, wide))
        prepared(facts.fct_monthly_listing(tables[DAILY]), LISTING_MONTHS)
        prepared(facts.fct_monthly_neighborhood(tables[DAILY]), NEIGHBORHOOD_MONTHS)
        # Marts were measured while they were written: only uniqueness reads them again.
        checks = run_checks(tables, measured={n: c.manifest.measured for n, c in candidates.items()})
        if gate:
            checks_gate(checks)
    except BaseException:
        for candidate in candidates.values():
            warehouse.discard(candidate)
        raise
    waiting = dict(candidates)
    try:
        for name in candidates:
            warehouse.commit(waiting.pop(name))
    except BaseException:
        # The one that failed is gone already.
        for candidate in waiting.values():
            warehouse.discard(candidate)
        raise
    if publish:
        for name in candidates:
            warehouse.publish("marts", name)

    dim_listings, dim_date = tables["dim_listings"], tables["dim_date"]
    answers = {
        "problem_1_amenity_revenue": analyses.amenity_revenue(
            tables[DAILY], dim_date, names or lineage.known_names(*analyses.AIR_CONDITIONING)
        ),
        "problem_2_neighborhood_pricing": analyses.neighborhood_pricing(tables[DAILY]),
        "problem_3a_max_stay_duration": analyses.max_stay(spans, dim_listings, dim_date),
        "problem_3b_max_stay_lockbox_firstaid": analyses.max_stay_with_amenities(
            spans,
            dim_listings,
            dim_date,
            listing_names
            or lineage.known_listing_names(*analyses.LOCKBOX, *analyses.FIRST_AID_KIT),
        ),
    }
    for name, df in answers.items():
        tables[name] = warehouse.view(df, name)
    return RunResult(freshness, strategy, tables, checks)
