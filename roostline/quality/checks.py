"""Column checks on every table of the model, with their results as one DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roostline.functions.amenities import quoted


@dataclass(frozen=True)
class Check:
    column: str
    test: str
    values: tuple[str | int, ...] = ()
    severity: str = "error"


def not_null(*columns: str, severity: str = "error") -> list[Check]:
    return [Check(c, "not_null", severity=severity) for c in columns]


def unique(*columns: str, severity: str = "error") -> list[Check]:
    return [Check(c, "unique", severity=severity) for c in columns]


def accepted(column: str, *values: str | int, severity: str = "error") -> list[Check]:
    return [Check(column, "accepted_values", values, severity)]


# The checks of every table, sources first.
SPECS: dict[str, list[Check]] = {
    "raw.listings": [*unique("id"), *not_null("id", "host_id")],
    "raw.calendar": not_null("listing_id", "date", "available"),
    "raw.generated_reviews": [*unique("id"), *not_null("id", severity="warn")],
    "raw.amenities_changelog": not_null("listing_id", "change_at", "amenities"),
    "stg_listings": [*unique("listing_id"), *not_null("listing_id")],
    "stg_calendar": not_null("listing_id", "calendar_date"),
    "stg_reviews": [
        *unique("review_id"),
        *not_null("review_id", severity="warn"),
        *not_null("listing_id"),
    ],
    "stg_amenities_changelog": not_null("listing_id", "change_at"),
    "int_listing_amenities_scd": not_null("listing_id", "valid_from", "valid_to"),
    "int_calendar_enriched": not_null("listing_id", "calendar_date"),
    "int_availability_spans": not_null("listing_id", "span_start_date", "span_end_date"),
    "int_hosts_history": [*unique("host_id"), *not_null("host_id", "valid_from", "valid_to")],
    "int_listings_history": not_null("listing_id", "valid_from", "valid_to"),
    "dim_date": [
        *unique("date_day", "date_key"),
        *not_null("date_day", "date_key", "is_weekend"),
        *accepted("season", "Winter", "Spring", "Summer", "Fall"),
    ],
    "dim_hosts": [
        *unique("host_sk"),
        *not_null("host_sk", "host_id", "is_current"),
        *accepted("host_experience_tier", "New Host", "Established Host", "Veteran Host"),
    ],
    "dim_listings": [
        *unique("listing_sk"),
        *not_null("listing_sk", "listing_id", "is_current"),
        *accepted(
            "capacity_tier", "Small (1-2)", "Medium (3-4)", "Large (5-6)", "Extra Large (7+)"
        ),
        *accepted("price_tier", "Budget", "Economy", "Mid-Range", "Premium", "Luxury"),
        *accepted(
            "rating_tier",
            "Exceptional",
            "Excellent",
            "Good",
            "Average",
            "Below Average",
            severity="warn",
        ),
    ],
    "fct_daily_listing_performance": [
        *not_null("listing_id", "calendar_date", "date_key"),
        *accepted("is_occupied", 0, 1),
        *accepted("available_flag", 0, 1),
        *accepted("is_blocked", 0, 1),
    ],
    "fct_monthly_listing_performance": not_null("listing_id", "calendar_month"),
    "fct_monthly_neighborhood_summary": not_null("neighborhood", "calendar_month"),
}


def _failures(check: Check) -> Column:
    """Failing rows of a check that one pass over the table can count; NULL is accepted."""
    column = quoted(check.column)
    if check.test == "not_null":
        return F.count_if(column.isNull())
    return F.count_if(~column.isin(*check.values))


def _measure(check: Check) -> str:
    return f"{check.test} {check.column}"


def measures(table: str, specs: Mapping[str, Sequence[Check]] = SPECS) -> dict[str, Column]:
    """The failing rows of a table's checks that one pass can count, to be counted while the
    table is written."""
    return {_measure(c): _failures(c) for c in specs.get(table, ()) if c.test != "unique"}


def _check_table(
    name: str, df: DataFrame, checks: Sequence[Check], measured: Mapping[str, int]
) -> DataFrame:
    def result(check: Check, failures: Column) -> Column:
        return F.struct(
            F.lit(name).alias("table"),
            F.lit(check.column).alias("column"),
            F.lit(check.test).alias("test"),
            failures.cast("long").alias("failures"),
            F.lit(check.severity).alias("severity"),
        )

    parts = []
    known = [c for c in checks if _measure(c) in measured]
    if known:
        rows = F.array(*[result(c, F.lit(measured[_measure(c)])) for c in known])
        parts.append(df.sparkSession.range(1).select(F.inline(rows)))
    single_pass = [c for c in checks if c.test != "unique" and c not in known]
    if single_pass:
        counts = df.agg(*[_failures(c).alias(f"c{i}") for i, c in enumerate(single_pass)])
        rows = F.array(*[result(c, F.col(f"c{i}")) for i, c in enumerate(single_pass)])
        parts.append(counts.select(F.inline(rows)))
    for check in checks:
        if check.test == "unique":
            # The number of values that occur more than once.
            repeated = (
                df.select(quoted(check.column).alias("value"))
                .filter(F.col("value").isNotNull())
                .groupBy("value")
                .count()
                .agg(F.count_if(F.col("count") > 1).alias("failures"))
            )
            parts.append(repeated.select(F.inline(F.array(result(check, F.col("failures"))))))
    return reduce(DataFrame.unionByName, parts)


class FailedChecksError(RuntimeError):
    """Checks of error severity found rows."""


def checks_gate(results: DataFrame) -> str:
    """'passed' or 'warning'; raises when a check of error severity fails. One row per check."""
    rows = results.filter("status <> 'pass'").collect()
    failed = sorted(f"{r.table}.{r.column} {r.test}: {r.failures}" for r in rows if r.status == "fail")
    if failed:
        raise FailedChecksError("; ".join(failed))
    return "warning" if rows else "passed"


def run_checks(
    tables: Mapping[str, DataFrame],
    specs: Mapping[str, Sequence[Check]] = SPECS,
    measured: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """One row per check: failures, severity and status pass, warn or fail.

    All not-null and accepted-value checks of a table share one pass over it. ``measured`` has
    the counts of tables that were measured when they were written (:func:`measures`); these
    are not read again but for uniqueness.
    """
    counts = measured or {}
    results = [
        _check_table(name, tables[name], specs[name], counts.get(name, {}))
        for name in specs
        if name in tables
    ]
    status = (
        F.when(F.col("failures") == 0, "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("fail")
    )
    return reduce(DataFrame.unionByName, results).withColumn("status", status)
