"""Amenity sets.

A row carries its amenities as one sorted ``array<string>``. ``NULL`` means "unknown", the
value of a listing whose JSON list is empty. Boolean columns, one per name, are made only
where a table is published, by :func:`widen`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_amenities(text: str | Column, mode: str = "failfast") -> Column:
    """JSON array text to a sorted, trimmed, de-duplicated array.

    ``mode='failfast'`` stops the job on malformed JSON; ``'permissive'`` yields NULL.
    An empty list yields NULL; JSON nulls inside a list are no names.
    """
    column = F.col(text) if isinstance(text, str) else text
    raw = F.from_json(column, "array<string>", {"mode": mode.upper()})
    # nullif keeps one evaluation of the JSON text, a size test would need a second one.
    listed = F.nullif(raw, F.array().cast("array<string>"))
    trimmed = F.transform(listed, lambda name: F.trim(name))
    names = F.filter(trimmed, lambda name: name.isNotNull())
    return F.sort_array(F.array_distinct(names))


def vocabulary_frame(df: DataFrame, column: str = "amenities") -> DataFrame:
    """Distinct amenity names of an array column, one row per name."""
    # The outer explode keeps a parsed column evaluated once, see stg_amenities_changelog.
    names = df.select(F.explode_outer(column).alias("amenity_name")).distinct()
    return names.filter(F.col("amenity_name").isNotNull())


def vocabulary(df: DataFrame, column: str = "amenities") -> list[str]:
    """The sorted names on the driver, needed before a wide table can be planned: one per
    column of that table. A table published with the array column needs none.
    """
    return sorted(row.amenity_name for row in vocabulary_frame(df, column).collect())


def known_names(df: DataFrame, candidates: Iterable[str], column: str = "amenities") -> list[str]:
    """Which of a few given spellings occur; no other name reaches the driver."""
    wanted = F.array(*[F.lit(c) for c in candidates])
    found = df.select(F.array_intersect(column, wanted).alias("amenities"))
    return vocabulary(found.filter(F.size("amenities") > 0))


def quoted(name: str) -> Column:
    """A column whose name may hold blanks, dots or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def widen(df: DataFrame, names: Sequence[str], column: str = "amenities") -> DataFrame:
    """Replace the array by one boolean per name, at the place of the array."""
    session_case = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    others = [c for c in df.columns if c != column]
    _reject_collisions([*others, *names], session_case)
    flags = [F.array_contains(column, F.lit(name)).alias(name) for name in names]
    place = df.columns.index(column)
    columns = [quoted(c) for c in df.columns]
    return df.select(*columns[:place], *flags, *columns[place + 1 :])


def _reject_collisions(names: Iterable[str], case_sensitive: bool) -> None:
    seen: dict[str, str] = {}
    for name in names:
        key = name if case_sensitive else name.lower()
        if key in seen:
            raise ValueError(
                f"column {name!r} collides with {seen[key]!r}; "
                "set spark.sql.caseSensitive=true for names that differ by case only"
            )
        seen[key] = name


def resolve_alias(candidates: Sequence[str], names: Iterable[str]) -> str | None:
    """The first candidate spelling that exists in the vocabulary."""
    known = set(names)
    return next((c for c in candidates if c in known), None)


def amenity_flag(df: DataFrame, name: str | None) -> Column:
    """Whether a row has the amenity, from the array or from a published boolean column."""
    if name is None:
        return F.lit(None).cast("boolean")
    if "amenities" in df.columns:
        return F.array_contains("amenities", F.lit(name))
    return quoted(name)
