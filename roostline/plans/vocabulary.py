"""A kept vocabulary: amenity names found so far, and up to when the log has been read.

The amenity log only grows. Reading all of it for its distinct names costs a scan and a parse of
every event on every run; the kept table holds the names and the newest ``_loaded_at`` it has
seen, so a run reads events loaded since then. Events of the very same time are read again, since
more of them may have come. An event without a load time cannot be dated and is always read.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roostline.functions import vocabulary_frame
from roostline.plans import staging
from roostline.sinks import Warehouse

LAYER, NAME = "intermediate", "amenity_vocabulary"
SEEN = "seen_until"


def new_events(changelog: DataFrame, seen: datetime.datetime | None) -> DataFrame:
    """The events that a vocabulary which has seen the log until ``seen`` still has to read."""
    if seen is None or "_loaded_at" not in changelog.columns:
        return changelog
    loaded = F.col("_loaded_at")
    return changelog.filter((loaded >= F.lit(seen)) | loaded.isNull())


def refresh_vocabulary(
    warehouse: Warehouse,
    changelog: DataFrame,
    run_ts: datetime.datetime | str,
    json_mode: str = "failfast",
) -> list[str]:
    """All amenity names of the log, sorted; the kept table takes in what is new.

    The names are collected, as they become columns. A log that lost or changed events needs
    a new table: ``rebuild_vocabulary``."""
    table = warehouse.versions(LAYER, NAME)
    base, number = table.begin()
    kept = [] if base is None else table.frame(base).collect()
    seen = max((r[SEEN] for r in kept if r[SEEN] is not None), default=None)
    known = {r["amenity_name"] for r in kept if r["amenity_name"] is not None}
    fresh = new_events(changelog, seen)
    loaded = F.max("_loaded_at") if "_loaded_at" in changelog.columns else F.lit(None).cast("timestamp")
    newest = fresh.agg(loaded.alias("newest")).first()["newest"]
    names = vocabulary_frame(staging.parsed_changelog(fresh, json_mode))
    found = known | {r["amenity_name"] for r in names.collect()}
    until = newest if newest is not None and (seen is None or newest > seen) else seen
    if base is None or found != known or until != seen:
        # A row without a name keeps the time of a log without names.
        rows = [(n, until) for n in sorted(found)] or [(None, until)]
        frame = changelog.sparkSession.createDataFrame(rows, f"amenity_name string, {SEEN} timestamp")
        warehouse.commit(warehouse.prepare(frame, LAYER, NAME, run_ts, begun=(base, number)))
    return sorted(found)


def rebuild_vocabulary(
    warehouse: Warehouse,
    changelog: DataFrame,
    run_ts: datetime.datetime | str,
    json_mode: str = "failfast",
) -> list[str]:
    """The vocabulary of the whole log, kept anew."""
    empty = changelog.sparkSession.createDataFrame([], f"amenity_name string, {SEEN} timestamp")
    warehouse.replace(empty, LAYER, NAME, run_ts)
    return refresh_vocabulary(warehouse, changelog, run_ts, json_mode)
