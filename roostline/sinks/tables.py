"""Layer routing, versioned tables, catalog publishing, and temporary views."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.sinks.manifests import MONTH, Manifest, VersionedTable
from roostline.sinks.upsert import staged_rows, with_kept_rows

# Namespace of each layer, spelled as existing queries expect it.
NAMESPACES = {
    "staging": "stagging",
    "intermediate": "development",
    "marts": "mart",
    "analyses": "analytics",
}
AUDIT_COLUMN = "updated_at"


def namespace(layer: str, default: str = "default", routes: dict[str, str] | None = None) -> str:
    """The namespace of a layer as configured, without a prefix; else the default."""
    custom = (NAMESPACES if routes is None else routes).get(layer)
    return default if custom is None else custom.strip()


def stamped(df: DataFrame, run_ts: datetime.datetime | str) -> DataFrame:
    return df.withColumn(AUDIT_COLUMN, F.lit(str(run_ts)).cast("timestamp"))


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Candidate:
    """A version that is written but not visible yet."""

    table: VersionedTable
    manifest: Manifest
    load: str

    @property
    def df(self) -> DataFrame:
        return self.table.frame(self.manifest)


@dataclass
class Warehouse:
    """Published parquet tables below one root, one folder per namespace and table.

    A load writes a candidate, which may be read and checked, and then commits it: one new
    manifest file makes it the table. Until that moment, and after a failure, readers see the
    version before. See ``manifests.py``.
    """

    spark: SparkSession
    root: str
    routes: dict[str, str] = field(default_factory=lambda: dict(NAMESPACES))

    def folder(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{namespace(layer, routes=self.routes)}/{name}"

    def versions(self, layer: str, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.folder(layer, name))

    def _newest(self, layer: str, name: str) -> Manifest:
        manifest = self.versions(layer, name).newest()
        if manifest is None:
            raise FileNotFoundError(f"no table {name} in layer {layer}")
        return manifest

    def exists(self, layer: str, name: str) -> bool:
        return self.versions(layer, name).newest() is not None

    def read(self, layer: str, name: str) -> DataFrame:
        return self.versions(layer, name).frame(self._newest(layer, name))

    def newest_month(self, layer: str, name: str) -> datetime.date | None:
        """The newest month of a table, from its manifest."""
        return last_month(self._newest(layer, name))

    @contextmanager
    def reading(self, layer: str, name: str) -> Iterator[DataFrame]:
        """The table as it is now, kept for the length of a block whatever loads commit."""
        table, reader = self.versions(layer, name), f"reader-{uuid.uuid4().hex}"
        manifest = table.pin_newest(reader)
        try:
            yield table.frame(manifest)
        finally:
            table.unpin(reader, manifest.number)

    def prepare(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        run_ts: datetime.datetime | str,
        by_month: bool = False,
        begun: tuple[Manifest | None, int] | None = None,
        measures: Mapping[str, Column] | None = None,
    ) -> Candidate:
        """Write the whole table anew, stamped with the run time, without showing it yet.
        ``measures`` are counted while the rows are written."""
        table = self.versions(layer, name)
        _, number = begun or table.begin()
        load, schema, parts, measured = table.write(stamped(df, run_ts), by_month, measures)
        return Candidate(table, Manifest(number, schema, parts, by_month, measured), load)

    def prepare_upsert(
        self,
        rows: DataFrame,
        layer: str,
        name: str,
        keys: Sequence[str],
        since: datetime.date,
        run_ts: datetime.datetime | str,
        begun: tuple[Manifest | None, int] | None = None,
        measures: Mapping[str, Column] | None = None,
    ) -> Candidate:
        """Update rows with a known key, insert the others, delete nothing; not shown yet.

        ``rows`` hold no date before ``since`` and one row per key; a repeated key stops the
        load with an example. Only months from ``since`` on are read and written anew. The new
        version names the new folders for these months and the old ones for all others, which
        keep their files and their audit time. The table has the columns of ``rows`` then: a
        new column is NULL in kept rows, a column that ``rows`` no longer have is gone.

        ``measures`` count failures while months are written. They hold for the whole table
        where the version before counted none: then the months that stay have none either.
        Others are left out.
        """
        table = self.versions(layer, name)
        base, number = begun or table.begin()
        if base is None or not base.by_month:
            raise FileNotFoundError(f"no table {name} by month in layer {layer}")
        first = since.replace(day=1)
        with staged_rows(self.spark, stamped(rows, run_ts)) as fresh:
            old = {part for part in base.parts if part_month(part) is None or part_month(part) >= first}
            current = Manifest(base.number, base.schema, {p: base.parts[p] for p in old}, True)
            merged = with_kept_rows(table.frame(current), fresh, list(keys))
            load, schema, written, counted = table.write(merged, True, measures)
        parts = {p: origin for p, origin in base.parts.items() if p not in old} | written
        measured = {m: n for m, n in counted.items() if base.measured.get(m) == 0}
        return Candidate(table, Manifest(number, schema, parts, True, measured), load)

    def commit(self, candidate: Candidate) -> DataFrame:
        """Make a candidate the table and read it. Raises, and leaves the table, when another
        load committed since the candidate's load began."""
        try:
            candidate.table.commit(candidate.manifest)
        except BaseException:
            self.discard(candidate)
            raise
        candidate.table.remove_old()
        return candidate.df

    @staticmethod
    def discard(candidate: Candidate) -> None:
        candidate.table.discard(candidate.load)

    def replace(
        self, df: DataFrame, layer: str, name: str, run_ts: datetime.datetime | str, by_month: bool = False
    ) -> DataFrame:
        return self.commit(self.prepare(df, layer, name, run_ts, by_month))

    def upsert(
        self,
        rows: DataFrame,
        layer: str,
        name: str,
        keys: Sequence[str],
        since: datetime.date,
        run_ts: datetime.datetime | str,
    ) -> DataFrame:
        return self.commit(self.prepare_upsert(rows, layer, name, keys, since, run_ts))

    def publish(self, layer: str, name: str) -> str:
        """Show the newest version in the session catalog as ``namespace.name``.

        The version becomes an external table of its own name, and ``namespace.name`` is a view
        that is turned to it in one catalog change. The version stays pinned, whatever loads
        commit, until a later publishing turns the view away from it.
        """
        database, table = namespace(layer, routes=self.routes), self.versions(layer, name)
        target, reader = f"{database}.{_sql_name(name)}", f"catalog-{database}.{name}"
        manifest = table.pin_newest(reader)
        version = f"{database}.{_sql_name(f'{name}__v{manifest.number}')}"
        sql = self.spark.sql
        sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        columns = ", ".join(f"{_sql_name(f.name)} {f.dataType.simpleString()}" for f in manifest.schema.fields)
        folders = table.part_folders(manifest)
        place = table.folder + "/data" if manifest.by_month else next(iter(folders.values()))
        sql(f"DROP TABLE IF EXISTS {version}")
        sql(
            f"CREATE TABLE {version} ({columns}) USING parquet "
            f"{f'PARTITIONED BY ({MONTH})' if manifest.by_month else ''} LOCATION '{place}'"
        )
        if manifest.by_month and folders:
            months = [(part_value(part), folder) for part, folder in folders.items()]
            added = " ".join(f"PARTITION ({MONTH}={value}) LOCATION '{folder}'" for value, folder in months)
            sql(f"ALTER TABLE {version} ADD {added}")
        shown = ", ".join(_sql_name(f.name) for f in manifest.schema.fields)
        if self.spark.catalog.tableExists(f"{database}.{name}"):
            if self.spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
                sql(f"DROP TABLE {target}")
        sql(f"CREATE OR REPLACE VIEW {target} AS SELECT {shown} FROM {version}")
        for other, number in table.pins():
            if other == reader and number != manifest.number:
                sql(f"DROP TABLE IF EXISTS {database}.{_sql_name(f'{name}__v{number}')}")
                table.unpin(reader, number)
        return f"{database}.{name}"

    @staticmethod
    def view(df: DataFrame, name: str) -> DataFrame:
        """A lazy relation under a name for this session."""
        df.createOrReplaceTempView(name)
        return df


def part_month(part: str) -> datetime.date | None:
    value = part.removeprefix(f"{MONTH}=")
    return datetime.date.fromisoformat(value) if value[:1].isdigit() else None


def part_value(part: str) -> str:
    month = part_month(part)
    return "NULL" if month is None else f"DATE'{month}'"


def last_month(manifest: Manifest) -> datetime.date | None:
    months = [part_month(part) for part in manifest.parts]
    return max((m for m in months if m is not None), default=None)
