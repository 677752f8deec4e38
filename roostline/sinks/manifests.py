"""Numbered manifests of a table: which folders of files are the table, version by version.

A table's folder holds ``data/load=<id>`` folders, which are never changed once written, and
``_manifests/<number>`` files. A manifest names, for every month of the table (or once for a table
without months), the load whose files hold it. The highest manifest that is whole is the table. A
version becomes visible when its manifest file is created, and creating a file that exists fails,
so of two loads that began with the same version only one can commit.

That rests on one promise of the file system: of two creations without overwriting one fails. HDFS,
ABFS and GCS keep it, S3A does with ``fs.option.create.conditional.overwrite``. No file or folder
is ever renamed.

``_pins/<reader>@<number>`` files keep a version for a reader, such as a catalog table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roostline.functions.amenities import quoted
from roostline.session import shuffles_removed

MONTH = "calendar_month"
LOAD = "load"
# The one part of a table without months.
WHOLE = ""
# Folders that no manifest names may belong to a running load until they are this old.
LEFTOVER_SECONDS = 7 * 24 * 3600


class ConcurrentLoadError(RuntimeError):
    """Another load committed a version after this one had begun."""


@dataclass(frozen=True)
class Manifest:
    """One version: its columns and the load that holds each part. A part is a folder name
    ``calendar_month=...`` or the whole table."""

    number: int
    schema: T.StructType
    parts: dict[str, str]
    by_month: bool
    # Counts of the whole version by name, taken while it was written.
    measured: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        content = {
            "schema": self.schema.jsonValue(),
            "parts": self.parts,
            "by_month": self.by_month,
            "measured": self.measured,
        }
        return json.dumps(content, sort_keys=True)

    @classmethod
    def from_json(cls, number: int, text: str) -> Manifest:
        content = json.loads(text)
        schema = T.StructType.fromJson(content["schema"])
        return cls(number, schema, content["parts"], content["by_month"], content["measured"])


class Files:
    """The few calls that manifests need, on whatever file system a path lies."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _at(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def names(self, folder: str) -> dict[str, float]:
        """Names in a folder with their times in seconds; a missing folder is empty."""
        files, place = self._at(folder)
        if not files.exists(place):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in files.listStatus(place)}

    def exists(self, path: str) -> bool:
        files, place = self._at(path)
        return files.exists(place)

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False when it exists."""
        files, place = self._at(path)
        try:
            stream = files.create(place, False)
        except Exception as failed:
            if files.exists(place):
                return False
            raise failed
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        return True

    def text(self, path: str) -> str:
        files, place = self._at(path)
        stream = files.open(place)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        files, place = self._at(path)
        files.delete(place, True)


class VersionedTable:
    """The versions of one table below its folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files = spark, folder.rstrip("/"), Files(spark)

    # Reading

    def _manifest_path(self, number: int) -> str:
        return f"{self.folder}/_manifests/{number:020d}"

    def numbers(self) -> list[int]:
        """All numbers taken, also by manifests that are not whole."""
        return sorted(int(n) for n in self.files.names(f"{self.folder}/_manifests") if n.isdigit())

    def manifest(self, number: int) -> Manifest | None:
        """A version, or None when its manifest is missing or was not written to its end."""
        try:
            return Manifest.from_json(number, self.files.text(self._manifest_path(number)))
        except ValueError:
            return None
        except Exception:
            if self.files.exists(self._manifest_path(number)):
                raise
            return None

    def newest(self) -> Manifest | None:
        for number in reversed(self.numbers()):
            found = self.manifest(number)
            if found is not None:
                return found
        return None

    def load_folder(self, load: str) -> str:
        return f"{self.folder}/data/{LOAD}={load}"

    def part_folders(self, manifest: Manifest) -> dict[str, str]:
        return {
            part: f"{self.load_folder(load)}/{part}" if part else self.load_folder(load)
            for part, load in sorted(manifest.parts.items())
        }

    def frame(self, manifest: Manifest) -> DataFrame:
        """The rows of a version. Older months lack the columns that are new since: NULL."""
        spark, folders = self.spark, list(self.part_folders(manifest).values())
        if not folders:
            return spark.createDataFrame([], manifest.schema)
        if not manifest.by_month:
            return spark.read.schema(manifest.schema).parquet(*folders)
        wanted = T.StructType([*manifest.schema.fields, T.StructField(LOAD, T.StringType())])
        rows = spark.read.schema(wanted).option("basePath", f"{self.folder}/data").parquet(*folders)
        return rows.select(*[quoted(f.name) for f in manifest.schema.fields])

    # Writing

    def begin(self) -> tuple[Manifest | None, int]:
        """The newest version and the number a load that starts from it has to take."""
        numbers = self.numbers()
        newest = next((m for m in map(self.manifest, reversed(numbers)) if m is not None), None)
        return newest, (numbers[-1] if numbers else 0) + 1

    def write(
        self, df: DataFrame, by_month: bool, measures: Mapping[str, Column] | None = None
    ) -> tuple[str, T.StructType, dict[str, str], dict[str, int]]:
        """Write the rows as a new load: its id, its columns, its parts and its measures, which
        are taken as the rows pass. Nobody sees them yet."""
        load = uuid.uuid4().hex
        target = self.load_folder(load)
        watch = Observation(load) if measures else None
        if watch is not None:
            df = df.observe(watch, *[F.coalesce(m, F.lit(0)).alias(name) for name, m in measures.items()])
        writer = df.write.partitionBy(MONTH) if by_month else df.write
        try:
            with shuffles_removed(self.spark):
                writer.parquet(target)
        except BaseException:
            self.files.delete(target)
            raise
        measured = {} if watch is None else {name: int(n) for name, n in watch.get.items()}
        fields = [T.StructField(f.name, f.dataType) for f in df.schema.fields]
        if not by_month:
            return load, T.StructType(fields), {WHOLE: load}, measured
        ordered = [f for f in fields if f.name != MONTH] + [f for f in fields if f.name == MONTH]
        months = [n for n in self.files.names(target) if n.startswith(f"{MONTH}=")]
        return load, T.StructType(ordered), {m: load for m in months}, measured

    def commit(self, manifest: Manifest) -> None:
        """Make a version the table, or raise when its number is taken."""
        if not self.files.create(self._manifest_path(manifest.number), manifest.to_json()):
            raise ConcurrentLoadError(f"version {manifest.number} of {self.folder} was committed by another load")

    def discard(self, load: str) -> None:
        self.files.delete(self.load_folder(load))

    # Keeping and removing

    def pin(self, reader: str, number: int) -> None:
        self.files.create(f"{self.folder}/_pins/{reader}@{number}", "")

    def unpin(self, reader: str, number: int) -> None:
        self.files.delete(f"{self.folder}/_pins/{reader}@{number}")

    def pins(self) -> set[tuple[str, int]]:
        names = [n.rsplit("@", 1) for n in self.files.names(f"{self.folder}/_pins") if not n.startswith(".")]
        return {(reader, int(number)) for reader, number in names}

    def pin_newest(self, reader: str) -> Manifest:
        """Pin the newest version for a reader. Versions are removed manifest first, so one that
        still has its manifest after it was pinned stays."""
        while True:
            manifest = self.newest()
            if manifest is None:
                raise FileNotFoundError(f"no table in {self.folder}")
            self.pin(reader, manifest.number)
            if self.manifest(manifest.number) is not None:
                return manifest
            self.unpin(reader, manifest.number)

    def remove_old(self, keep: int = 2, leftover_seconds: float = LEFTOVER_SECONDS) -> None:
        """Remove all versions but the newest ``keep`` and the pinned ones, and the files that no
        version names: those of removed versions at once, others when they are old, since a
        running load may still write them."""
        found = {n: self.manifest(n) for n in self.numbers()}
        whole = [n for n, m in found.items() if m is not None]
        pinned = {number for _, number in self.pins()}
        kept = {*whole[-keep:], *(n for n in whole if n in pinned)}
        freed: set[str] = set()
        for number in whole:
            if number not in kept:
                self.files.delete(self._manifest_path(number))
                freed |= set(found[number].parts.values())
        # A reader may have pinned a version meanwhile; it finds the manifest gone and takes another.
        used = {load for n in kept for load in found[n].parts.values()}
        now = time.time()
        for name, changed in self.files.names(f"{self.folder}/data").items():
            load = name.removeprefix(f"{LOAD}=")
            if load not in used and (load in freed or now - changed > leftover_seconds):
                newest = self.newest()
                if newest is None or load not in newest.parts.values():
                    self.discard(load)
