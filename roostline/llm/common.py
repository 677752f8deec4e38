"""What the operators share: written tables, bounded Arrow batches, words and their hashes."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.session import remove_scratch, staged

# Words are runs of anything but the six ASCII white-space characters, for which
# ``bytes.split()`` is the same rule.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of one Arrow batch handed to Python, however long the texts are.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Batches to Python workers are cut by bytes, so long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")


def written(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: a lost executor costs no finished step."""
    return staged(df, label, codec)[0]


def texts(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The id and the text alone, so that other columns cannot clash. A null text is empty."""
    return docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Rounds:
    """Tables of a loop: a new one takes the place of the one before, whose files go."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, None

    def next(self, df: DataFrame, label: str) -> DataFrame:
        table, folder = staged(df, label)
        if self.folder:
            remove_scratch(self.spark, self.folder)
        self.folder = folder
        return table


_KEPT: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What a Python worker keeps for an operator between its tasks. A worker serves many
    operators in turn: what it kept for another one is let go."""
    for other in [o for o in _KEPT if o != owner]:
        del _KEPT[other]
    return _KEPT.setdefault(owner, {})


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


class Memo:
    """A bounded map from words to values: a full young generation becomes the old one."""

    def __init__(self, compute, limit: int = 300_000):
        self.compute, self.limit = compute, limit
        self.young: dict = {}
        self.old: dict = {}

    def load(self, keys: Iterable) -> dict:
        """A dictionary that holds at least the given keys; ``compute`` gets the new ones."""
        wanted = set(keys)
        missing = wanted.difference(self.young)
        if len(self.young) + len(missing) > self.limit and self.young:
            self.old, self.young = self.young, {}
            missing = wanted
        if missing:
            known = {k: self.old[k] for k in missing if k in self.old}
            self.young.update(known)
            fresh = [k for k in missing if k not in known]
            if fresh:
                self.young.update(zip(fresh, self.compute(fresh)))
        return self.young


def hash_words(keys: list[bytes]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(k) for k in keys]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of ``size`` words, in order."""
    n = len(word_hashes) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    if n <= 0:
        return total
    for i in range(size):
        total = mixed(total + word_hashes[i : i + n] + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64))
    return total


ASCII_SPACE = re.compile(rb"[\x20\x09-\x0D]+")
