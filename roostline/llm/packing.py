"""Packing by minimum bin slack.

Documents are encoded and cut into full windows and one remainder each. The lengths of all
pieces form a histogram of at most ``capacity`` counts. A plan fills one window after
another: the largest length left is taken, and a subset-sum over the lengths left, with their
counts, on a bitset finds the sum closest to the room that remains; its counts are traced
back. The same filling is repeated while the counts allow, so the plan stays short at any
number of documents. Each piece then finds its window from its rank among pieces of its length.

Defined cases: a null or empty text has only the end id; repeated rows are packed as often as
they occur; rows without a doc_id are packed too; an empty table gives no pieces; a very long
text is cut into as many windows as it needs; columns other than id and text are ignored.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roostline.llm.common import bounded_batches, table, texts, written

CAPACITY = 1024
END_ID = 0

Filling = tuple[dict[int, int], int]


def closest_filling(counts: dict[int, int], room: int) -> dict[int, int]:
    """Counts of lengths whose sum is the largest that fits into ``room``."""
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps: list[tuple[int, int]] = []
    for length in sorted(counts, reverse=True):
        most = min(counts[length], room // length)
        if most < 1:
            continue
        steps.append((length, reach))
        taken = 1
        while most > 0:
            step = min(taken, most)
            reach |= (reach << (step * length)) & mask
            most -= step
            taken *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, before in reversed(steps):
        while not before >> total & 1:
            total -= length
            chosen[length] = chosen.get(length, 0) + 1
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Filling]:
    """Fillings and how often each is used; together they use up the histogram."""
    left = {length: n for length, n in histogram.items() if n > 0}
    fillings: list[Filling] = []
    while left:
        largest = max(left)
        rest = {**left, largest: left[largest] - 1}
        chosen = closest_filling(rest, capacity - largest)
        chosen[largest] = chosen.get(largest, 0) + 1
        times = min(left[length] // n for length, n in chosen.items())
        for length, n in chosen.items():
            left[length] -= times * n
            if not left[length]:
                del left[length]
        fillings.append((chosen, times))
    return fillings


class Places:
    """Window and offset of the piece with a given length and rank among that length."""

    def __init__(self, fillings: list[Filling]):
        self.by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        ranks: Counter[int] = Counter()
        window = 0
        for chosen, times in fillings:
            offset = 0
            for length, n in chosen.items():
                self.by_length.setdefault(length, []).append((ranks[length], window, n, offset))
                ranks[length] += times * n
                offset += n * length
            window += times
        self.starts = {k: [v[0] for v in rows] for k, rows in self.by_length.items()}

    def find(self, length: int, rank: int) -> tuple[int, int]:
        first, window, n, offset = self.by_length[length][
            bisect.bisect_right(self.starts[length], rank) - 1
        ]
        copy, slot = divmod(rank - first, n)
        return window + copy, offset + slot * length


def encoded_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece with its ids, written once. ``part`` and ``nth`` number the pieces of
    a length: the nth of its length in the task that wrote it."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from roostline.llm.tokens import encoder

        tokenizer = encoder(vocabulary)
        part = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            rows = []
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(doc_ids, tokenizer.encode(batch.column("text").to_pylist())):
                ids += end
                for start in range(0, len(ids), 4 * capacity):
                    piece = ids[start : start + 4 * capacity]
                    length = len(piece) // 4
                    rows.append((doc_id, start // 4, length, len(ids) // 4, piece, part, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, KINDS)], NAMES
            )

    kinds = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, part int, nth bigint"
    NAMES = [x.split()[0] for x in kinds.split(", ")]
    KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    source = texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return written(source.mapInArrow(encode, kinds), "pieces")


def place(pieces: DataFrame, numbers: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``numbers`` holds (part, length) of all
    pieces; only its histogram of at most ``capacity`` rows reaches the driver."""
    per_part = numbers.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_part.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def where(length, rank):
        import pandas as pd

        found = [places.find(a, b) for a, b in zip(length.tolist(), rank.tolist())]
        return pd.DataFrame(found, columns=["sequence_id", "offset"])

    placed = pieces.join(ranks, ["part", "length"]).withColumn(
        "_place", where("length", F.col("nth") + F.col("before"))
    )
    return placed.withColumns(
        {"sequence_id": F.col("_place.sequence_id"), "offset": F.col("_place.offset")}
    ).drop("_place", "part", "nth", "before")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece with its ids (little-endian unsigned 32-bit), sequence and offset."""
    pieces = encoded_pieces(docs, vocabulary, capacity, end_id)
    return place(pieces, pieces.select("part", "length"), capacity)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = encoded_pieces(table(spark, sf_dir, "documents"), path, CAPACITY, END_ID)
    # The digest is taken where the ids are read, so they need not move with their places.
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(digests, pieces.select("part", "length")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
