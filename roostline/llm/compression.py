"""Quality rules from zstandard ratios.

A text is rejected when it is too repetitive or too random: its compressed size over its size
must lie in a band that depends on its length, since short texts compress less, and so must
the ratios of its fixed chunks, of which only a small share may lie outside. Before that, base
counts reject texts that are very short or made of repeated word windows.

Defined cases: a null text has no words; an empty text has none either, and both fail the base
rule; repeated rows give repeated results; an empty table gives no rows; columns other than id
and text are ignored. Texts are measured whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from roostline.llm.common import bounded_batches, table, texts, words

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Lowest and highest ratio by length in bytes (from that length on), the same for chunks
    of ``chunk`` bytes, and the largest share of chunks outside."""

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.15, 9.0),
        (128, 0.22, 1.1),
        (512, 0.22, 0.85),
        (2048, 0.20, 0.75),
        (16384, 0.18, 0.72),
    )
    level: int = 3
    chunk: int = 4096
    chunk_low: float = 0.15
    chunk_high: float = 0.75
    chunks_outside: float = 0.25


BANDS = Bands()


@dataclass(frozen=True)
class Counts:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


def repeated_words(found: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    if len(found) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found))
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    width = len(numbers)
    _, place, often = np.unique(pairs[:-1] * width + ids[2:], return_inverse=True, return_counts=True)
    again = often[place] > 1
    covered = np.zeros(len(found), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def count(text: str) -> Counts:
    found = words(text)
    seen: set[bytes] = set()
    repeated = 0
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            repeated += line in seen
            seen.add(line)
    return Counts(
        n_words=len(found),
        word_chars=len(text) - sum(map(text.count, SPACES)),
        n_symbols=sum(map(text.count, SYMBOLS)),
        n_dup_lines=repeated,
        n_repeat_words=repeated_words(found),
    )


def ratios(raw: bytes, bands: Bands, zstd: zstandard.ZstdCompressor) -> tuple[float, int, int]:
    """The ratio of the whole text, the number of chunks and of those outside their band. A
    last piece of less than half a chunk is not a chunk."""
    whole = len(zstd.compress(raw)) / len(raw) if raw else 0.0
    chunks = outside = 0
    for start in range(0, len(raw), bands.chunk):
        piece = raw[start : start + bands.chunk]
        if 2 * len(piece) >= bands.chunk:
            chunks += 1
            ratio = len(zstd.compress(piece)) / len(piece)
            outside += not bands.chunk_low <= ratio <= bands.chunk_high
    return whole, chunks, outside


def within(size: int, whole: float, chunks: int, outside: int, bands: Bands) -> bool:
    low, high = next((a, b) for least, a, b in reversed(bands.whole) if size >= least)
    return low <= whole <= high and outside <= bands.chunks_outside * chunks


def compression_rules(docs: DataFrame, bands: Bands = BANDS) -> DataFrame:
    """Counts, ratios and verdict of every document."""
    bounded_batches(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                c = count(text)
                raw = text.encode("utf-8", "surrogatepass")
                whole, chunks, outside = ratios(raw, bands, zstd)
                kept = not c.base_failed and within(len(raw), whole, chunks, outside, bands)
                rows.append(
                    (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words)
                    + (c.base_failed, kept, whole, chunks, outside)
                )
            columns = [pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 10, types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    names = (
        "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept "
        "whole_ratio n_chunks n_chunks_outside"
    ).split()
    types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2
    source = texts(docs)
    kinds = dict(zip(names[1:], ["bigint"] * 5 + ["boolean"] * 2 + ["double"] + ["bigint"] * 2))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, " + ", ".join(
        f"{n} {k}" for n, k in kinds.items()
    )
    return source.mapInArrow(measure, schema)


def op4_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules(table(spark, sf_dir, "documents"))
