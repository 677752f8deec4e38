"""Sharding by proportional stratified interleaving: every shard has the mixture of the whole.

Rows are shuffled within their source by a seeded hash and ranked. A row's fractional rank is
(rank - u) / rows of its source, u being a number in (0, 1] drawn from the source, so that the
only rows of many small sources do not meet at one place. All rows sorted by fractional rank are
cut into shards whose row counts differ by one at most; a source's share of a shard is its share
of the whole, to within a few rows.

Nothing is ranked in one task. The hash is cut into as many equal ranges as the square root of
the rows: within a source a rank is the number of rows in lower ranges plus the place inside the
range, so a source with most rows is spread over all ranges. Fractional ranks are even by
construction and are cut and counted alike. Both sides, the ranges and the rows of one, grow with
the square root only. Rows travel without texts.

Defined cases: a null source is a source of its own; null ids and texts are values like others (a
null text has no bytes and the crc32 of none); equal rows are counted, numbered and told apart by
that number, so the result depends on the rows alone and neither on their order nor on their
files; fewer rows than shards leave shards empty; an empty table gives no rows. Input columns named
like the new ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roostline.functions.amenities import quoted
from roostline.llm.common import table, written
from roostline.operators.copies import expand_copies

SHARDS = 40
SEED = "mixture-1"
# Bytes of a row beside its text.
ROW_BYTES = 16
# A hash is a whole number below 2^60.
HASH_BITS = 60


def hashed(*parts: Column) -> Column:
    """A whole number below 2^60 from the parts, NULL being a value: the first 15 hexadecimal
    digits of an md5."""
    texts = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hash_range(hash_column: str, ranges: int) -> Column:
    """The range of a hash among equal ones, counted from 0; exact for up to 2^22 ranges."""
    return F.shiftright(F.shiftright(hash_column, 20) * F.lit(ranges), HASH_BITS - 20)


def offsets(sizes: DataFrame, cell: str, *group: str) -> DataFrame:
    """The rows of lower cells (``before``) and of the whole group (``total``) of each cell."""
    whole = Window.partitionBy(*group)
    lower = whole.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *group,
        cell,
        F.coalesce(F.sum("count").over(lower), F.lit(0)).alias("before"),
        F.sum("count").over(whole).alias("total"),
    )


def interleave(
    rows: DataFrame, source: str, shards: int = SHARDS, seed: str = SEED,
    shard: str = "shard", slot: str = "slot",
) -> DataFrame:
    """All rows with their ``shard`` (from 0) and ``slot`` in it (gapless from 0). Every column
    must be comparable; give narrow rows, since they are shuffled."""
    names = [c for c in rows.columns if c not in (shard, slot)]
    given = F.struct(*[quoted(c) for c in names])
    counted = rows.select(given.alias("row"), quoted(source).cast("string").alias("source"))
    copied = expand_copies(counted.groupBy("row", "source").count(), "count", "nth")
    drawn = written(
        copied.select(
            "row",
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("source"),
            "nth",
            hashed(F.lit(seed), *[F.col("row")[c] for c in names], F.col("nth")).alias("hash"),
        ),
        "interleave-rows",
    )
    n = drawn.count()
    ranges = max(1, math.isqrt(n))
    placed = drawn.withColumn("cell", hash_range("hash", ranges))
    order = ["hash", "row", "nth"]
    sizes = offsets(placed.groupBy("source", "cell").count(), "cell", "source")
    inside = Window.partitionBy("source", "cell").orderBy(*order)
    shift = (hashed(F.lit(seed), F.lit("source"), F.col("source")) + 1) / F.lit(float(1 << HASH_BITS))
    ranked = written(
        placed.withColumn("rank", F.row_number().over(inside))
        .join(sizes, ["source", "cell"])
        .select(
            "row", "source", "hash", "nth",
            ((F.col("rank") + F.col("before") - shift) / F.col("total")).alias("fraction"),
        ),
        "interleave-ranks",
    )
    # Only rounding can bring a fraction to 1.
    level = F.least(F.floor(F.col("fraction") * ranges), F.lit(ranges - 1)).cast("bigint")
    leveled = ranked.withColumn("cell", level)
    levels = offsets(leveled.groupBy("cell").count(), "cell")
    across = Window.partitionBy("cell").orderBy("fraction", "source", *order)
    total = F.lit(max(n, 1))
    place = (F.row_number().over(across) + F.col("before") - 1).cast("bigint")
    positioned = leveled.join(levels, "cell").withColumn("place", place)
    part = F.expr(f"place * {shards} div {max(n, 1)}")
    first = F.floor((F.col(shard) * total + (shards - 1)) / F.lit(shards)).cast("bigint")
    return (
        positioned.withColumn(shard, part.cast("int"))
        .withColumn(slot, F.col("place") - first)
        .select("row.*", shard, slot)
    )


def op13_proportional_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        "source",
    )
    return interleave(narrow, "source").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


# The crc32 goes through the usual table of 256 remainders of the reversed polynomial.
CRC32_SQL = """
remainders AS (
  SELECT list(c ORDER BY i) AS lookup FROM (
    SELECT i, list_reduce(range(0, 8),
                          lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                          i) AS c
    FROM range(256) r(i)))"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes, beside the relation ``remainders``."""
    return f"""xor(list_reduce(
      list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT),
      lambda c, b: xor(c >> 8, lookup[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


OP13_SQL = f"""
WITH {CRC32_SQL},
narrow AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + {ROW_BYTES} AS size,
         {crc32_sql("coalesce(text, '')")} AS text_crc32, source
  FROM documents, remainders),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, size, text_crc32, source) AS nth FROM narrow),
drawn AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', '={SEED}', coalesce('=' || doc_id, '-'), '=' || size,
                                          '=' || text_crc32, coalesce('=' || source, '-'), '=' || nth)), 1, 15))::BIGINT AS hash,
         coalesce('=' || source, '-') AS stratum
  FROM numbered),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY hash, doc_id NULLS FIRST, size, text_crc32, nth) AS rank,
         count(*) OVER (PARTITION BY stratum) AS total,
         (('0x' || substr(md5(concat_ws('|', '={SEED}', '=source', '=' || stratum)), 1, 15))::BIGINT + 1)
           / {float(1 << HASH_BITS)!r}::DOUBLE AS shift
  FROM drawn),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (rank - shift) / total, stratum, hash, doc_id NULLS FIRST,
                               size, text_crc32, nth) - 1 AS place,
         count(*) OVER () AS n
  FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law,
       (place * {SHARDS} // n)::INTEGER AS shard,
       (place - (place * {SHARDS} // n * n + {SHARDS} - 1) // {SHARDS})::BIGINT AS slot,
       NULL::INTEGER AS grown_shard, source
FROM placed
"""
