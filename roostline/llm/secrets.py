"""Secret scans over an incremental ledger of blobs, with DataFrame functions only.

Every version of a file is content-addressed. The ledger holds one row per blob and run with
the rule versions that were applied and the spans found. A run scans only pairs of blob and
rule version that the ledger lacks, appends them, and joins the spans back to all paths.

Defined cases: a null text is an empty blob; a null path is a path like any other; repeated
rows give repeated results; an empty table gives an empty result; other columns are ignored.
Positions count code points, ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.llm.common import table, texts, written
from roostline.session import scratch_dir


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and without overlap; those whose ``group`` has fewer
    than ``least`` characters are dropped afterwards."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


# The patterns of the base findings, in their listed order.
RULES = (
    Rule(
        "assign",
        1,
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)

LEDGER_SCHEMA = (
    "blob string, rules array<string>, "
    "spans array<struct<start:int,rank:int,finish:int,kind:string,rule:string>>"
)


def address(versions: DataFrame) -> DataFrame:
    """Path, content address and text of every version."""
    return texts(versions).withColumn("blob", F.sha2("text", 256))


def _lengths(strings):
    return F.transform(strings, F.length)


def _matches(rule: Rule, rank: int):
    """The matches of one rule as an array: the text between a match and the one before it,
    the match and the measured group, all as lengths."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    zipped = F.arrays_zip(
        _lengths(F.split(text, rule.pattern, -1)).alias("gap"),
        _lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("size"),
        _lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("measured"),
    )
    described = F.transform(
        zipped,
        lambda m, i: F.struct(
            F.lit(rank).alias("rank"),
            i.alias("at"),
            m["gap"].alias("gap"),
            m["size"].alias("size"),
            (m["measured"] >= rule.least).alias("found"),
        ),
    )
    due = F.array_contains("pending", rule.key) & text.rlike(rule.pattern)
    # The piece after the last match has no match beside it.
    return F.when(due, F.filter(described, lambda m: m["size"].isNotNull()))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of ``blobs`` (blob, text, pending): the spans of all pending rules.

    The position of a match is a running sum over the lengths before it, so a text with very
    many matches costs linear work. A window holds the matches of one rule in one blob.
    """
    none = F.array().cast("array<struct<rank:int,at:int,gap:int,size:int,found:boolean>>")
    every = F.concat(*[F.coalesce(_matches(r, i), none) for i, r in enumerate(rules)])
    rows = blobs.select("blob", "pending", F.inline_outer(every))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    keys = F.array(*[F.lit(r.key) for r in rules])
    finish = F.expr(
        "cast(sum(gap + size) OVER (PARTITION BY blob, rank ORDER BY at "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) as int)"
    )
    placed = rows.withColumn("finish", finish)
    span = F.struct(
        (F.col("finish") - F.col("size")).alias("start"),
        "rank",
        "finish",
        kinds[F.col("rank")].alias("kind"),
        keys[F.col("rank")].alias("rule"),
    )
    return placed.groupBy("blob").agg(
        F.first("pending").alias("rules"),
        F.array_sort(F.collect_list(F.when(F.col("found"), span))).alias("spans"),
    )


def unseen_blobs(addressed: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """Each blob once, with its text and the keys of the rule versions still to apply.

    Copies are combined before the shuffle, so a blob under very many paths costs one row
    per task. With a ledger, paths of finished blobs are removed before any text moves.
    """
    wanted = F.array(*[F.lit(r.key) for r in rules])
    if ledger is None:
        once = addressed.groupBy("blob").agg(F.any_value("text").alias("text"))
        return once.withColumn("pending", wanted)
    applied = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("applied"))
    pending = (
        addressed.select("blob")
        .distinct()
        .join(applied, "blob", "left")
        .withColumn("pending", F.array_except(wanted, F.coalesce("applied", F.array().cast("array<string>"))))
        .filter(F.size("pending") > 0)
        .select("blob", "pending")
    )
    open_rows = addressed.select("blob", "text").join(pending, "blob", "left_semi")
    once = open_rows.groupBy("blob").agg(F.any_value("text").alias("text"))
    return once.join(pending, "blob")


def scan(
    spark: SparkSession, versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Bring the ledger up to date and return (doc_id, spans) of every version.

    ``ledger`` is a folder on storage that all executors reach; it is created when missing.
    The append is one committed job: a run that dies leaves no half-scanned blob behind. Two
    runs at the same time may scan a blob twice, which changes no result.
    """
    addressed = address(versions)
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    known = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    before = spark.read.schema(LEDGER_SCHEMA).parquet(ledger) if known else None
    scan_blobs(unseen_blobs(addressed, before, rules), rules).write.mode("append").parquet(ledger)
    # A table of its own, so that the join below reads exchanges alone and a blob under very
    # many paths is split.
    found = written(
        spark.read.schema(LEDGER_SCHEMA)
        .parquet(ledger)
        .filter(F.size("spans") > 0)
        .groupBy("blob")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")),
        "secret-spans",
    )
    current = F.array(*[F.lit(r.key) for r in rules])
    spans = F.filter("spans", lambda s: F.array_contains(current, s["rule"]))
    empty = F.array().cast("array<struct<start:int,rank:int,finish:int,kind:string,rule:string>>")
    return (
        addressed.select("doc_id", "blob")
        .join(found, "blob", "left")
        .select("doc_id", "blob", F.coalesce(spans, empty).alias("spans"))
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind and the joined spans."""

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    joined = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["finish"])), ","
    )
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined, 256).alias("base_sha256"),
        joined.alias("spans"),
    )


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digest(scan(spark, docs, scratch_dir(spark, "secret-ledger")))


# The first pattern as SQL text, with the letters of its keywords in either case.
ASSIGN_SQL = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)

# Each kind: pieces between matches and matches as lists, positions from their lengths.
OP3_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lists AS (
  SELECT doc_id, 'assign' AS kind, 0 AS rank, 12 AS least,
         string_split_regex(text, '{assign}') AS gaps,
         regexp_extract_all(text, '{assign}', 0) AS hits,
         regexp_extract_all(text, '{assign}', 2) AS parts
  FROM texts
  UNION ALL
  SELECT doc_id, 'access', 1, 18, string_split_regex(text, 'AKIA[A-Z0-9]+'),
         regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM texts
  UNION ALL
  SELECT doc_id, 'hex', 2, 16, string_split_regex(text, '[0-9a-f]{16,}'),
         regexp_extract_all(text, '[0-9a-f]{16,}'), regexp_extract_all(text, '[0-9a-f]{16,}') FROM texts),
each AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM lists WHERE len(hits) > 0),
found AS (
  SELECT doc_id, kind, rank, least, length(parts[i]) AS measured, length(hits[i]) AS size,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
  FROM each),
spans AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || cast(start AS bigint) || ':' || cast(start + size AS bigint), ','
                    ORDER BY start, rank) AS spans
  FROM found WHERE measured >= least GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM texts t LEFT JOIN spans USING (doc_id)
""".replace("{assign}", ASSIGN_SQL)
