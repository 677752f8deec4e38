"""The prefix trie of conversations: which beginnings they share, and what sharing saves.

A conversation's turns are put in order and numbered, and sums of hashes of (place, role and text)
name each of its beginnings. Equal names are one node of the trie. A node's parent is the name one
turn shorter; totals over subtrees come from the centroid decomposition of ``forest.py``.

Numbers and sums are made over ranges of all turns, so that no conversation, however long, has to
lie in one task. The ids that end at a node are put in order in the same way and joined to pieces
of text by all tasks; only the digest, which is defined over the whole text, reads the pieces of a
node one after another.

Defined cases: rows without a conv_id take no part; a null role or text is empty; a null turn comes
first; equal turns are ordered by the md5 of role and text, and repeated rows are as many turns;
without conversations there is no node; other columns are ignored. Beginnings count as equal when
four sums of 32-bit hashes are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.llm.common import bounded_batches, table, written
from roostline.llm.forest import LIMIT, subtree_totals
from roostline.operators.copies import expand_copies
from roostline.operators.running import running

# A rebuilt conversation begins with fewer than ``BORROWED`` turns of the first of ``FAMILY`` ids.
FAMILY, BORROWED = 5, 9
SUMS = ["s0", "s1", "s2", "s3"]
# Ids of one piece of text.
PIECE = 65_536


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), content (the md5 of role and text) and n_bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        content.alias("content"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    counted = rows.groupBy("conv_id", "turn", "content", "n_bytes").count()
    each = expand_copies(counted, "count", "nth")
    order = [F.col("turn").asc_nulls_first(), F.col("content"), F.col("nth")]
    return running(each, order, ["conv_id"], "depth").select("conv_id", "depth", "content", "n_bytes")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of conversations that borrow their beginning from the first of their family, and
    the conversations with their new lengths."""
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED
    lengths = numbered.groupBy("conv_id").agg(F.max("depth").alias("n_own"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = lengths.select("conv_id", "n_own", kept.alias("h"), family.alias("family"))
    firsts = lengths.select(F.col("conv_id").alias("of"), F.col("n_own").alias("n_first"))
    borrowed = F.least("h", F.coalesce("n_first", F.lit(0)))
    convs = written(
        convs.join(firsts, F.col("family") == F.col("of"), "left").select(
            "conv_id", "family", "h", borrowed.alias("borrowed"),
            (borrowed + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length"),
        ),
        "conversations",
    )
    # At most 8 turns meet at most 5 conversations.
    heads = numbered.filter(F.col("depth") < BORROWED).withColumnRenamed("conv_id", "of")
    taken = convs.join(heads, (F.col("family") == F.col("of")) & (F.col("depth") <= F.col("h"))).select(
        "conv_id", "depth", "content", "n_bytes", "length"
    )
    own = numbered.join(convs, "conv_id").filter(F.col("depth") > F.col("h")).select(
        "conv_id", (F.col("borrowed") + F.col("depth") - F.col("h")).alias("depth"), "content", "n_bytes", "length"
    )
    return taken.union(own), convs


def node_name(*sums: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", *[s.cast("string") for s in sums])))


def beginnings(rows: DataFrame) -> DataFrame:
    """The turns with the names of the beginning that ends with them (``node``) and of the one
    before (``parent``)."""
    halves = []
    for seed in (1, 2):
        value = F.xxhash64(F.lit(seed), "depth", "content")
        halves += [F.shiftrightunsigned(value, 32), value.bitwiseAND(F.lit(0xFFFFFFFF))]
    hashed = rows.select("*", *[h.alias(f"h{i}") for i, h in enumerate(halves)])
    summed = running(hashed, [F.col("depth")], ["conv_id"], "_place", {s: f"h{i}" for i, s in enumerate(SUMS)})
    return summed.select(
        "conv_id", "depth", "n_bytes", "length",
        node_name(*[F.col(s) for s in SUMS]).alias("node"),
        node_name(*[F.col(s) - F.col(f"h{i}") for i, s in enumerate(SUMS)]).alias("parent"),
    )


def digests(ends: DataFrame) -> DataFrame:
    """(node, sha256) of the ids at each node, ascending, as decimals joined by commas."""

    def pieces(batches):
        import pyarrow as pa

        node, ids = None, []

        def piece():
            return pa.RecordBatch.from_pydict(
                {"node": pa.array([node], pa.binary()), "first": [ids[0]], "ids": [",".join(map(str, ids))]}
            )

        for batch in batches:
            for at, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (at != node or len(ids) >= PIECE):
                    yield piece()
                    ids = []
                node = at
                ids.append(conv)
        if ids:
            yield piece()

    def digest(batches):
        import pyarrow as pa

        node, state = None, None
        for batch in batches:
            nodes, sums = [], []
            for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if at != node:
                    if state is not None:
                        nodes.append(node)
                        sums.append(state.hexdigest())
                    node, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.binary()), "ends_sha256": pa.array(sums, pa.string())})
        if state is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "ends_sha256": [state.hexdigest()]})

    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["node", "conv_id"]
    ranged = ends.select(*order).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    joined = ranged.mapInArrow(pieces, "node binary, first bigint, ids string")
    return (
        joined.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")
    )


def trie(rows: DataFrame, convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of ``rows`` (the turns of ``convs``), the root included."""
    rows = written(beginnings(rows), "beginnings")
    root = node_name(*[F.lit(0)] * len(SUMS))
    found = rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("n_bytes").alias("n_bytes"),
    )
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    nodes = written(
        found.select("node", "parent", "conv_id", "depth", "n_convs", "n_bytes").union(
            top.select(root, F.lit(None).cast("binary"), "conv_id", F.lit(0).cast("bigint"), "n_convs", F.lit(0).cast("bigint"))
        ),
        "nodes",
    )
    children = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    known = written(
        nodes.join(children.withColumnRenamed("parent", "of"), F.col("node") == F.col("of"), "left").select(
            *nodes.columns, F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children")
        ),
        "known-nodes",
    )
    forest = known.select(
        "node",
        "parent",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    totals = subtree_totals(forest, ["n_leaves", "saved_tokens"], limit)
    ends = rows.filter("depth = length").select("node", "conv_id").union(
        convs.filter("length = 0").select(root.alias("node"), "conv_id")
    )
    parents = known.select(F.col("node").alias("of"), F.col("conv_id").alias("parent_conv_id"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        known.join(totals, "node")
        .join(parents, F.col("parent") == F.col("of"), "left")
        .join(digests(ends), "node", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
        .drop("of")
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    rows, convs = rebuilt(written(turns(table(spark, sf_dir, "conversations")), "turns"))
    return trie(rows, convs).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


OP12_SQL = """
WITH remainders AS (
  SELECT list(c ORDER BY i) AS lookup FROM (
    SELECT i, list_reduce(range(0, 8),
                          lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                          i) AS c
    FROM range(256) r(i))),
given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                               md5(length(role) || ':' || role || text)) AS nr
  FROM given),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS family,
         xor(list_reduce(
           list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT),
           lambda c, b: xor(c >> 8, lookup[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM given), remainders),
rebuilt AS (
  SELECT c.conv_id, n.nr, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.family AND n.nr <= c.h
  UNION ALL
  SELECT c.conv_id, n.nr + c.h, n.role, n.text FROM convs c JOIN numbered n USING (conv_id) WHERE n.nr > c.h),
paths AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY nr) AS path FROM rebuilt GROUP BY conv_id),
whole AS (SELECT conv_id, coalesce(path, []) AS path FROM convs LEFT JOIN paths USING (conv_id)),
prefixes AS (
  SELECT conv_id, d AS depth, path[1:d] AS prefix, d = len(path) AS ends
  FROM whole, unnest(range(0, len(path) + 1)) t(d)),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * coalesce(octet_length(encode(prefix[depth].text)), 0) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, depth),
family AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]),
lifted AS (
  SELECT prefix[1:d] AS top, sum((n_children = 0)::INTEGER) AS n_leaves, sum(saved) AS saved_tokens
  FROM family, unnest(range(0, depth + 1)) t(d) GROUP BY top)
SELECT f.conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM family f JOIN lifted l ON f.prefix = l.top
"""
