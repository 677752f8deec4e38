"""Line dedup by a log-template tree, with DataFrame functions only.

A line walks a tree of fixed depth: the number of its tokens, then its leading tokens, in
which a token with a digit is a wildcard. A leaf so reached generalises its lines: runs of
digits count as one digit, and a position whose token is rare in the leaf is a variable
field. The tokens that stay are the line's template. A template found in ``min_docs``
documents is boilerplate: its lines stay in the first document (smallest doc_id) that has it
and go from all others.

A leaf's key is no evidence for a template: beyond the leading tokens, a place with more distinct
values than the square root of its leaf's documents is a field, and ``MIN_BEYOND`` fixed tokens
must remain there. A variant that itself recurs in ``min_docs`` documents is boilerplate all the
same, and one of ``LONG_LINE`` tokens or more from its second document on.

The online log parsers this follows update templates line by line; here a leaf's fields are
decided from counts over all lines, so that the result does not depend on the order of rows.

Defined cases: a null text stays null and an empty one empty; lines without ``min_tokens``
tokens are never dropped; rows with equal doc_id and text are treated alike; rows without a
doc_id count as one document, which is never the first; an empty table gives an empty one;
other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.functions.amenities import quoted
from roostline.llm.common import table, written
from roostline.session import scratch_scope

MIN_DOCS = 3
MIN_TOKENS = 4
DEPTH = 3
# A line is an instance of a template when this share of its tokens is fixed.
FIXED_SHARE = 0.7
# Fixed tokens that a generalised template has beyond its leading ones.
MIN_BEYOND = 2
# So long a line does not come up twice by chance: two documents are enough.
LONG_LINE, LONG_DOCS = 24, 2
ROW = ("_doc", "_text_hash")
# What makes the blanks of a text uneven: other white space than single spaces.
UNEVEN = ("\t", "\x0b", "\x0c", "\r", "  ")


def _has_any(text: str, parts: Iterable[str]) -> Column:
    """Plain searches over the bytes, which cost far less than a regular expression."""
    return reduce(or_, [F.contains(F.col(text), F.lit(p)) for p in parts])


def _lines(docs: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """One row per line with enough tokens, in a table: row key, line number, leaf, number of
    tokens, and the generalised line with its hash. Regular expressions run once over a whole
    text, before it is cut into lines, and only where it needs them. Every step is a column of its
    own: an expression below the cut would be evaluated at each place that names it."""
    spaced = F.when(
        _has_any("text", UNEVEN), F.regexp_replace("text", r"[\x20\x09\x0B-\x0D]+", " ")
    ).otherwise(F.col("text"))
    plain = F.when(
        _has_any("spaced", "0123456789"), F.regexp_replace("spaced", "[0-9]+", "0")
    ).otherwise(F.col("spaced"))
    leading = F.substring_index("general", " ", depth)
    marked = F.when(
        leading.contains("0"),
        F.array_join(
            F.transform(
                F.split(leading, " ", -1), lambda t: F.when(t.contains("0"), F.lit("0")).otherwise(t)
            ),
            " ",
        ),
    ).otherwise(leading)
    lines = (
        docs.select(
            F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text_hash"), spaced.alias("spaced")
        )
        .select(*ROW, plain.alias("plain"))
        .select(*ROW, F.posexplode(F.split("plain", "\n", -1)).alias("at", "line"))
        .withColumn("general", F.trim("line"))
        .withColumn(
            "size", F.octet_length("general") - F.octet_length(F.replace("general", F.lit(" "))) + 1
        )
        .filter(F.col("size") >= min_tokens)
    )
    return written(
        lines.select(
            *ROW,
            "at",
            F.xxhash64("size", marked).alias("leaf"),
            F.xxhash64("general").alias("variant"),
            "size",
            "general",
        ),
        "lines",
    )


def _documents_with(lines: DataFrame, key: list[str]) -> DataFrame:
    """Number of documents and first document of each key. Both aggregates combine before the
    shuffle, so a key of very many lines stays small."""
    return (
        lines.groupBy(*key, "_doc")
        .agg(F.lit(1).alias("one"))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("docs"), F.min("_doc").alias("first_doc"))
    )


def templates(lines: DataFrame, min_docs: int, fixed_share: float, depth: int = DEPTH) -> DataFrame:
    """(leaf, variant) -> template, two hashes, of the leaves found in enough documents.

    A leaf with one variant is that template. In others, tokens are counted by position over
    the distinct variants, each weighted by its documents; only there the text is read.
    """
    leaves = _documents_with(lines, ["leaf"]).filter(F.col("docs") >= min_docs).select("leaf")
    counted = _documents_with(lines, ["leaf", "variant"]).drop("first_doc").join(leaves, "leaf")
    of_leaf = counted.groupBy("leaf").agg(F.count(F.lit(1)).alias("variants"))
    variants = written(counted.join(of_leaf, "leaf"), "variants")
    alone = variants.filter("variants = 1").select(
        "leaf", "variant", F.col("leaf").alias("t1"), F.col("variant").alias("t2")
    )
    several = variants.filter("variants > 1")
    mixed = written(several.select("leaf").distinct(), "mixed-leaves")
    spelled = (
        lines.select("leaf", "variant", "general")
        .join(mixed, "leaf")
        .groupBy("leaf", "variant")
        .agg(F.any_value("general").alias("general"))
        .join(several.select("leaf", "variant", "docs"), ["leaf", "variant"])
    )
    tokens = written(
        spelled.select(
            "leaf", "variant", "docs", F.posexplode(F.split("general", " ", -1)).alias("place", "token")
        ).withColumn("token", F.xxhash64("token")),
        "variant-tokens",
    )
    usual = (
        tokens.groupBy("leaf", "place", "token")
        .agg(F.sum("docs").alias("support"))
        .withColumn("fixed", F.col("support") >= min_docs)
    )
    usual = written(usual, "token-support")
    places = (
        usual.filter(F.col("place") >= depth)
        .groupBy("leaf", "place")
        .agg(F.count(F.lit(1)).alias("values"), F.sum("support").alias("of_place"))
        .filter(F.col("values") * F.col("values") > F.col("of_place"))
        .select("leaf", "place", F.lit(True).alias("field"))
    )
    usual = usual.join(places, ["leaf", "place"], "left").withColumn(
        "fixed", F.col("fixed") & F.col("field").isNull()
    )
    usual = usual.select("leaf", "place", "token", "fixed")
    mark = F.when(F.col("fixed"), F.xxhash64("place", "token"))
    enough = (F.col("kept") >= F.lit(fixed_share) * F.col("size")) & (F.col("beyond") >= MIN_BEYOND)
    patterns = (
        tokens.join(usual, ["leaf", "place", "token"])
        .groupBy("leaf", "variant")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.count(mark).alias("kept"),
            F.count(F.when(F.col("place") >= depth, mark)).alias("beyond"),
            F.any_value("docs").alias("docs"),
            # Independent of the order of rows: the fixed tokens with their places.
            F.bit_xor(mark).alias("t2"),
        )
    )
    general = patterns.filter(enough | (F.col("docs") >= min_docs)).select(
        "leaf",
        "variant",
        F.when(enough, F.xxhash64("leaf", "kept")).otherwise(F.col("leaf")).alias("t1"),
        F.when(enough, F.col("t2")).otherwise(F.col("variant")).alias("t2"),
    )
    return alone.unionByName(general)


def dropped_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_tokens: int = MIN_TOKENS,
    depth: int = DEPTH,
    fixed_share: float = FIXED_SHARE,
    long_line: int = LONG_LINE,
) -> DataFrame:
    """One row per document row with recurring lines: key and sorted numbers of those lines."""
    lines = _lines(docs, min_tokens, depth)
    by_template = (
        lines.select(*ROW, "at", "leaf", "variant")
        .join(templates(lines, min_docs, fixed_share, depth), ["leaf", "variant"])
        .select(*ROW, "at", "t1", "t2", F.lit(min_docs).alias("needed"))
    )
    # A long line is a template of its own, beside the one it may belong to.
    whole = lines.filter(F.col("size") >= long_line).select(
        *ROW, "at", F.xxhash64("variant", "size").alias("t1"), F.col("variant").alias("t2"), F.lit(LONG_DOCS).alias("needed")
    )
    named = written(by_template.union(whole), "named-lines")
    # A table of its own, so that the join reads exchanges alone and a template of very many
    # lines is split.
    recurring = written(
        _documents_with(named, ["t1", "t2", "needed"]).filter("docs >= needed"), "recurring-templates"
    )
    return (
        named.join(recurring.select("t1", "t2", "first_doc"), ["t1", "t2"])
        .filter(~F.col("_doc").eqNullSafe(F.col("first_doc")))
        .groupBy(*ROW)
        .agg(F.array_sort(F.collect_set("at")).alias("_dropped"))
    )


def line_dedup(docs: DataFrame, n_dropped: str = "_n_dropped", **limits) -> DataFrame:
    """``docs`` with recurring lines removed from ``text``, and the number of removed lines in
    the column ``n_dropped``. The other columns are as they were, whatever their names; give
    another name for the number where ``docs`` has that one."""
    with scratch_scope(docs.sparkSession) as keep:
        dropped = keep(written(dropped_lines(docs, **limits), "dropped-lines"))
    own = docs.select(
        F.struct(*[quoted(c) for c in docs.columns if c != "text"]).alias("row"),
        F.col("doc_id").alias("id"),
        F.col("text").alias("given"),
    )
    # The list grows with the documents: one plan at every size.
    joined = own.join(
        dropped.hint("merge"),
        F.col("id").eqNullSafe(F.col("_doc")) & (F.xxhash64(F.col("given")) == F.col("_text_hash")),
        "left",
    )
    # The lines are a column of their own: inside the lambda, the text would be cut once per line.
    cut = F.when(F.col("_dropped").isNotNull(), F.split("given", "\n", -1))
    joined = joined.select("row", "given", "_dropped", cut.alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("_dropped"))
    cleaned = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    text = F.when(F.col("_dropped").isNull(), F.col("given")).otherwise(cleaned)
    others = [F.col("row")[n].alias(n) if n != "text" else text.alias("text") for n in docs.columns]
    return joined.select(*others, F.coalesce(F.size("_dropped"), F.lit(0)).alias(n_dropped))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines that recur elsewhere removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select(
        "doc_id", F.col("_n_dropped").cast("long").alias("n_dropped"), "text"
    )


# Tokens and leaves as lists; the same rules by window-free grouping.
OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS nr
  FROM documents WHERE text IS NOT NULL),
general AS (
  SELECT doc_id, text, nr, line,
         regexp_replace(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]+', '0', 'g') AS general
  FROM lines),
leaved AS (
  SELECT *, string_split(general, ' ') AS tokens,
         [len(string_split(general, ' '))::varchar]
           || list_transform(string_split(general, ' ')[1:3],
                             lambda t: CASE WHEN contains(t, '0') THEN '0' ELSE t END) AS leaf
  FROM general WHERE len(string_split(general, ' ')) >= 4),
hot AS (
  SELECT * FROM leaved WHERE leaf IN (
    SELECT leaf FROM leaved GROUP BY leaf
    HAVING count(DISTINCT doc_id) + bool_or(doc_id IS NULL)::int >= 3)),
variants AS (
  SELECT leaf, general, any_value(tokens) AS tokens,
         count(DISTINCT doc_id) + bool_or(doc_id IS NULL)::int AS docs
  FROM hot GROUP BY leaf, general),
placed AS (
  SELECT leaf, general, docs, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place
  FROM variants),
supported AS (
  SELECT leaf, place, token, sum(docs) AS support FROM placed GROUP BY leaf, place, token),
fields AS (
  SELECT leaf, place FROM supported WHERE place > 3
  GROUP BY leaf, place HAVING count(*) * count(*) > sum(support)),
usual AS (
  SELECT leaf, place, token FROM supported
  WHERE support >= 3 AND (leaf, place) NOT IN (SELECT (leaf, place) FROM fields)),
patterns AS (
  SELECT leaf, general, any_value(docs) AS docs, count(*) AS size,
         list({'place': place, 'token': token} ORDER BY place) FILTER (u.token IS NOT NULL) AS kept,
         count(u.token) FILTER (place > 3) AS beyond
  FROM placed LEFT JOIN usual u USING (leaf, place, token) GROUP BY leaf, general),
variant_templates AS (
  SELECT leaf, general,
         CASE WHEN len(kept) >= 0.7 * size AND beyond >= 2
              THEN {'whole': NULL::VARCHAR, 'kept': kept} ELSE {'whole': general, 'kept': NULL} END AS template
  FROM patterns WHERE (len(kept) >= 0.7 * size AND beyond >= 2) OR docs >= 3),
named AS (
  SELECT h.doc_id, h.text, h.nr, h.leaf, t.template, 3 AS needed
  FROM hot h JOIN variant_templates t USING (leaf, general)
  UNION ALL
  SELECT doc_id, text, nr, leaf, {'whole': general, 'kept': NULL} AS template, 2 AS needed
  FROM leaved WHERE len(tokens) >= 24),
recurring AS (
  SELECT leaf, template, needed, min(doc_id) AS first_doc FROM named GROUP BY leaf, template, needed
  HAVING count(DISTINCT doc_id) + bool_or(doc_id IS NULL)::int >= needed),
dropped AS (
  SELECT DISTINCT n.doc_id, n.text, n.nr FROM named n
  JOIN recurring r ON n.leaf = r.leaf AND n.template IS NOT DISTINCT FROM r.template AND n.needed = r.needed
  WHERE n.doc_id IS DISTINCT FROM r.first_doc),
rebuilt AS (
  SELECT d.doc_id, d.text,
         count(x.nr) AS n_dropped,
         string_agg(CASE WHEN x.nr IS NULL THEN l.line END, chr(10) ORDER BY l.nr) AS cleaned
  FROM (SELECT DISTINCT doc_id, text FROM documents) d
  JOIN (SELECT DISTINCT * FROM lines) l
    ON l.doc_id IS NOT DISTINCT FROM d.doc_id AND l.text = d.text
  LEFT JOIN dropped x
    ON x.doc_id IS NOT DISTINCT FROM d.doc_id AND x.text = d.text AND x.nr = l.nr
  GROUP BY d.doc_id, d.text)
SELECT d.doc_id, coalesce(r.n_dropped, 0) AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL
            WHEN r.n_dropped IS NULL OR r.n_dropped = 0 THEN d.text
            ELSE coalesce(r.cleaned, '') END AS text
FROM documents d
LEFT JOIN rebuilt r ON r.doc_id IS NOT DISTINCT FROM d.doc_id AND r.text = d.text
"""
