"""The stages of the corpus pipeline: each calls one operator and acts on its decisions.

All but the last return the columns of ``documents``. A row of the input is kept or dropped
as a whole row, so repeated rows and rows without a doc_id are treated like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.functions.amenities import quoted
from roostline.llm.common import fresh_name, table, written
from roostline.llm.line_templates import line_dedup
from roostline.llm.packing import pack as pack_documents
from roostline.llm.secrets import scan
from roostline.llm.signature_trees import one_per_group
from roostline.llm.toxicity import fit, score_rows
from roostline.session import scratch_dir, scratch_scope


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer, learned from the labels of these documents, does not reject."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    score = fresh_name(docs, "_score")
    return score_rows(docs, model, score).filter(F.col(score) < 0.5).drop(score)


def remove_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their recurring lines; those that had nothing else go. Lines that
    differ in a word of their own are not taken for one template by their leading words alone."""
    dropped = fresh_name(docs, "_n_dropped")
    cleaned = line_dedup(docs, dropped)
    emptied = (F.col(dropped) > 0) & (F.trim(F.translate("text", "\n\t\r", "   ")) == "")
    return cleaned.filter(~emptied | F.col("text").isNull()).select(
        *[F.length("text").cast("bigint").alias(c) if c == "n_chars" else quoted(c) for c in docs.columns]
    )


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones. Documents without words stay."""
    return one_per_group(docs)


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any secret."""
    blob = fresh_name(docs, "_blob")
    with scratch_scope(spark) as keep:
        found = scan(spark, docs.select("doc_id", "text"), scratch_dir(spark, "secret-ledger"))
        leaks = found.filter(F.size("spans") > 0).select(F.col("blob").alias(f"{blob}_of")).distinct()
        leaking = keep(written(leaks, "leaking-blobs"))
    keyed = docs.withColumn(blob, F.sha2(F.coalesce("text", F.lit("")), 256))
    return keyed.join(leaking, F.col(blob) == F.col(f"{blob}_of"), "left_anti").drop(blob)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids, sequences and offsets."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
