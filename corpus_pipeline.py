"""The training-data pipeline: stages over ``documents``, each written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roostline.llm.common import table, written
from roostline.llm.stages import (
    drop_secrets,
    drop_toxic,
    one_of_each_group,
    pack,
    remove_recurring_lines,
)

STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", remove_recurring_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("secret_scans", drop_secrets),
    ("packing", pack),
]

# Learned scores and encoded ids have no SQL form; tests hold the stages against plain ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
