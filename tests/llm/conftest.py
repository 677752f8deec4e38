from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of given (doc_id, text) rows beside columns with clashing names."""

    def make(rows, partitions: int = 3):
        return spark.createDataFrame(
            [(i, t, "en", "src0", len(t or ""), f"x{n}") for n, (i, t) in enumerate(rows)],
            "doc_id bigint, text string, lang string, source string, n_chars bigint, blob string",
        ).repartition(partitions)

    return make
