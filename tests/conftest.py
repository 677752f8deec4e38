from __future__ import annotations

import datetime
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from roostline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4",
        "roostline-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def own_views(spark):
    """Views that one module leaves in the session would show in the catalog of the next ones."""
    yield
    for table in spark.catalog.listTables():
        if table.isTemporary:
            spark.catalog.dropTempView(table.name)


@pytest.fixture(scope="session")
def day():
    return datetime.date.fromisoformat


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples of the named columns."""

    def collect(df, *columns):
        picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=str)

    return collect
