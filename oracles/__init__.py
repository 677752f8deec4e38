"""Reference SQL for the registered queries, in DuckDB's dialect.

The SQL follows the textbook shape of each table (row numbers, range joins, self joins,
direct distinct counts), not the plan the library uses, so that the two sides can disagree.
"""

from oracles.lodging import ORACLES

__all__ = ["ORACLES"]
