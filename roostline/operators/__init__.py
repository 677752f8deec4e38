"""Reusable table operators."""

from roostline.operators.copies import expand_copies
from roostline.operators.intervals import (
    as_of_join,
    continuous_periods,
    islands,
    scd2_intervals,
)
from roostline.operators.ranking import dense_rank_by_value
from roostline.operators.running import running
from roostline.operators.skew import left_join_hot_right

__all__ = [
    "as_of_join",
    "continuous_periods",
    "dense_rank_by_value",
    "expand_copies",
    "islands",
    "left_join_hot_right",
    "running",
    "scd2_intervals",
]
