"""Column expressions shared by the plans; all of them stay inside the JVM."""

from roostline.functions.amenities import (
    amenity_flag,
    known_names,
    parse_amenities,
    resolve_alias,
    vocabulary,
    vocabulary_frame,
    widen,
)
from roostline.functions.dates import OPEN_END, date_key, is_weekend, weekday, years_between
from roostline.functions.keys import surrogate_key
from roostline.functions.numbers import (
    exact_average,
    exact_sum,
    pct_change,
    ratio,
    round_half_up,
    sample_stddev,
)

__all__ = [
    "OPEN_END",
    "amenity_flag",
    "date_key",
    "exact_average",
    "exact_sum",
    "is_weekend",
    "known_names",
    "parse_amenities",
    "pct_change",
    "ratio",
    "resolve_alias",
    "round_half_up",
    "sample_stddev",
    "surrogate_key",
    "vocabulary",
    "vocabulary_frame",
    "weekday",
    "widen",
    "years_between",
]
