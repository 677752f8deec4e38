"""Late data. The model is loaded in daily batches; nothing here is an unbounded stream."""

from roostline.streaming.late_data import (
    LOOKBACK_HOURS,
    WINDOW_DAYS,
    check_late_arrivals,
    reprocess_bound,
)

__all__ = ["LOOKBACK_HOURS", "WINDOW_DAYS", "check_late_arrivals", "reprocess_bound"]
