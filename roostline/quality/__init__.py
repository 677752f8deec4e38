from roostline.quality.checks import (
    SPECS,
    Check,
    FailedChecksError,
    accepted,
    checks_gate,
    measures,
    not_null,
    run_checks,
    unique,
)
from roostline.quality.gates import (
    FRESHNESS,
    StaleSourceError,
    freshness_gate,
    refresh_decision,
    schema_drift,
    source_freshness,
    verdict,
)

__all__ = [
    "FRESHNESS",
    "SPECS",
    "Check",
    "FailedChecksError",
    "StaleSourceError",
    "accepted",
    "checks_gate",
    "freshness_gate",
    "measures",
    "not_null",
    "refresh_decision",
    "run_checks",
    "schema_drift",
    "source_freshness",
    "unique",
    "verdict",
]
