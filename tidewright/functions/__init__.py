"""Column expressions: clock, text and number helpers and the risk formulae."""

from tidewright.functions.risk import (
    LEVELS,
    RiskRules,
    alert_text,
    knots,
    risk_score,
    safety_level,
    speed,
    star_rating,
)
from tidewright.functions.scalars import (
    as_literal,
    clip_round,
    epoch_seconds,
    hours_between,
    json_field,
    local_time,
    minutes_since,
    parse_ts,
    run_context,
    tide_kind,
    truncate,
)

__all__ = [
    "LEVELS",
    "RiskRules",
    "alert_text",
    "as_literal",
    "clip_round",
    "epoch_seconds",
    "hours_between",
    "json_field",
    "knots",
    "local_time",
    "minutes_since",
    "parse_ts",
    "risk_score",
    "run_context",
    "safety_level",
    "speed",
    "star_rating",
    "tide_kind",
    "truncate",
]
