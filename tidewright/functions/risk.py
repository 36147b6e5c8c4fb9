"""Sea-state formulae: speeds, risk score, safety level, alert text, tide stars."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit factor, weights, thresholds and labels that results must agree on.
MS_TO_KNOTS = 1.94384
LEVELS = {"danger": "PELIGRO", "caution": "PRECAUCION", "safe": "SEGURO"}
ALERTS = {
    "wave": "Oleaje alto",
    "wind": "Viento fuerte",
    "danger": "Condiciones riesgosas",
    "caution": "Precaucion recomendada",
}
STARS = ((2.0, 3), (1.0, 2), (0.5, 2))


@dataclass(frozen=True)
class RiskRules:
    """Weights and thresholds of the risk model."""

    wave_weight: float = 10.0
    current_weight: float = 5.0
    low_visibility_km: float = 2.0
    low_visibility_penalty: float = 20.0
    clear_visibility_km: float = 100.0
    danger_score: float = 40.0
    caution_score: float = 20.0
    danger_wave_m: float = 2.5
    danger_wind_kn: float = 25.0
    danger_visibility_km: float = 1.0


RULES = RiskRules()


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def _known(value, default: float) -> Column:
    return F.coalesce(_column(value), F.lit(default))


def knots(ms) -> Column:
    """Metres per second to knots."""
    return _column(ms) * F.lit(MS_TO_KNOTS)


def speed(u, v, null_component: float | None = None) -> Column:
    """Length of a current vector. A missing component gives NULL, or counts as ``null_component`` when one is given."""
    parts = [_column(u), _column(v)]
    if null_component is not None:
        parts = [_known(p, null_component) for p in parts]
    east, north = parts
    return F.sqrt(east * east + north * north)


def risk_score(wave_m, wind_kn, current_ms, visibility_km, rules: RiskRules = RULES) -> Column:
    """Weighted sum of wave, wind and current plus a penalty for low visibility; missing terms add nothing."""
    foggy = _known(visibility_km, rules.clear_visibility_km) < rules.low_visibility_km
    return (
        _known(wave_m, 0.0) * F.lit(rules.wave_weight)
        + _known(wind_kn, 0.0)
        + _known(current_ms, 0.0) * F.lit(rules.current_weight)
        + F.when(foggy, F.lit(rules.low_visibility_penalty)).otherwise(F.lit(0.0))
    )


def safety_level(
    score,
    wave_m=None,
    wind_kn=None,
    visibility_km=None,
    variant: str = "current",
    rules: RiskRules = RULES,
) -> Column:
    """Three-step safety level.

    ``current`` escalates on wave, wind and visibility before looking at the score, ``features`` on
    visibility only, ``prediction`` uses the score alone. Thresholds are inclusive.
    """
    points = _column(score)
    escalate = F.lit(False)
    if variant == "current":
        escalate = (
            (_known(wave_m, 0.0) >= rules.danger_wave_m)
            | (_known(wind_kn, 0.0) >= rules.danger_wind_kn)
            | (_known(visibility_km, rules.clear_visibility_km) < rules.danger_visibility_km)
        )
    elif variant == "features":
        escalate = _known(visibility_km, rules.clear_visibility_km) < rules.danger_visibility_km
    elif variant != "prediction":
        raise ValueError(f"unknown safety level variant: {variant}")
    return (
        F.when(escalate | (points >= rules.danger_score), F.lit(LEVELS["danger"]))
        .when(points >= rules.caution_score, F.lit(LEVELS["caution"]))
        .otherwise(F.lit(LEVELS["safe"]))
    )


def alert_text(score, wave_m, wind_kn, rules: RiskRules = RULES) -> Column:
    """The most specific reason for caution, or NULL when there is none."""
    points = _column(score)
    reasons = [
        (_known(wave_m, 0.0) >= rules.danger_wave_m, "wave"),
        (_known(wind_kn, 0.0) >= rules.danger_wind_kn, "wind"),
        (points >= rules.danger_score, "danger"),
        (points >= rules.caution_score, "caution"),
    ]
    return F.coalesce(*[F.when(holds, F.lit(ALERTS[name])) for holds, name in reasons])


def star_rating(amplitude) -> Column:
    """Stars for a day's tidal amplitude; an unknown amplitude gets one star."""
    height = _column(amplitude)
    return F.coalesce(*[F.when(height >= floor, F.lit(stars)) for floor, stars in STARS], F.lit(1))
