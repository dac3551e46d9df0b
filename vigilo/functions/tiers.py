"""Tier, band and status columns over the scored profile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference.
# risk tiers: > 70 High, > 40 Medium, else Low (strict)
RISK_HIGH, RISK_MEDIUM = 70.0, 40.0
# fee tiers: 0.6 / 0.3 (strict online form, inclusive batch form)
FEE_HIGH, FEE_MEDIUM = 0.6, 0.3
# payment status labels, index = status code 0, 1, 2
STATUS_NAMES = ["On Time", "Late", "Default"]


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def risk_tier(risk: Column | str) -> Column:
    """High if risk > 70, Medium if > 40, else Low."""
    r = _c(risk)
    return (F.when(r > RISK_HIGH, "High").when(r > RISK_MEDIUM, "Medium").otherwise("Low"))


def fee_tier(prob: Column | str, inclusive: bool = False) -> Column:
    """Strict > 0.6 / > 0.3 -> High/Medium/Low, or inclusive >= -> HIGH/MEDIUM/LOW."""
    p = _c(prob)
    if inclusive:
        return F.when(p >= FEE_HIGH, "HIGH").when(p >= FEE_MEDIUM, "MEDIUM").otherwise("LOW")
    return F.when(p > FEE_HIGH, "High").when(p > FEE_MEDIUM, "Medium").otherwise("Low")


def overall_status(is_anomaly: Column | str, fee_label: Column | str, risk: Column | str) -> Column:
    """Critical if anomaly or default; At Risk if late or risk > 40; else Normal."""
    a, f, r = _c(is_anomaly), _c(fee_label), _c(risk)
    return (F.when(a | (f == 2), "Critical")
            .when((f == 1) | (r > RISK_MEDIUM), "At Risk")
            .otherwise("Normal"))


def attendance_band(rate_pct: Column | str) -> Column:
    """Attendance % >= 80 ok, >= 60 warn, else danger."""
    r = _c(rate_pct)
    return F.when(r >= 80, "ok").when(r >= 60, "warn").otherwise("danger")


def risk_band(risk: Column | str) -> Column:
    """Risk > 70 danger, > 40 warn, else ok."""
    r = _c(risk)
    return F.when(r > RISK_HIGH, "danger").when(r > RISK_MEDIUM, "warn").otherwise("ok")


def prob_band(prob_pct: Column | str) -> Column:
    """Default probability % > 60 danger, > 25 warn, else ok."""
    p = _c(prob_pct)
    return F.when(p > 60, "danger").when(p > 25, "warn").otherwise("ok")


def decode_status(code: Column | str) -> Column:
    """0/1/2 -> On Time / Late / Default; anything else -> NULL."""
    c = _c(code)
    return F.try_element_at(F.array(*[F.lit(s) for s in STATUS_NAMES]), c.cast("int") + 1)
