"""Scoring-output expressions: rounding, risk/confidence tiers, flight label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.schema import (CONFIDENCE_HIGH_FROM, CONFIDENCE_MEDIUM_FROM,
                           RISK_LOW_BELOW, RISK_MEDIUM_BELOW)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round4(x) -> Column:
    """4-decimal rounding used for every published metric and probability."""
    return F.bround(_c(x).cast("double"), 4)


def risk_level(p="delay_probability") -> Column:
    p = _c(p)
    return (F.when(p < RISK_LOW_BELOW, "LOW")
             .when(p < RISK_MEDIUM_BELOW, "MEDIUM").otherwise("HIGH"))


def confidence_level(p="delay_probability") -> Column:
    dist = F.abs(_c(p) - 0.5)
    return (F.when(dist >= CONFIDENCE_HIGH_FROM, "HIGH")
             .when(dist >= CONFIDENCE_MEDIUM_FROM, "MEDIUM").otherwise("LOW"))


def flight_label(origin="ORIGIN", dest="DEST", carrier="OP_CARRIER") -> Column:
    """``"{ORIGIN}-{DEST} {OP_CARRIER}"``."""
    return F.concat(_c(origin), F.lit("-"), _c(dest), F.lit(" "), _c(carrier))
