"""Decision bands over a score column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import labels as L
from .derive import band_from_top


def risk_level(score: str | Column = "risk_score") -> Column:
    """``>= 0.70`` high, ``>= 0.40`` medium, else low; null score -> null."""
    s = F.col(score) if isinstance(score, str) else score
    return band_from_top(s, L.RISK_LEVEL_BOUNDS, L.RISK_LEVEL_OTHER)
