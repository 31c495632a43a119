"""Severity and status ladders. The cut-offs are parameters with fixed defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def score_severity(score: Column, critical: float = 0.8, warning: float = 0.5) -> Column:
    return F.when(score >= critical, "CRITICAL").when(score >= warning, "WARNING").otherwise("LOW")


def rate_severity(rate: Column, threshold: float = 0.10) -> Column:
    return F.when(rate >= 2 * threshold, "critical").when(rate >= threshold, "warning").otherwise("info")


def rate_status(rate: Column, threshold: float = 0.10) -> Column:
    return F.when(rate >= threshold, "Elevated").otherwise("Normal")


def alert_status(rate_pct: Column, critical: float = 10.0, warning: float = 5.0) -> Column:
    return F.when(rate_pct >= critical, "CRITICAL").when(rate_pct >= warning, "WARNING").otherwise("NORMAL")


def temperature_status(peak: Column, high: float = 100.0, elevated: float = 85.0) -> Column:
    return F.when(peak > high, "HIGH").when(peak > elevated, "ELEVATED").otherwise("NORMAL")
