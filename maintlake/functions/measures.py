"""Small aggregate expressions shared by rollups, quality checks and named queries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HOURS_PER_YEAR = 8760.0


def total(c: Column | str) -> Column:
    """Sum that is 0 for an empty group."""
    return F.coalesce(F.sum(c), F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """True division as double; null where the denominator is 0 or null."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * F.lit(100.0), whole)


def completeness(c: Column | str) -> Column:
    """Share of rows with a value, in percent."""
    return percent(F.count(c), F.count(F.lit(1)))


def mtbf_proxy_hours(assets: Column, failures: Column) -> Column:
    """Operating hours of a year per failure; null without failures."""
    return ratio(F.lit(HOURS_PER_YEAR) * assets, failures)
