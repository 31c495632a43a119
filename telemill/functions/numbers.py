"""Counting and division with pinned NULL behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_if(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is NULL)."""
    return F.when(condition, 1).otherwise(0)


def sum_if(condition: Column) -> Column:
    """Rows meeting the condition; NULL over no rows at all, like SUM(CASE ..)."""
    return F.sum(one_if(condition))


def ratio(top: Column, bottom: Column) -> Column:
    """NULL on a zero denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def percent(top: Column, bottom: Column, digits: int) -> Column:
    return F.round(ratio(top * 100.0, bottom), digits)


def add(a: Column, b: Column) -> Column:
    return a + b


def subtract(a: Column, b: Column) -> Column:
    return a - b


def multiply(a: Column, b: Column) -> Column:
    return a * b


def divide(a: Column, b: Column) -> Column:
    """Raises on a zero divisor, whatever the ANSI setting is."""
    checked = F.when(b == 0, F.raise_error(F.lit("Cannot divide by zero")).cast("double"))
    return checked.otherwise(F.try_divide(a.cast("double"), b.cast("double")))
