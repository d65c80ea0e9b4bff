"""Sums and averages whose result does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_sum(value: Column) -> Column:
    return F.sum(value).cast("decimal(20,2)")


def money_avg(value: Column) -> Column:
    """Mean as a double: the exact decimal sum over the number of present values."""
    return F.sum(value).cast("double") / F.count(value)
