"""Exact numeric helpers.

Prices and quantities travel as doubles but every sum is taken in
``decimal(18,6)`` (the scale of the at-rest tables), then cast to double once.
A decimal sum is exact, so any engine that sums the same values gets the same
double; summing doubles in a different order would not.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEC = "decimal(18,6)"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dec(x: Column | str) -> Column:
    return _c(x).cast(DEC)


def to_double(x: Column | str) -> Column:
    return _c(x).cast("double")


def dec_sum(x: Column | str) -> Column:
    """Aggregate: exact decimal sum (keep as decimal; cast at the end)."""
    return F.sum(dec(x))


def dec_mean(sum_col: Column, n_col: Column) -> Column:
    """double(sum) / n, NULL when n is 0."""
    return F.when(n_col > 0, sum_col.cast("double") / n_col.cast("double"))
