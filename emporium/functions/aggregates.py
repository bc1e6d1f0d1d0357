"""Aggregate expressions used by the model (all built-ins with partial aggregation)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import _c


def sorted_distinct_list(c: Column | str, sep: str = ", ") -> Column:
    """Distinct non-null values, sorted, joined by ``sep``; an all-null group gives ''.

    ``collect_set`` combines map-side, so a group's partial state is bounded by
    its number of distinct values, not by its row count: for columns with a
    small domain (payment types), where no group can hold many.
    """
    return F.concat_ws(sep, F.sort_array(F.collect_set(_c(c))))


def rounded_mean(c: Column | str, digits: int) -> Column:
    """Plain mean of the values as they are; only the result is rounded.

    The last bits of a sum of doubles depend on the order partial sums meet in;
    rounding the result to fewer digits hides that.
    """
    return F.round(F.avg(_c(c)), digits)


def money_sum(c: Column | str) -> Column:
    """Sum of decimal(18,2) money, typed back to decimal(18,2)."""
    return F.sum(_c(c)).cast(T.DecimalType(18, 2))
