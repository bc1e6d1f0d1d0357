"""SQL entry points: parameterised queries and published-table checks."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, sql: str, **params: Any) -> DataFrame:
    """``spark.sql`` with named parameters (``:name`` markers, also in ``LIMIT``).

    Values are bound, never spliced into the text.
    """
    return spark.sql(sql, args=params or None)


class MissingTableError(LookupError):
    pass


def require_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Fail with one error naming every published table that does not exist."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise MissingTableError(
            "Published tables not found (build the warehouse first): " + ", ".join(missing)
        )
