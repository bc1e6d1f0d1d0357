"""Key uniqueness proven once, when data is stored, and read by whoever would otherwise count keys again.

A proof belongs to one stored state of a table: it names the build that wrote
the table and how many rows it had. It is kept with the table, so replacing the
table drops it, and it does not hold for a table whose rows have changed since.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import key_table


class DuplicateKeyError(ValueError):
    """A key that must be unique is not."""


def prove_unique(df: DataFrame, keys: Sequence[str], label: str) -> int:
    """The rows of ``df``, after making sure that no complete key repeats; rows with a NULL in the key are no keys.

    The keys are counted in one shuffle, combined map-side.
    """
    counts = key_table(keys, parent=df)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    found = counts.agg(
        F.coalesce(F.sum("parent_rows"), F.lit(0)).alias("rows"), F.count_if(complete & (F.col("parent_rows") > 1)).alias("repeated")
    ).first()
    if found["repeated"]:
        raise DuplicateKeyError(f"duplicate key ({', '.join(keys)}) in {label}: {found['repeated']} keys repeat")
    return found["rows"]


def _property(key: str) -> str:
    return f"emporium.unique.{key}"


def record(spark: SparkSession, table: str, key: str, build_id: str, rows: int) -> None:
    """Keep with ``table`` that ``key`` was unique over its ``rows`` rows in build ``build_id``."""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_property(key)}' = '{build_id}:{rows}')")


def holds(spark: SparkSession, table: str, key: str) -> bool:
    """Whether ``table`` has a proof for ``key`` and still has as many rows as then.

    The rows are counted from the files' footers; no column is read.
    """
    value = spark.sql(f"SHOW TBLPROPERTIES {table} ('{_property(key)}')").first()["value"]
    build_id, _, rows = value.rpartition(":")
    return bool(build_id) and rows.isdigit() and spark.table(table).count() == int(rows)
