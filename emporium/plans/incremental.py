"""Incremental load by update time: the latest row of each key, in a partitioned Parquet table.

A load brings rows that are new or have changed. Only the partitions that its
keys live in are read and replaced (dynamic partition overwrite); all others
keep their files. Replacing a partition is not atomic, so the merged partitions
are first written to the shared folder under the load's id: a load that is
started again under the same id takes them from there and replaces the same
partitions by the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


class MovedKeyError(ValueError):
    """A key of a load lives in another partition of the table, or in several of the load."""


@dataclass(frozen=True)
class Load:
    """What a load did: ``partitions`` it replaced (values of the partition columns), rows in them now."""

    partitions: list[tuple]
    rows: int


def latest(rows: DataFrame, keys: Sequence[str], updated_at: str) -> DataFrame:
    """One row for each key: the one with the greatest ``updated_at``, NULL the least.

    Of rows that tie, the one whose other columns are greatest, so equal input
    in any order gives the same row. The greatest is kept map-side, so a key
    with most of the rows costs a row for each task. Rows that repeat are one;
    a NULL key is a key.
    """
    rest = [c for c in rows.columns if c not in keys and c != updated_at]
    grouped = rows.groupBy(*keys).agg(F.max(F.struct(updated_at, *rest)).alias("_latest"))
    return grouped.select(*[F.col(c) if c in keys else F.col("_latest")[c].alias(c) for c in rows.columns])


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame | None:
    """The table at ``path`` with the columns of ``like``; None where there is none yet.

    With ``like``, partition columns keep their types instead of being guessed
    from the folders' names.
    """
    try:
        reader = spark.read if like is None else spark.read.schema(like.schema)
        found = reader.parquet(path)
        return found if like is None else found.select(*like.columns)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise


def changed_since(source: DataFrame, target: DataFrame | None, updated_at: str) -> DataFrame:
    """The rows of ``source`` that a load has to bring: those updated at or after the target's latest update.

    The bound itself is included, as rows of one instant may come in two loads;
    bringing a row again changes nothing. Rows without an update time always
    come. The comparison is with a literal, so it reaches the scan.
    """
    # As text, which no time zone of the driver's Python changes.
    mark = target.agg(F.max(updated_at).cast("string")).first()[0] if target is not None else None
    if mark is None:
        return source
    return source.where((F.col(updated_at) >= F.lit(mark).cast(source.schema[updated_at].dataType)) | F.col(updated_at).isNull())


def _in_partitions(columns: Sequence[str], partitions: Sequence[tuple]) -> Column:
    """A condition on partition columns alone, so that only the files of ``partitions`` are listed and read."""
    if len(columns) == 1:
        column, values = F.col(columns[0]), [p[0] for p in partitions]
        found = column.isin([v for v in values if v is not None])
        return found | column.isNull() if None in values else found
    each = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, p)]) for p in partitions]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def _refuse_moved(updates: DataFrame, existing: DataFrame | None, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    place = updates.select(*keys, *partition_by).distinct()
    several = place.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if several.limit(1).count():
        raise MovedKeyError(f"a key of the load is in more than one partition by {list(partition_by)}")
    if existing is None:
        return
    here, there = place.alias("u"), existing.select(*keys, *partition_by).alias("t")
    same_key = reduce(lambda a, b: a & b, [F.col(f"u.`{k}`").eqNullSafe(F.col(f"t.`{k}`")) for k in keys])
    same_place = reduce(lambda a, b: a & b, [F.col(f"u.`{c}`").eqNullSafe(F.col(f"t.`{c}`")) for c in partition_by])
    if here.join(there, same_key & ~same_place, "left_semi").limit(1).count():
        raise MovedKeyError(f"a key of the load is in another partition of the table by {list(partition_by)}")


def merge_latest(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    updated_at: str,
    partition_by: Sequence[str],
    load_id: str,
    check_moves: bool = True,
) -> Load:
    """Bring ``updates`` into the table at ``path``: afterwards it has each key's latest row.

    ``partition_by`` must follow from the key (an order's purchase month, say);
    a load with a key that lives elsewhere raises :class:`MovedKeyError` before
    anything is written. The check reads the table's key columns; where the
    partition is computed from the key it may be left out. Older updates that
    arrive late lose against what is there. The same rows again, or the same
    ``load_id`` again, leave the table as it is; an empty load does nothing.
    The values of the touched partition columns pass through the driver.
    """
    spark = updates.sparkSession
    merged_path = f"{shared_dir(spark)}/merge-{hashlib.md5(path.encode()).hexdigest()}/{load_id}"
    if not _is_complete(spark, merged_path):
        existing = read_table(spark, path, updates)
        if check_moves:
            _refuse_moved(updates, existing, keys, partition_by)
        touched = [tuple(r) for r in updates.select(*partition_by).distinct().collect()]
        rows = updates
        if existing is not None and touched:
            rows = rows.unionByName(existing.where(_in_partitions(partition_by, touched)))
        latest(rows, keys, updated_at).write.mode("overwrite").parquet(f"{merged_path}/rows")
        _mark_complete(spark, merged_path)
    merged = spark.read.schema(updates.schema).parquet(f"{merged_path}/rows")
    partitions = merged.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_n")).collect()
    if partitions:
        (
            # A partition's rows go to as many files as its share of the shuffle asks for.
            merged.repartition(*partition_by, F.pmod(F.xxhash64(*keys), F.lit(_spread(spark, len(partitions)))))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
        )
    return Load(sorted((tuple(p)[:-1] for p in partitions), key=repr), sum(p["_n"] for p in partitions))


def _spread(spark: SparkSession, partitions: int) -> int:
    """Files for each partition, so that a single large one is still written by all tasks."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // partitions)


_MARK = "done boolean"


def _mark_complete(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([(True,)], _MARK).coalesce(1).write.mode("overwrite").parquet(f"{path}/complete")


def _is_complete(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.schema(_MARK).parquet(f"{path}/complete").count() > 0
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return False
        raise
