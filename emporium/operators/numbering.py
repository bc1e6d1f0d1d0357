"""Row number within a group that stays parallel when one group is huge.

``row_number() over (partition by k order by o)`` sends every row of a key to
one task. Here the rows are range-partitioned on the full sort order instead,
so a key with a large share of the table spreads over many partitions. A range
partitioning samples its own bounds each time it runs, so the ranged rows are
stored once, each with its partition and its place there; every count is then
taken from those stored rows and agrees with them, whatever the optimizer
reuses. A row's number is its place among its key's rows of the same partition
plus the key's rows in the partitions before. NULL is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

_PARTITION_BITS = 33  # monotonically_increasing_id keeps the partition index above bit 33


def number_within(df: DataFrame, key: str, order: Sequence[str], out: str, partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position (bigint) of each row within ``key`` ordered by ``order``, NULLs first.

    Rows that tie in ``order`` are numbered by their other columns (a hash of them first). ``df`` is
    shuffled into ``partitions`` ranges (default: the session's shuffle
    partitions) and written to the shared folder when this is called. The join
    is on the partition and the key, so a key that spans partitions stays
    spread; with few keys its counts are small and the planner broadcasts them.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c != key and c not in order]
    # Sorted on every column, so equal rows alone can change places. The ranges
    # themselves are cut by key, order and a hash of the rest: the bounds that
    # the driver samples stay narrow, and rows that tie in order still spread.
    ranges: list[Column] = [F.col(c).asc_nulls_first() for c in [key, *order]]
    if rest:
        ranges.append(F.xxhash64(*rest).asc())
    place = F.monotonically_increasing_id()
    ranged = stored(
        df.repartitionByRange(n, *ranges)
        .sortWithinPartitions(*ranges, *[F.col(c).asc_nulls_first() for c in rest])
        .withColumn("_place", place)
        .withColumn("_part", F.shiftright(F.col("_place"), _PARTITION_BITS).cast("int")),
        "ranged",
    )
    # Places of one partition share their upper bits, so differences within a key's rows count rows.
    found = ranged.groupBy(F.col("_part").alias("_p"), F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    before = Window.partitionBy("_key").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = found.select("_p", "_key", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        ranged.join(starts, (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_key")))
        .withColumn(out, F.col("_place") - F.col("_first") + F.col("_before") + 1)
        .select(*df.columns, out)
    )
