"""Freshness and volume of the tables, as result rows.

A table's volume is its rows for each day of a timestamp, days without rows
included. A day is compared with the mean of the days before it; nothing here
needs more than the days themselves once they are counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import RESULT_COLUMNS


@dataclass(frozen=True)
class Monitored:
    """A table to watch: rows are counted by the day of ``timestamp``, the latest of which may be ``max_age_days`` old."""

    table: str
    timestamp: str
    max_age_days: int = 2


#: The staged tables that grow by the day. The item rows are read without their number.
MONITORED = (
    Monitored("stg_orders", "order_purchase_timestamp"),
    Monitored("stg_order_item_values", "shipping_limit_date", 30),
    Monitored("stg_order_reviews", "review_creation_timestamp"),
)

_EPOCH = "1970-01-01"


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def daily_volume(model, monitored: Sequence[Monitored] = MONITORED) -> DataFrame:
    """``table, day, rows``: every day from a table's first to its last, 0 where it has no rows.

    Rows without a timestamp have no day and are not counted. A table without
    any has no days.
    """
    counted = _union([
        model.table(m.table).where(F.col(m.timestamp).isNotNull()).groupBy(F.to_date(m.timestamp).alias("day"))
        .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(m.table).alias("table"), "day", "rows")
        for m in monitored
    ])
    bounds = counted.groupBy("table").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    days = bounds.select("table", F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day"))
    return days.join(counted, ["table", "day"], "left").select("table", "day", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


def volume_anomalies(
    model,
    monitored: Sequence[Monitored] = MONITORED,
    trailing_days: int = 28,
    min_history: int = 7,
    low: float = 0.5,
    high: float = 2.0,
) -> DataFrame:
    """``table, day, rows, history_days, trailing_mean, ratio, anomaly`` of every day.

    The trailing mean is over the ``trailing_days`` days before the day, as far
    as the table goes back (``history_days``). A day is an anomaly (``low`` or
    ``high``) when its rows are under ``low`` or over ``high`` times that mean;
    with less than ``min_history`` days before it, or a mean of zero, it is none.
    """
    day = F.datediff("day", F.lit(_EPOCH).cast("date"))
    before = Window.partitionBy("table").orderBy("day_number").rangeBetween(-trailing_days, -1)
    framed = daily_volume(model, monitored).withColumn("day_number", day).select(
        "table", "day", "rows", F.count(F.lit(1)).over(before).alias("history_days"), F.avg("rows").over(before).alias("mean")
    )
    ratio = F.col("rows") / F.nullif(F.col("mean"), F.lit(0.0))
    judged = F.col("history_days") >= min_history
    return framed.select(
        "table", "day", "rows", "history_days",
        F.round("mean", 4).alias("trailing_mean"), F.round(ratio, 4).alias("ratio"),
        F.when(judged & (ratio < low), "low").when(judged & (ratio > high), "high").alias("anomaly"),
    )


def freshness(model, monitored: Sequence[Monitored] = MONITORED, as_of: Column | None = None) -> DataFrame:
    """``table, rows, latest, as_of, age_days, max_age_days, fresh`` of every table.

    ``as_of`` is the day of reference: the current one in operation, by default
    the latest day in any of the tables, which makes the result follow from the
    data. A table without a timestamp is not fresh; one that is ahead of the
    reference has a negative age and is.
    """
    seen = _union([
        model.table(m.table).agg(F.count(F.lit(1)).alias("rows"), F.to_date(F.max(m.timestamp)).alias("latest"))
        .select(F.lit(m.table).alias("table"), "rows", "latest", F.lit(m.max_age_days).alias("max_age_days"))
        for m in monitored
    ])
    # One row for each monitored table, whatever their size.
    reference = F.max("latest").over(Window.partitionBy()) if as_of is None else as_of
    dated = seen.withColumn("as_of", reference.cast("date"))
    age = F.datediff("as_of", "latest")
    return dated.select(
        "table", "rows", "latest", "as_of", age.alias("age_days"), "max_age_days",
        F.coalesce(age <= F.col("max_age_days"), F.lit(False)).alias("fresh"),
    )


def monitoring_checks(
    model, monitored: Sequence[Monitored] = MONITORED, as_of: Column | None = None, severity: str = "warning", **volume
) -> DataFrame:
    """Two check rows for each table, in the shape of the quality checks: its freshness, and the volume of its last day."""
    order = F.array_position(F.array(*[F.lit(m.table) for m in monitored]), F.col("table"))
    fresh = freshness(model, monitored, as_of).select(
        (2 * order - 1).cast("int").alias("check_order"), F.concat(F.lit("freshness_"), "table").alias("name"),
        F.col("fresh").alias("passed"), F.lit(severity).alias("severity"), F.lit("Age of the latest row in days").alias("details"),
        F.to_json(F.struct("latest", "age_days", "max_age_days")).alias("observed"),
    )
    days = volume_anomalies(model, monitored, **volume)
    last = days.groupBy("table").agg(F.max_by(F.struct("day", "rows", "trailing_mean", "anomaly"), "day").alias("d"))
    tables = model.spark.createDataFrame([(m.table,) for m in monitored], "table string")
    volumes = tables.join(last, "table", "left").select(
        (2 * order).cast("int").alias("check_order"), F.concat(F.lit("volume_"), "table").alias("name"),
        (F.col("d").isNotNull() & F.col("d.anomaly").isNull()).alias("passed"), F.lit(severity).alias("severity"),
        F.lit("Rows of the last day against the mean of the days before").alias("details"),
        F.to_json(F.struct("d.day", "d.rows", "d.trailing_mean", "d.anomaly")).alias("observed"),
    )
    return fresh.unionByName(volumes).select("check_order", *RESULT_COLUMNS)
