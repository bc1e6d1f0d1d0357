"""Metric snapshot and quality report as single JSON documents (one row each).

Each array is built from an already-small report (at most a few hundred
rows: months, ten categories, eight states, five buckets) and sorted
explicitly, because ``collect_list`` keeps no order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality, reports

JSON_OPTIONS = {"ignoreNullFields": "false"}


def _desc_then_asc(value: str, label: str):
    def compare(left: Column, right: Column) -> Column:
        return (
            F.when(left[value] > right[value], -1)
            .when(left[value] < right[value], 1)
            .when(left[label] < right[label], -1)
            .when(left[label] > right[label], 1)
            .otherwise(0)
        )

    return compare


def _records(df: DataFrame, name: str, compare=None) -> DataFrame:
    rows = F.collect_list(F.struct(*df.columns))
    arr = F.array_sort(rows, compare) if compare else F.sort_array(rows)
    return df.agg(arr.alias(name))


def metric_snapshot(model, states: int = 8) -> DataFrame:
    """One row, column ``snapshot``: KPIs and the four published lists."""
    kpis = reports.kpis(model).select(F.struct("*").alias("kpis"))
    monthly = _records(reports.monthly_sales(model), "monthly_sales")
    top = _records(
        reports.top_categories(model), "top_categories", _desc_then_asc("merchandise_revenue", "category")
    )
    top_states = _records(
        reports.state_performance(model).limit(states),
        "state_performance",
        _desc_then_asc("merchandise_revenue", "state"),
    )
    delivery = _records(
        reports.delivery_distribution(model), "delivery_distribution", _desc_then_asc("orders", "delivery_bucket")
    )
    # Five one-row frames side by side: the product has exactly one row.
    one = kpis.crossJoin(monthly).crossJoin(top).crossJoin(top_states).crossJoin(delivery)
    return one.select(F.to_json(F.struct(*one.columns), JSON_OPTIONS).alias("snapshot"))


def _listed(checks: DataFrame, name: str) -> DataFrame:
    """One row, one column: the check rows in their order."""
    rows = F.sort_array(F.collect_list(F.struct("check_order", *quality.RESULT_COLUMNS)))
    return checks.agg(F.transform(rows, lambda c: c.dropFields("check_order")).alias(name))


def quality_report(checks: DataFrame, **more: DataFrame) -> DataFrame:
    """One row, column ``report``: the verdict fields of ``checks`` and their ordered list.

    ``more`` names further check rows that the gate judges: each is listed
    under its name, and ``gate`` is the verdict over all of them together, so a
    gate that has failed is explained by the report.
    """
    one = quality.verdict(checks).crossJoin(_listed(checks, "checks"))
    if more:
        judged = reduce(DataFrame.unionByName, [c.select(*quality.RESULT_COLUMNS) for c in (checks, *more.values())])
        for name, rows in more.items():
            one = one.crossJoin(_listed(rows, name))
        one = one.crossJoin(quality.verdict(judged).select(F.struct("*").alias("gate")))
    return one.select(F.to_json(F.struct(*one.columns), JSON_OPTIONS).alias("report"))
