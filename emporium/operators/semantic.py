"""Semantic layer: narrow views over the facts and a governed metric catalogue.

A metric query is one ``groupBy(dimensions).agg(measures)`` over the semantic
model that owns the measures. The catalogue refuses a dimension the model
does not carry, which is what keeps an order-grain measure from being summed
after a fan-out to item grain.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions.aggregates import rounded_mean
from ..functions.columns import safe_ratio

#: Money totals: exact decimals, wide enough for any realistic total.
MONEY_TOTAL = T.DecimalType(38, 2)

SEMANTIC_ORDER_COLUMNS = (
    "order_id",
    "customer_unique_id",
    "customer_state",
    "order_status",
    "purchase_date",
    "purchase_month",
    "merchandise_revenue",
    "freight_revenue",
    "order_total_value",
    "item_count",
    "average_review_score",
    "delivery_days",
    "delivery_delay_days",
    "delivery_delay_days_exact",
    "on_time_delivery_flag",
)

SEMANTIC_PRODUCT_COLUMNS = (
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "purchase_date",
    "purchase_month",
    "product_category_name_english",
    "seller_state",
    "item_price",
    "freight_value",
    "item_total_value",
)


def semantic_order_metrics(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.select(*SEMANTIC_ORDER_COLUMNS)


def semantic_product_metrics(fct_order_items: DataFrame) -> DataFrame:
    """The item view; over rows without the item number, the view without it."""
    present = set(fct_order_items.columns)
    return fct_order_items.select(*[c for c in SEMANTIC_PRODUCT_COLUMNS if c != "order_item_id" or c in present])


@dataclass(frozen=True)
class Measure:
    name: str
    build: Callable[[], Column]
    description: str

    def column(self) -> Column:
        return self.build().alias(self.name)


@dataclass(frozen=True)
class SemanticModel:
    name: str
    relation: str  # attribute of the model holding the view
    grain: str
    dimensions: tuple[str, ...]
    measures: Mapping[str, Measure] = field(default_factory=dict)


def _sum(c: str) -> Callable[[], Column]:
    return lambda: F.sum(c).cast(MONEY_TOTAL)


def _distinct(c: str) -> Callable[[], Column]:
    return lambda: F.count_distinct(c)


def _measures(*ms: Measure) -> dict[str, Measure]:
    return {m.name: m for m in ms}


ORDER_METRICS = SemanticModel(
    name="order_metrics",
    relation="semantic_order_metrics",
    grain="one row per order_id",
    dimensions=("purchase_month", "order_status", "customer_state", "customer_unique_id"),
    measures=_measures(
        Measure("merchandise_revenue", _sum("merchandise_revenue"), "sum() of the order fact's merchandise_revenue; NULL when no order has items."),
        Measure("freight_revenue", _sum("freight_revenue"), "sum() of the order fact's freight_revenue."),
        Measure(
            "order_total_value",
            lambda: (F.sum("merchandise_revenue") + F.sum("freight_revenue")).cast(MONEY_TOTAL),
            "The two sums above, added after summing.",
        ),
        Measure("orders", _distinct("order_id"), "count(distinct order_id)."),
        Measure("customers", _distinct("customer_unique_id"), "count(distinct customer_unique_id): a person with several customer_id values counts once."),
        Measure(
            "average_order_value",
            lambda: safe_ratio(F.sum("merchandise_revenue").cast("double"), F.count_distinct("order_id")),
            "The revenue sum as a double over the order count; NULL for no orders.",
        ),
        Measure(
            "on_time_delivery_rate",
            lambda: F.avg("on_time_delivery_flag"),
            "avg() of the 0/1 on-time flag; orders whose flag is NULL do not enter.",
        ),
        Measure(
            "average_review_score",
            lambda: rounded_mean("average_review_score", 9),
            "Every reviewed order counts once: avg() over the per-order mean scores, rounded to 9 decimals.",
        ),
        Measure(
            "late_delivery_orders",
            lambda: F.count_distinct(F.when(F.col("on_time_delivery_flag") == 0, F.col("order_id"))),
            "count(distinct order_id) where the on-time flag is 0.",
        ),
    ),
)

PRODUCT_METRICS = SemanticModel(
    name="product_metrics",
    relation="semantic_product_metrics",
    grain="one row per order_id and order_item_id",
    dimensions=("purchase_month", "product_category_name_english", "seller_state"),
    measures=_measures(
        Measure("item_merchandise_revenue", _sum("item_price"), "sum() of item_price over item rows."),
        Measure("item_freight_revenue", _sum("freight_value"), "sum() of freight_value over item rows."),
        Measure("item_count", lambda: F.count("order_item_id"), "Item rows with an order_item_id."),
    ),
)

CATALOGUE: dict[str, SemanticModel] = {m.name: m for m in (ORDER_METRICS, PRODUCT_METRICS)}


class MetricError(ValueError):
    pass


def metric_query(
    model,
    semantic_model: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Column | str | None = None,
) -> DataFrame:
    """``measures`` of ``semantic_model`` grouped by ``by`` (none = one total row).

    ``model`` is a :class:`emporium.plans.model.Model`; ``where`` filters rows
    before aggregation (slicers) and is pushed to the scan when it can be.
    """
    if semantic_model not in CATALOGUE:
        raise MetricError(f"unknown semantic model {semantic_model!r}")
    sm = CATALOGUE[semantic_model]
    unknown = [m for m in measures if m not in sm.measures]
    if unknown:
        raise MetricError(f"{semantic_model} has no measure {unknown}")
    bad_dims = [d for d in by if d not in sm.dimensions]
    if bad_dims:
        raise MetricError(
            f"{semantic_model} cannot be grouped by {bad_dims}; allowed: {list(sm.dimensions)}"
        )
    df = getattr(model, sm.relation)
    if where is not None:
        df = df.where(where)
    aggs = [sm.measures[m].column() for m in measures]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
