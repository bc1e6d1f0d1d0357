"""Published queries and report datasets over the semantic views.

Every report is one aggregate (partial aggregation map-side) over a semantic
view; the few analytic steps after it (share of total, share of the maximum)
run over the already-aggregated result, whose size is bounded by the number
of groups shown, never by the data.

Numeric conventions of the published outputs:

* money totals are decimals rounded to cents (``decimal(38,2)``: exact, and
  wide enough for any realistic total);
* rates and averages are doubles rounded the way Spark's ``round`` rounds;
* averages are plain means; only the published result is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import rounded_mean
from ..functions.columns import date_label, month_label, month_start, safe_ratio
from .semantic import MONEY_TOTAL

# Delivery buckets, checked in this order (first match wins).
DELIVERY_BUCKETS = (
    (-15, "15+ days early"),
    (-1, "1-14 days early"),
    (0, "On estimated date"),
    (7, "1-7 days late"),
)
LATE_BUCKET = "8+ days late"


def money_total(c: str) -> Column:
    return F.round(F.sum(c), 2).cast(MONEY_TOTAL)


def review_mean(c: str = "average_review_score") -> Column:
    """Mean to two decimals; rounding to nine first keeps exact halves from falling either way."""
    return F.round(rounded_mean(c, 9), 2)


def delivery_bucket(delay: Column) -> Column:
    expr = None
    for upper, label in DELIVERY_BUCKETS:
        expr = (F.when if expr is None else expr.when)(delay <= upper, F.lit(label))
    return expr.otherwise(F.lit(LATE_BUCKET))


def order_count(model, order_id: Column | str = "order_id") -> Column:
    """The orders among rows of order grain: a plain count where an order is one row, so that no order key is shuffled."""
    return F.count(order_id) if model.unique_orders else F.count_distinct(order_id)


# Q-01
def kpis(model) -> DataFrame:
    """One row: revenue, freight, orders, customers, review, on-time rate, AOV."""
    som = model.semantic_order_metrics
    revenue = F.round(F.sum("merchandise_revenue"), 2)
    orders = order_count(model)
    return som.agg(
        revenue.cast(MONEY_TOTAL).alias("merchandise_revenue"),
        money_total("freight_revenue").alias("freight_revenue"),
        orders.alias("orders"),
        F.count_distinct("customer_unique_id").alias("customers"),
        review_mean().alias("average_review_score"),
        F.round(F.avg("on_time_delivery_flag"), 4).alias("on_time_delivery_rate"),
        F.round(safe_ratio(revenue, orders), 2).cast(MONEY_TOTAL).alias("average_order_value"),
    )


# Q-02
def monthly_sales(model) -> DataFrame:
    """Item-grain revenue and orders per purchase month (itemless orders are absent)."""
    spm = model.semantic_product_values
    return (
        spm.groupBy("purchase_month")
        .agg(money_total("item_price").alias("merchandise_revenue"), F.count_distinct("order_id").alias("orders"))
        .select(month_label("purchase_month").alias("purchase_month"), "merchandise_revenue", "orders")
        .orderBy(F.col("purchase_month").asc_nulls_first())
    )


# Q-03
def top_categories(model, limit: int = 10, display_ascending: bool = False) -> DataFrame:
    """The ``limit`` categories with most item revenue (ties broken by name).

    ``display_ascending`` re-sorts the selected rows smallest first (for a
    horizontal bar chart); the selection itself is unchanged.
    """
    spm = model.semantic_product_values
    top = (
        spm.groupBy(F.col("product_category_name_english").alias("category"))
        .agg(money_total("item_price").alias("merchandise_revenue"), F.count_distinct("order_id").alias("orders"))
        .orderBy(F.col("merchandise_revenue").desc_nulls_last(), F.col("category").asc_nulls_last())
        .limit(limit)
    )
    if display_ascending:
        top = top.orderBy(F.col("merchandise_revenue").asc_nulls_first(), F.col("category").desc_nulls_first())
    return top


# Q-04
def state_performance(model) -> DataFrame:
    som = model.semantic_order_metrics
    return (
        som.groupBy(F.col("customer_state").alias("state"))
        .agg(
            money_total("merchandise_revenue").alias("merchandise_revenue"),
            order_count(model).alias("orders"),
            F.round(F.avg("on_time_delivery_flag"), 4).alias("on_time_delivery_rate"),
            review_mean().alias("average_review_score"),
        )
        .orderBy(F.col("merchandise_revenue").desc_nulls_last(), F.col("state").asc_nulls_last())
    )


# Q-05 / R-04
def delivery_distribution(model, delay_column: str = "delivery_delay_days_exact") -> DataFrame:
    """Delivered orders per delay bucket.

    ``delay_column`` is ``delivery_delay_days_exact`` (fractional days, the
    published variant) or ``delivery_delay_days`` (whole calendar days).
    """
    som = model.semantic_order_metrics
    delay = F.col(delay_column)
    return (
        som.where((F.col("order_status") == "delivered") & delay.isNotNull())
        .groupBy(delivery_bucket(delay).alias("delivery_bucket"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(F.col("orders").desc(), F.col("delivery_bucket"))
    )


# W-01
def top_categories_bars(model, limit: int = 10) -> DataFrame:
    """Top categories with a bar width: share of the largest value in percent, at least 2.

    The maximum is taken over the ``limit`` rows already selected, so the
    window runs over at most ``limit`` rows.
    """
    top = top_categories(model, limit)
    maximum = F.greatest(F.max("merchandise_revenue").over(Window.partitionBy()), F.lit(1))
    share = F.col("merchandise_revenue").cast("double") / maximum.cast("double") * 100
    return top.select(
        "category",
        "merchandise_revenue",
        "orders",
        F.greatest(F.lit(2), F.bround(share, 0).cast("int")).alias("bar_width"),
    )


# R-01
def monthly_orders(model) -> DataFrame:
    """Order-grain revenue and order count per month (itemless orders included)."""
    som = model.semantic_order_metrics
    return (
        som.groupBy("purchase_month")
        .agg(money_total("merchandise_revenue").alias("merchandise_revenue"), order_count(model).alias("orders"))
        .select(month_label("purchase_month").alias("purchase_month"), "merchandise_revenue", "orders")
    )


# R-02
def category_matrix(model) -> DataFrame:
    """Per category: item revenue, orders, AOV and the review score of those orders.

    Items are first reduced to one row per (category, order); order measures
    are joined to that, so an order with several items of a category counts
    once and no order measure is duplicated.
    """
    per_order = model.semantic_product_values.groupBy(
        F.col("product_category_name_english").alias("category"), "order_id"
    ).agg(F.sum("item_price").alias("category_revenue"))
    reviews = model.semantic_order_metrics.select("order_id", "average_review_score")
    joined = per_order.join(reviews, "order_id", "left")
    revenue = F.sum("category_revenue")
    orders = F.count(F.lit(1))
    return joined.groupBy("category").agg(
        F.round(revenue, 2).cast(MONEY_TOTAL).alias("merchandise_revenue"),
        orders.alias("orders"),
        F.round(safe_ratio(revenue, orders), 2).cast(MONEY_TOTAL).alias("average_order_value"),
        review_mean().alias("average_review_score"),
    )


# R-03
def seller_state_contribution(model) -> DataFrame:
    """Item revenue per seller state and its share of the total (window over the states)."""
    per_state = model.semantic_product_values.groupBy("seller_state").agg(
        F.sum("item_price").alias("revenue")
    )
    total = F.sum("revenue").over(Window.partitionBy())
    return per_state.select(
        "seller_state",
        F.round("revenue", 2).cast(MONEY_TOTAL).alias("merchandise_revenue"),
        F.round(F.col("revenue").cast("double") / total.cast("double"), 4).alias("revenue_share"),
    )


# R-05
def on_time_by_state(model) -> DataFrame:
    som = model.semantic_order_metrics
    return som.groupBy("customer_state").agg(
        order_count(model, F.when(F.col("on_time_delivery_flag").isNotNull(), F.col("order_id"))).alias(
            "evaluable_orders"
        ),
        F.round(F.avg("on_time_delivery_flag"), 4).alias("on_time_delivery_rate"),
    )


# R-06
def review_by_status_month(model) -> DataFrame:
    som = model.semantic_order_metrics
    return som.groupBy("order_status", "purchase_month").agg(
        F.count("average_review_score").alias("reviewed_orders"),
        review_mean().alias("average_review_score"),
    ).select("order_status", month_label("purchase_month").alias("purchase_month"),
             "reviewed_orders", "average_review_score")


# R-07
def data_as_of(model) -> DataFrame:
    return model.semantic_order_metrics.agg(F.max("purchase_date").alias("data_as_of"))


# R-08
def dim_date(model) -> DataFrame:
    """One row per day from the first to the last purchase date.

    Only the two bounds are aggregated; the day rows are generated from them,
    so the size is the length of the date range, not the data volume.
    """
    bounds = model.stg_orders.agg(F.min("purchase_date").alias("lo"), F.max("purchase_date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.dayofweek("date").alias("day_of_week"),
        month_label("date").alias("month_label"),
        date_label("date").alias("date_label"),
        month_start("date").alias("month_start"),
    )


# --- repeat customers and distributions --------------------------------------


def _orders_per_person(model) -> DataFrame:
    """``customer_unique_id, orders, merchandise_revenue``: one row for each known person.

    The first of two levels: orders are counted by person, combined map-side, so
    a person with a third of all orders is a row for each task.
    """
    som = model.semantic_order_metrics.where(F.col("customer_unique_id").isNotNull())
    return som.groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("merchandise_revenue").alias("revenue")
    )


def orders_per_customer(model) -> DataFrame:
    """How many people have placed how many orders, and what share of people, orders and revenue that is.

    Orders without a known person are left out. A person's ``customer_id`` rows
    count together.
    """
    per_count = _orders_per_person(model).groupBy(F.col("orders").alias("orders_per_customer")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue")
    )
    # One row for each number of orders: few, as their sum is at most the orders.
    every = Window.partitionBy()

    def share(c: str) -> Column:
        return F.round(F.col(c).cast("double") / F.nullif(F.sum(c).over(every).cast("double"), F.lit(0.0)), 4)

    return per_count.select(
        "orders_per_customer", "customers", "orders", F.round("revenue", 2).cast(MONEY_TOTAL).alias("merchandise_revenue"),
        share("customers").alias("customer_share"), share("orders").alias("order_share"), share("revenue").alias("revenue_share"),
    )


def repeat_customers(model) -> DataFrame:
    """One row: people, those with more than one order, their share, and their share of orders and revenue."""
    repeat = F.col("orders") > 1
    customers, orders, revenue = F.count(F.lit(1)), F.sum("orders"), F.sum("revenue")
    again = F.sum(F.when(repeat, F.col("revenue")))
    return _orders_per_person(model).agg(
        customers.alias("customers"),
        F.count_if(repeat).alias("repeat_customers"),
        F.round(safe_ratio(F.count_if(repeat).cast("double"), customers), 4).alias("repeat_share"),
        F.round(safe_ratio(orders.cast("double"), customers), 4).alias("orders_per_customer"),
        F.max("orders").alias("most_orders"),
        F.round(safe_ratio(F.sum(F.when(repeat, F.col("orders"))).cast("double"), orders), 4).alias("repeat_order_share"),
        F.round(safe_ratio(again.cast("double"), revenue.cast("double")), 4).alias("repeat_revenue_share"),
    )


def repeat_interval(model) -> DataFrame:
    """``months_between, customers``: how many calendar months pass between people's first and second month with an order.

    Months, not orders, are ranked: a person has few, whatever they order.
    """
    som = model.semantic_order_metrics.where(F.col("customer_unique_id").isNotNull() & F.col("purchase_month").isNotNull())
    months = som.groupBy("customer_unique_id").agg(F.array_sort(F.collect_set("purchase_month")).alias("months"))
    first, second = F.col("months")[0], F.get("months", F.lit(1))
    between = ((F.year(second) - F.year(first)) * 12 + F.month(second) - F.month(first)).alias("months_between")
    return months.where(F.size("months") > 1).groupBy(between).agg(F.count(F.lit(1)).alias("customers"))


def review_distribution(model) -> DataFrame:
    """``review_score, reviews, orders, review_share``; reviews without a score are a row of their own."""
    every = Window.partitionBy()
    scores = model.stg_order_reviews.groupBy("review_score").agg(
        F.count(F.lit(1)).alias("reviews"), F.count_distinct("order_id").alias("orders")
    )
    return scores.withColumn("review_share", F.round(F.col("reviews") / F.sum("reviews").over(every), 4))


def payment_distribution(model) -> DataFrame:
    """``payment_type, payments, orders, payment_value, value_share, average_installments``; a NULL type is a row."""
    every = Window.partitionBy()
    types = model.stg_order_payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payments"), F.count_distinct("order_id").alias("orders"), F.sum("payment_value").alias("value"),
        F.round(F.avg("payment_installments"), 4).alias("average_installments"),
    )
    share = F.col("value").cast("double") / F.nullif(F.sum("value").over(every).cast("double"), F.lit(0.0))
    return types.select(
        "payment_type", "payments", "orders", F.round("value", 2).cast(MONEY_TOTAL).alias("payment_value"),
        F.round(share, 4).alias("value_share"), "average_installments",
    )
