"""Marts: the four dimensions and the two facts of the star schema.

Plan shape, with scale in mind:

* Dimensions are joined as grouped, unique rows (``joins.unique_by``): a
  repeated key fails the query, and a join whose columns are not used is
  dropped by the optimizer. Whether a side is broadcast is left to Spark's
  size checks; products, sellers and customers grow with the data.
* A repeated order fails every query over the facts. The price is a shuffle of
  the order keys, and that filters on order columns stay above it.
* ``fct_orders`` pre-aggregates items, payments and reviews to one row per
  order before joining, so no order measure fans out. The four inputs are all
  hash-partitioned on ``order_id`` and join without further shuffles; the
  customer lookup (a different key) comes last.
* Every aggregate here has a map-side partial step, so a hot order or zip
  prefix is combined before it crosses the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import money_sum, rounded_mean, sorted_distinct_list
from ..functions.columns import fractional_days, money, when_both_present, whole_days
from .joins import guarded_join, require_unique


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def dim_sellers(stg_sellers: DataFrame) -> DataFrame:
    return stg_sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def dim_products(stg_products: DataFrame, stg_category_translation: DataFrame) -> DataFrame:
    translated = guarded_join(
        stg_products,
        stg_category_translation,
        "product_category_name",
        how="left",
        validate="many_to_one",
        label="category translation",
    )
    return translated.select(
        "product_id",
        "product_category_name",
        F.coalesce(F.col("product_category_name_english"), F.lit("unknown")).alias(
            "product_category_name_english"
        ),
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def dim_geography(stg_geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix (a NULL prefix is kept as its own group).

    Coordinates are plain means rounded to 8 decimals (about a millimetre);
    the representative city/state is the smallest value, which is
    deterministic on a cluster.
    """
    return stg_geolocation.groupBy("geolocation_zip_code_prefix").agg(
        rounded_mean("geolocation_lat", 8).alias("latitude"),
        rounded_mean("geolocation_lng", 8).alias("longitude"),
        F.min("geolocation_city").alias("representative_city"),
        F.min("geolocation_state").alias("representative_state"),
        F.count(F.lit(1)).alias("source_observation_count"),
    )


# The published columns of the item fact, in order.
FCT_ORDER_ITEMS_COLUMNS = (
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "purchase_date",
    "purchase_month",
    "product_category_name_english",
    "seller_state",
    "item_price",
    "freight_value",
    "item_total_value",
    "shipping_limit_date",
)


def fct_order_items(
    stg_order_items: DataFrame,
    stg_orders: DataFrame,
    dim_products_df: DataFrame,
    dim_sellers_df: DataFrame,
    orders_proven: bool = False,
) -> DataFrame:
    """One row per item row; the item number is left out where the input has none.

    ``orders_proven``: no order repeats, which has been made sure of before.
    """
    orders = stg_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "purchase_date",
        "purchase_month",
    )
    products = dim_products_df.select("product_id", "product_category_name_english")
    sellers = dim_sellers_df.select("seller_id", "seller_state")
    if orders_proven:
        joined = stg_order_items.join(orders, "order_id", "left")
    else:
        joined = guarded_join(stg_order_items, orders, "order_id", label="items to orders")
    joined = guarded_join(joined, products, "product_id", label="items to products")
    joined = guarded_join(joined, sellers, "seller_id", label="items to sellers")
    enriched = joined.withColumn("item_total_value", money(F.col("item_price") + F.col("freight_value")))
    present = set(stg_order_items.columns)
    return enriched.select(*[c for c in FCT_ORDER_ITEMS_COLUMNS if c != "order_item_id" or c in present])


def order_item_metrics(stg_order_items: DataFrame) -> DataFrame:
    """Per-order item measures, one shuffled row for each order and map task.

    Products and sellers are counted as sets, combined map-side: a distinct count
    of each would shuffle every item row three times and keep all of them for a
    second shuffle. An order's state is as large as its number of distinct
    products and sellers.
    """
    return stg_order_items.groupBy("order_id").agg(
        money_sum("item_price").alias("merchandise_revenue"),
        money_sum("freight_value").alias("freight_revenue"),
        F.count(F.lit(1)).alias("item_count"),
        F.size(F.collect_set("product_id")).cast("long").alias("distinct_product_count"),
        F.size(F.collect_set("seller_id")).cast("long").alias("distinct_seller_count"),
    )


def order_payment_metrics(stg_order_payments: DataFrame) -> DataFrame:
    """Per-order payment measures; the type list comes from the same aggregate."""
    return stg_order_payments.groupBy("order_id").agg(
        money_sum("payment_value").alias("payment_value"),
        F.max("payment_installments").alias("max_payment_installments"),
        sorted_distinct_list("payment_type").alias("payment_types"),
    )


def order_review_metrics(stg_order_reviews: DataFrame) -> DataFrame:
    return stg_order_reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("average_review_score"),
        F.count_distinct("review_id").alias("review_count"),
    )


# The published columns of the order fact, in order.
FCT_ORDERS_COLUMNS = (
    "order_id",
    "customer_id",
    "customer_unique_id",
    "customer_state",
    "customer_city",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "purchase_date",
    "purchase_month",
    "merchandise_revenue",
    "freight_revenue",
    "order_total_value",
    "item_count",
    "distinct_product_count",
    "distinct_seller_count",
    "payment_value",
    "max_payment_installments",
    "payment_types",
    "average_review_score",
    "review_count",
    "delivery_days",
    "delivery_delay_days",
    "delivery_delay_days_exact",
    "on_time_delivery_flag",
)


def fct_orders(
    stg_orders: DataFrame,
    dim_customers_df: DataFrame,
    stg_order_items: DataFrame,
    stg_order_payments: DataFrame,
    stg_order_reviews: DataFrame,
    orders_proven: bool = False,
) -> DataFrame:
    """One row per order with commercial, payment, review and delivery measures.

    ``delivery_days`` and ``delivery_delay_days`` count calendar days;
    ``delivery_delay_days_exact`` is the elapsed time in fractional days, which
    the delivery-distribution buckets use. The on-time flag is NULL (not
    evaluable) unless the order is delivered and both dates are known.
    """
    # The three right sides are unique on order_id by construction (grouped
    # on it); the orders are checked here unless they have been before, so
    # every join is one to one.
    orders = stg_orders if orders_proven else require_unique(stg_orders, ["order_id"], "orders")
    joined = (
        orders.join(order_item_metrics(stg_order_items), "order_id", "left")
        .join(order_payment_metrics(stg_order_payments), "order_id", "left")
        .join(order_review_metrics(stg_order_reviews), "order_id", "left")
    )
    customers = dim_customers_df.select(
        "customer_id", "customer_unique_id", "customer_state", "customer_city"
    )
    joined = guarded_join(joined, customers, "customer_id", label="orders to customers")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    purchased = F.col("order_purchase_timestamp")
    evaluable = (F.col("order_status") == "delivered") & delivered.isNotNull() & estimated.isNotNull()
    enriched = joined.select(
        "*",
        money(F.col("merchandise_revenue") + F.col("freight_revenue")).alias("order_total_value"),
        when_both_present(delivered, purchased, whole_days(delivered, purchased)).alias("delivery_days"),
        when_both_present(delivered, estimated, whole_days(delivered, estimated)).alias(
            "delivery_delay_days"
        ),
        when_both_present(delivered, estimated, fractional_days(delivered, estimated)).alias(
            "delivery_delay_days_exact"
        ),
        F.when(evaluable, F.when(delivered <= estimated, 1).otherwise(0)).alias("on_time_delivery_flag"),
    )
    return enriched.select(*FCT_ORDERS_COLUMNS)
