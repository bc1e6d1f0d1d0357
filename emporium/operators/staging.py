"""Staging: one typed, source-aligned projection per raw extract.

Each staged relation is a plain ``select`` of casts over its raw table; the
optimizer folds it into the scan, so staging costs nothing at run time beyond
the casts themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import column_types, malformed, staged_sql

# (raw column, staged type, staged name)
Spec = tuple[tuple[str, str, str], ...]

# Staged column types and the two renames the model applies.
STAGING: dict[str, tuple[str, Spec]] = {
    "stg_orders": (
        "orders",
        (
            ("order_id", "string", "order_id"),
            ("customer_id", "string", "customer_id"),
            ("order_status", "string", "order_status"),
            ("order_purchase_timestamp", "timestamp", "order_purchase_timestamp"),
            ("order_approved_at", "timestamp", "order_approved_at"),
            ("order_delivered_carrier_date", "timestamp", "order_delivered_carrier_date"),
            ("order_delivered_customer_date", "timestamp", "order_delivered_customer_date"),
            ("order_estimated_delivery_date", "timestamp", "order_estimated_delivery_date"),
        ),
    ),
    "stg_order_items": (
        "order_items",
        (
            ("order_id", "string", "order_id"),
            ("order_item_id", "int", "order_item_id"),
            ("product_id", "string", "product_id"),
            ("seller_id", "string", "seller_id"),
            ("shipping_limit_date", "timestamp", "shipping_limit_date"),
            ("price", "decimal(18,2)", "item_price"),
            ("freight_value", "decimal(18,2)", "freight_value"),
        ),
    ),
    "stg_order_payments": (
        "order_payments",
        (
            ("order_id", "string", "order_id"),
            ("payment_sequential", "int", "payment_sequential"),
            ("payment_type", "string", "payment_type"),
            ("payment_installments", "int", "payment_installments"),
            ("payment_value", "decimal(18,2)", "payment_value"),
        ),
    ),
    "stg_order_reviews": (
        "order_reviews",
        (
            ("review_id", "string", "review_id"),
            ("order_id", "string", "order_id"),
            ("review_score", "int", "review_score"),
            ("review_comment_title", "string", "review_comment_title"),
            ("review_comment_message", "string", "review_comment_message"),
            ("review_creation_date", "timestamp", "review_creation_timestamp"),
            ("review_answer_timestamp", "timestamp", "review_answer_timestamp"),
        ),
    ),
    "stg_customers": (
        "customers",
        (
            ("customer_id", "string", "customer_id"),
            ("customer_unique_id", "string", "customer_unique_id"),
            ("customer_zip_code_prefix", "string", "customer_zip_code_prefix"),
            ("customer_city", "string", "customer_city"),
            ("customer_state", "string", "customer_state"),
        ),
    ),
    "stg_products": (
        "products",
        (
            ("product_id", "string", "product_id"),
            ("product_category_name", "string", "product_category_name"),
            ("product_name_lenght", "int", "product_name_length"),
            ("product_description_lenght", "int", "product_description_length"),
            ("product_photos_qty", "int", "product_photos_qty"),
            ("product_weight_g", "double", "product_weight_g"),
            ("product_length_cm", "double", "product_length_cm"),
            ("product_height_cm", "double", "product_height_cm"),
            ("product_width_cm", "double", "product_width_cm"),
        ),
    ),
    "stg_sellers": (
        "sellers",
        (
            ("seller_id", "string", "seller_id"),
            ("seller_zip_code_prefix", "string", "seller_zip_code_prefix"),
            ("seller_city", "string", "seller_city"),
            ("seller_state", "string", "seller_state"),
        ),
    ),
    "stg_geolocation": (
        "geolocation",
        (
            ("geolocation_zip_code_prefix", "string", "geolocation_zip_code_prefix"),
            ("geolocation_lat", "double", "geolocation_lat"),
            ("geolocation_lng", "double", "geolocation_lng"),
            ("geolocation_city", "string", "geolocation_city"),
            ("geolocation_state", "string", "geolocation_state"),
        ),
    ),
    "stg_category_translation": (
        "category_translation",
        (
            ("product_category_name", "string", "product_category_name"),
            ("product_category_name_english", "string", "product_category_name_english"),
        ),
    ),
}


def stage(name: str, raw: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """Typed projection ``name`` (a key of :data:`STAGING`) over its raw table, but for the columns ``without``."""
    return raw.selectExpr(*staging_sql(name, raw, without))


def staging_sql(name: str, raw: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    """The SQL expressions of staged table ``name`` over its raw table."""
    _, spec = STAGING[name]
    types = column_types(raw)
    exprs = [f"{staged_sql(types[src], src, dtype)} AS `{out}`" for src, dtype, out in spec if src not in without]
    if name == "stg_orders":
        purchase = staged_sql(types["order_purchase_timestamp"], "order_purchase_timestamp", "timestamp")
        exprs += [
            f"to_date({purchase}) AS purchase_date",
            f"cast(date_trunc('month', {purchase}) AS date) AS purchase_month",
        ]
    return exprs


def coerced_values(name: str, raw: DataFrame) -> Column:
    """Aggregate: how many values of staged table ``name`` are not NULL in ``raw`` and do not parse.

    Text columns cannot fail; a table of text alone counts none.
    """
    _, spec = STAGING[name]
    types = column_types(raw)
    failed = [F.count_if(malformed(types[src], src, dtype)) for src, dtype, _ in spec if dtype != "string"]
    return sum(failed[1:], failed[0]) if failed else F.count_if(F.lit(False))
