"""Catalogue of the nine raw commerce extracts.

Each entry names a logical table, its raw columns (as they appear in the
extract, including the source's own misspellings) and a description. Raw
columns are always read as strings; staging casts them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class RawTable:
    name: str
    columns: tuple[str, ...]
    description: str
    free_text: bool = False  # fields may hold line breaks

    aliases: tuple[str, ...] = ()  # file names (without .csv) outside the pattern

    def fits(self, file_name: str) -> bool:
        """Whether an extract of this table may have this file name.

        That is its own name, ``<anything>_<name>_dataset``, or an alias.
        """
        stem = file_name.removesuffix(".csv")
        return stem in (self.name, f"{self.name}_dataset", *self.aliases) or stem.endswith(f"_{self.name}_dataset")

    @property
    def schema(self) -> T.StructType:
        """All-string schema: no inference, so zip prefixes keep leading zeros."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])

    @property
    def default_file(self) -> str:
        return f"{self.name}.csv"


# Raw column names of each extract, in source order.
RAW_TABLES: dict[str, RawTable] = {
    t.name: t
    for t in [
        RawTable(
            "orders",
            (
                "order_id",
                "customer_id",
                "order_status",
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
            "Order headers with the status and the five time stamps of their course.",
        ),
        RawTable(
            "order_items",
            (
                "order_id",
                "order_item_id",
                "product_id",
                "seller_id",
                "shipping_limit_date",
                "price",
                "freight_value",
            ),
            "Lines of an order: what was bought from which seller, at what price and freight.",
        ),
        RawTable(
            "order_payments",
            (
                "order_id",
                "payment_sequential",
                "payment_type",
                "payment_installments",
                "payment_value",
            ),
            "Payments of an order in sequence, by type, with instalments.",
        ),
        RawTable(
            "order_reviews",
            (
                "review_id",
                "order_id",
                "review_score",
                "review_comment_title",
                "review_comment_message",
                "review_creation_date",
                "review_answer_timestamp",
            ),
            "Scores and comments customers gave, by order; an id can occur for several orders.",
            free_text=True,
        ),
        RawTable(
            "customers",
            (
                "customer_id",
                "customer_unique_id",
                "customer_zip_code_prefix",
                "customer_city",
                "customer_state",
            ),
            "Customers as they appear on orders, with the person behind them and where they live.",
        ),
        RawTable(
            "products",
            (
                "product_id",
                "product_category_name",
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
            "Products: category in the source language, text lengths, photos, weight and size.",
        ),
        RawTable(
            "sellers",
            ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
            "Sellers and where they are.",
        ),
        RawTable(
            "geolocation",
            (
                "geolocation_zip_code_prefix",
                "geolocation_lat",
                "geolocation_lng",
                "geolocation_city",
                "geolocation_state",
            ),
            "Coordinates seen for a zip prefix, many for each.",
        ),
        RawTable(
            "category_translation",
            ("product_category_name", "product_category_name_english"),
            "English names of product categories.",
            aliases=("product_category_name_translation",),
        ),
    ]
}

RAW_NAMES: tuple[str, ...] = tuple(RAW_TABLES)
