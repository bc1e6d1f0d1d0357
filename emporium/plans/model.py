"""The whole star schema as lazily-built DataFrames over one set of raw tables.

Each attribute is a DataFrame plan, built the first time it is asked for, so a
query that needs two relations never constructs the other twenty. Building one
runs no job, except that a raw table which numbers its rows stores them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import session as _session
from ..operators import marts, semantic
from ..operators.staging import STAGING, stage


class Model:
    """raw -> staging -> marts -> semantic views."""

    MARTS = (
        "dim_customers",
        "dim_sellers",
        "dim_products",
        "dim_geography",
        "fct_order_items",
        "fct_orders",
    )
    SEMANTIC = ("semantic_order_metrics", "semantic_product_metrics")

    def __init__(self, raw: Mapping[str, DataFrame], orders_proven: bool = False):
        """``orders_proven`` says that no order repeats in ``raw``, so the facts need not make sure."""
        self.raw = raw
        self.orders_proven = orders_proven

    @property
    def unique_orders(self) -> bool:
        """Whether an order is one row of ``fct_orders``: here that fact itself raises if one repeats."""
        return True

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.raw.values())).sparkSession

    def table(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self.raw[name[4:]]
        return getattr(self, name)

    def _stage(self, name: str) -> DataFrame:
        source, _ = STAGING[name]
        return stage(name, self.raw[source])

    # staging
    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._stage("stg_orders")

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return self._stage("stg_order_items")

    @cached_property
    def stg_order_item_values(self) -> DataFrame:
        """``stg_order_items`` without the item number."""
        raw = self.raw["order_item_values"] if "order_item_values" in set(self.raw) else self.raw["order_items"]
        return stage("stg_order_items", raw, without=("order_item_id",))

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return self._stage("stg_order_payments")

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return self._stage("stg_order_reviews")

    @cached_property
    def stg_customers(self) -> DataFrame:
        return self._stage("stg_customers")

    @cached_property
    def stg_products(self) -> DataFrame:
        return self._stage("stg_products")

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return self._stage("stg_sellers")

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return self._stage("stg_geolocation")

    @cached_property
    def stg_category_translation(self) -> DataFrame:
        return self._stage("stg_category_translation")

    # marts
    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg_customers)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return marts.dim_sellers(self.stg_sellers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg_products, self.stg_category_translation)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return marts.dim_geography(self.stg_geolocation)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return marts.fct_order_items(
            self.stg_order_items, self.stg_orders, self.dim_products, self.dim_sellers, self.orders_proven
        )

    @cached_property
    def fct_order_item_values(self) -> DataFrame:
        """``fct_order_items`` without the item number: the stored fact where there is one."""
        if "fct_order_items" in self.__dict__:
            return self.fct_order_items.drop("order_item_id")
        return marts.fct_order_items(
            self.stg_order_item_values, self.stg_orders, self.dim_products, self.dim_sellers, self.orders_proven
        )

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(
            self.stg_orders,
            self.dim_customers,
            self.stg_order_item_values,
            self.stg_order_payments,
            self.stg_order_reviews,
            self.orders_proven,
        )

    # semantic views
    @cached_property
    def semantic_order_metrics(self) -> DataFrame:
        return semantic.semantic_order_metrics(self.fct_orders)

    @cached_property
    def semantic_product_metrics(self) -> DataFrame:
        return semantic.semantic_product_metrics(self.fct_order_items)

    @cached_property
    def semantic_product_values(self) -> DataFrame:
        """``semantic_product_metrics`` without the item number."""
        return semantic.semantic_product_metrics(self.fct_order_item_values)


def from_tpch(spark: SparkSession, directory: str) -> Model:
    """The model over the TPC-H-style parquet tables in ``directory``."""
    from ..sources.tpch import raw_from_tpch

    _session.prepare(spark)
    return Model(raw_from_tpch(spark, directory))
