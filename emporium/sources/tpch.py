"""Source adapter: TPC-H-style parquet tables -> the nine raw commerce extracts.

The benchmark data has no commerce extracts, so each raw table is derived
from a TPC-H-style table with plain column expressions (and one window for
item numbering). The derived tables carry the raw column names; their values
are already typed, and staging casts them exactly as it casts CSV text.

The mapping is synthetic. It exercises every operator of the model (delivered
and undelivered orders, late and early deliveries, repeated reviews, several
customer ids per person, untranslated categories); the business meaning of
the numbers should not be read into results.

Rules (``div`` is integer division, ``%`` the remainder):

* orders       <- orders. Status F/O/P -> delivered/shipped/processing.
  approved  = purchase + (key % 5 - 1) hours, NULL when key % 17 = 0;
  carrier   = purchase + (key % 4) days, NULL while processing;
  delivered = purchase + (key % 45) days + (custkey % 24) hours, only when F;
  estimated = purchase + 20 days.
* order_items  <- lineitem. Item number = position within the order by
  (linenumber, partkey, suppkey, extendedprice); price = extendedprice;
  freight = round(price * tax, 2).
* order_payments <- lineitem, one payment per line: sequential = linenumber,
  type from the return flag, installments = quantity, value = price.
* order_reviews <- events: review id = event_id div 2 (so ids repeat), order
  = event_id div 3, score = 1 + event_id % 5, created = ts, answered = ts + 1 day.
* customers    <- customer + nation + region: person id = custkey div 2,
  zip = nation key left-padded to 5 digits, city = nation, state = region.
* geolocation  <- customer + nation + region: lat = acctbal / 1000,
  lng = acctbal / 2000, city = customer name, state = region.
* products     <- part: category = brand; sizes and weight from size/price.
* sellers      <- supplier + nation + region (as customers).
* category_translation <- the distinct brands of part, named ``line_NN`` by
  their number.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import number_within
from .tables import LazyTables

# Order status codes and payment types by return flag.
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_BY_FLAG = {"A": "credit_card", "N": "debit_card", "R": "voucher"}

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_tpch(spark: SparkSession, directory: str) -> LazyTables:
    """The TPC-H-style tables of ``directory`` as parquet scans (opened on first use)."""
    base = directory.rstrip("/")
    return LazyTables({name: (lambda name=name: spark.read.parquet(f"{base}/{name}.parquet")) for name in TPCH_TABLES})


def raw_from_tpch(spark: SparkSession, directory: str) -> LazyTables:
    """The nine raw commerce tables derived from ``directory`` (built on first use).

    ``order_item_values`` is ``order_items`` without the derived item number,
    whose numbering reads and shuffles all of lineitem.
    """
    src = read_tpch(spark, directory)
    return LazyTables(
        {
            "orders": lambda: raw_orders(src),
            "order_items": lambda: raw_order_items(src),
            "order_item_values": lambda: raw_order_item_values(src),
            "order_payments": lambda: raw_order_payments(src),
            "order_reviews": lambda: raw_order_reviews(src),
            "customers": lambda: raw_customers(src),
            "products": lambda: raw_products(src),
            "sellers": lambda: raw_sellers(src),
            "geolocation": lambda: raw_geolocation(src),
            "category_translation": lambda: raw_category_translation(src),
        }
    )


def _case(codes: Mapping[str, str], col: str) -> str:
    whens = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in codes.items())
    return f"CASE {col} {whens} ELSE {col} END"


def _zip(col: str) -> str:
    return f"lpad(cast({col} AS string), 5, '0')"


_PRICE = "cast(l_extendedprice AS decimal(18,2))"

# The projections are SQL expressions: one call builds a whole projection.
_ORDERS = [
    "cast(o_orderkey AS string) AS order_id",
    "cast(o_custkey AS string) AS customer_id",
    f"{_case(STATUS_BY_CODE, 'o_orderstatus')} AS order_status",
    "cast(o_orderdate AS timestamp) AS order_purchase_timestamp",
    "CASE WHEN o_orderkey % 17 <> 0 THEN cast(o_orderdate AS timestamp)"
    " + make_dt_interval(0, cast(o_orderkey % 5 - 1 AS int)) END AS order_approved_at",
    "CASE WHEN o_orderstatus <> 'P' THEN cast(o_orderdate AS timestamp)"
    " + make_dt_interval(cast(o_orderkey % 4 AS int)) END AS order_delivered_carrier_date",
    "CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS timestamp)"
    " + make_dt_interval(cast(o_orderkey % 45 AS int)) + make_dt_interval(0, cast(o_custkey % 24 AS int))"
    " END AS order_delivered_customer_date",
    "cast(o_orderdate AS timestamp) + INTERVAL 20 DAYS AS order_estimated_delivery_date",
]

_ORDER_ITEMS = [
    "cast(l_orderkey AS string) AS order_id",
    "order_item_id",
    "cast(l_partkey AS string) AS product_id",
    "cast(l_suppkey AS string) AS seller_id",
    "cast(l_shipdate AS timestamp) AS shipping_limit_date",
    f"{_PRICE} AS price",
    f"cast(round({_PRICE} * cast(l_tax AS decimal(18,2)), 2) AS decimal(18,2)) AS freight_value",
]

_ORDER_PAYMENTS = [
    "cast(l_orderkey AS string) AS order_id",
    "l_linenumber AS payment_sequential",
    f"{_case(PAYMENT_BY_FLAG, 'l_returnflag')} AS payment_type",
    "cast(l_quantity AS int) AS payment_installments",
    f"{_PRICE} AS payment_value",
]

_ORDER_REVIEWS = [
    "cast(event_id div 2 AS string) AS review_id",
    "cast(event_id div 3 AS string) AS order_id",
    "cast(1 + event_id % 5 AS int) AS review_score",
    "event_type AS review_comment_title",
    "props AS review_comment_message",
    "cast(ts AS timestamp) AS review_creation_date",
    "cast(ts AS timestamp) + INTERVAL 1 DAY AS review_answer_timestamp",
]

_CUSTOMERS = [
    "cast(c_custkey AS string) AS customer_id",
    "cast(c_custkey div 2 AS string) AS customer_unique_id",
    f"{_zip('c_nationkey')} AS customer_zip_code_prefix",
    "n_name AS customer_city",
    "r_name AS customer_state",
]

_GEOLOCATION = [
    f"{_zip('c_nationkey')} AS geolocation_zip_code_prefix",
    "c_acctbal / 1000 AS geolocation_lat",
    "c_acctbal / 2000 AS geolocation_lng",
    "c_name AS geolocation_city",
    "r_name AS geolocation_state",
]

_PRODUCTS = [
    "cast(p_partkey AS string) AS product_id",
    "p_brand AS product_category_name",
    "cast(length(p_name) AS int) AS product_name_lenght",
    "cast(p_size * 10 AS int) AS product_description_lenght",
    "cast(p_size % 4 + 1 AS int) AS product_photos_qty",
    "cast(p_retailprice AS double) AS product_weight_g",
    "cast(p_size AS double) AS product_length_cm",
    "cast(p_size / 2 AS double) AS product_height_cm",
    "cast(p_size / 4 AS double) AS product_width_cm",
]

_SELLERS = [
    "cast(s_suppkey AS string) AS seller_id",
    f"{_zip('s_nationkey')} AS seller_zip_code_prefix",
    "n_name AS seller_city",
    "r_name AS seller_state",
]


def raw_orders(src: Mapping[str, DataFrame]) -> DataFrame:
    return src["orders"].selectExpr(*_ORDERS)


def raw_order_items(src: Mapping[str, DataFrame]) -> DataFrame:
    lines = src["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_tax", "l_shipdate"
    )
    numbered = number_within(
        lines,
        key="l_orderkey",
        order=["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
        out="order_item_id",
    )
    return numbered.withColumn("order_item_id", F.col("order_item_id").cast("int")).selectExpr(*_ORDER_ITEMS)


def raw_order_item_values(src: Mapping[str, DataFrame]) -> DataFrame:
    """The item rows without the item number, for reports that do not use it."""
    return src["lineitem"].selectExpr(*[e for e in _ORDER_ITEMS if e != "order_item_id"])


def raw_order_payments(src: Mapping[str, DataFrame]) -> DataFrame:
    return src["lineitem"].selectExpr(*_ORDER_PAYMENTS)


def raw_order_reviews(src: Mapping[str, DataFrame]) -> DataFrame:
    return src["events"].selectExpr(*_ORDER_REVIEWS)


def _located(base: DataFrame, nation_key: str, src: Mapping[str, DataFrame]) -> DataFrame:
    nation = src["nation"].select("n_nationkey", "n_name", "n_regionkey")
    region = src["region"].select("r_regionkey", "r_name")
    return base.join(nation, base[nation_key] == nation["n_nationkey"], "left").join(
        region, F.col("n_regionkey") == region["r_regionkey"], "left"
    )


def raw_customers(src: Mapping[str, DataFrame]) -> DataFrame:
    return _located(src["customer"], "c_nationkey", src).selectExpr(*_CUSTOMERS)


def raw_geolocation(src: Mapping[str, DataFrame]) -> DataFrame:
    return _located(src["customer"], "c_nationkey", src).selectExpr(*_GEOLOCATION)


def raw_products(src: Mapping[str, DataFrame]) -> DataFrame:
    return src["part"].selectExpr(*_PRODUCTS)


def raw_sellers(src: Mapping[str, DataFrame]) -> DataFrame:
    return _located(src["supplier"], "s_nationkey", src).selectExpr(*_SELLERS)


def raw_category_translation(src: Mapping[str, DataFrame]) -> DataFrame:
    """Every distinct numbered brand gets the name ``line_NN``."""
    number = "try_cast(substring_index(p_brand, '#', -1) AS int)"
    return (
        src["part"]
        .select("p_brand")
        .distinct()
        .where(f"{number} IS NOT NULL")
        .selectExpr(
            "p_brand AS product_category_name",
            f"concat('line_', lpad(cast({number} AS string), 2, '0')) AS product_category_name_english",
        )
    )
