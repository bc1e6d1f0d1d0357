"""DuckDB statements that state, independently of the Spark code, what each
registered query must return.

They run on the TPC-H-style tables the checker registers as views (``orders``,
``lineitem``, ``customer`` ...). Every relation of the model is one CTE; a
query's statement carries the CTEs it needs, in dependency order.

Where the two engines differ on purpose, the SQL states Spark's semantics:

* ``round`` of a double: Spark rounds the shortest decimal text of the double
  half-up; the macro-like :func:`spark_round` does the same in DuckDB
  (DuckDB's own ``round`` works on the binary value);
* decimal division: DuckDB returns a double, so money ratios are rounded
  half-up on integer cents (:func:`cents_ratio`);
* averages are written as ``sum / count`` in double, the way Spark computes
  them.
"""

from __future__ import annotations

import re


def spark_round(x: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def spark_bround(x: str, digits: int) -> str:
    return f"CAST(round_even(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def rounded_mean(x: str, digits: int) -> str:
    """Mean of the values as they are, the result rounded."""
    return spark_round(f"avg({x})", digits)


def double_mean(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / COUNT({x}))"


def cents(x: str) -> str:
    """Integer cents of a money expression (exact, via its 2-decimal text)."""
    return f"CAST(replace(CAST(CAST(({x}) AS DECIMAL(38,2)) AS VARCHAR), '.', '') AS HUGEINT)"


def cents_ratio(money: str, count: str) -> str:
    """round(money / count, 2) half-up, computed on integer cents, as DECIMAL(38,2)."""
    c, n = cents(money), f"NULLIF(({count}), 0)"
    q = f"(CASE WHEN {c} >= 0 THEN (2 * {c} + {n}) // (2 * {n}) ELSE -((2 * (-{c}) + {n}) // (2 * {n})) END)"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,2))"


def money_total(x: str) -> str:
    return f"CAST(round(SUM({x}), 2) AS DECIMAL(38,2))"


MONTH = "strftime({}, '%Y-%m')"

# --- relations -------------------------------------------------------------

CTES: dict[str, str] = {}

CTES["raw_orders"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
            WHEN 'P' THEN 'processing' ELSE o_orderstatus END AS order_status,
       CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 17 <> 0
            THEN CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 5 - 1 AS BIGINT)) END
            AS order_approved_at,
       CASE WHEN o_orderstatus <> 'P'
            THEN CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 4 AS INTEGER)) END
            AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F'
            THEN CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 45 AS INTEGER))
                 + to_hours(CAST(o_custkey % 24 AS BIGINT)) END AS order_delivered_customer_date,
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL 20 DAY AS order_estimated_delivery_date
FROM orders"""

CTES["raw_order_items"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                     l_extendedprice NULLS FIRST) AS INTEGER) AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS seller_id,
       CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2)
            AS DECIMAL(18,2)) AS freight_value
FROM lineitem"""

CTES["raw_order_payments"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
       l_linenumber AS payment_sequential,
       CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'debit_card'
            WHEN 'R' THEN 'voucher' ELSE l_returnflag END AS payment_type,
       CAST(l_quantity AS INTEGER) AS payment_installments,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS payment_value
FROM lineitem"""

CTES["raw_order_reviews"] = """
SELECT CAST(event_id // 2 AS VARCHAR) AS review_id,
       CAST(event_id // 3 AS VARCHAR) AS order_id,
       CAST(1 + event_id % 5 AS INTEGER) AS review_score,
       event_type AS review_comment_title,
       props AS review_comment_message,
       CAST(ts AS TIMESTAMP) AS review_creation_date,
       CAST(ts AS TIMESTAMP) + INTERVAL 1 DAY AS review_answer_timestamp
FROM events"""

_LOCATED = """{base} LEFT JOIN nation ON {key} = n_nationkey
     LEFT JOIN region ON n_regionkey = r_regionkey"""

CTES["raw_customers"] = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       CAST(c_custkey // 2 AS VARCHAR) AS customer_unique_id,
       lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
       n_name AS customer_city,
       r_name AS customer_state
FROM """ + _LOCATED.format(base="customer", key="c_nationkey")

CTES["raw_geolocation"] = """
SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
       c_acctbal / 1000 AS geolocation_lat,
       c_acctbal / 2000 AS geolocation_lng,
       c_name AS geolocation_city,
       r_name AS geolocation_state
FROM """ + _LOCATED.format(base="customer", key="c_nationkey")

CTES["raw_products"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       p_brand AS product_category_name,
       CAST(length(p_name) AS INTEGER) AS product_name_lenght,
       CAST(p_size * 10 AS INTEGER) AS product_description_lenght,
       CAST(p_size % 4 + 1 AS INTEGER) AS product_photos_qty,
       CAST(p_retailprice AS DOUBLE) AS product_weight_g,
       CAST(p_size AS DOUBLE) AS product_length_cm,
       CAST(p_size / 2 AS DOUBLE) AS product_height_cm,
       CAST(p_size / 4 AS DOUBLE) AS product_width_cm
FROM part"""

CTES["raw_sellers"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
       lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
       n_name AS seller_city,
       r_name AS seller_state
FROM """ + _LOCATED.format(base="supplier", key="s_nationkey")

CTES["raw_category_translation"] = """
SELECT p_brand AS product_category_name,
       'line_' || lpad(CAST(brand_no AS VARCHAR), 2, '0') AS product_category_name_english
FROM (SELECT p_brand, TRY_CAST(string_split(p_brand, '#')[-1] AS INTEGER) AS brand_no
      FROM (SELECT DISTINCT p_brand FROM part))
WHERE brand_no IS NOT NULL"""

CTES["stg_orders"] = """
SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
       order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
       CAST(order_purchase_timestamp AS DATE) AS purchase_date,
       CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS purchase_month
FROM raw_orders"""

CTES["stg_order_items"] = """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
       price AS item_price, freight_value
FROM raw_order_items"""

CTES["stg_order_payments"] = """
SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value
FROM raw_order_payments"""

CTES["stg_order_reviews"] = """
SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
       review_creation_date AS review_creation_timestamp, review_answer_timestamp
FROM raw_order_reviews"""

CTES["stg_customers"] = "SELECT * FROM raw_customers"
CTES["stg_sellers"] = "SELECT * FROM raw_sellers"
CTES["stg_geolocation"] = "SELECT * FROM raw_geolocation"
CTES["stg_category_translation"] = "SELECT * FROM raw_category_translation"

CTES["stg_products"] = """
SELECT product_id, product_category_name,
       product_name_lenght AS product_name_length,
       product_description_lenght AS product_description_length,
       product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
FROM raw_products"""

CTES["dim_customers"] = """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
FROM stg_customers"""

CTES["dim_sellers"] = """
SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM stg_sellers"""

CTES["dim_products"] = """
SELECT p.product_id, p.product_category_name,
       coalesce(t.product_category_name_english, 'unknown') AS product_category_name_english,
       p.product_name_length, p.product_description_length, p.product_photos_qty,
       p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm
FROM stg_products p
LEFT JOIN stg_category_translation t ON p.product_category_name = t.product_category_name"""

CTES["dim_geography"] = f"""
SELECT geolocation_zip_code_prefix,
       {rounded_mean('geolocation_lat', 8)} AS latitude,
       {rounded_mean('geolocation_lng', 8)} AS longitude,
       min(geolocation_city) AS representative_city,
       min(geolocation_state) AS representative_state,
       count(*) AS source_observation_count
FROM stg_geolocation
GROUP BY geolocation_zip_code_prefix"""

CTES["fct_order_items"] = """
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id,
       o.customer_id, o.order_status, o.order_purchase_timestamp, o.purchase_date, o.purchase_month,
       p.product_category_name_english, s.seller_state,
       i.item_price, i.freight_value,
       CAST(i.item_price + i.freight_value AS DECIMAL(18,2)) AS item_total_value,
       i.shipping_limit_date
FROM stg_order_items i
LEFT JOIN stg_orders o ON i.order_id = o.order_id
LEFT JOIN dim_products p ON i.product_id = p.product_id
LEFT JOIN dim_sellers s ON i.seller_id = s.seller_id"""

CTES["item_metrics"] = """
SELECT order_id,
       CAST(sum(item_price) AS DECIMAL(18,2)) AS merchandise_revenue,
       CAST(sum(freight_value) AS DECIMAL(18,2)) AS freight_revenue,
       count(*) AS item_count,
       count(DISTINCT product_id) AS distinct_product_count,
       count(DISTINCT seller_id) AS distinct_seller_count
FROM stg_order_items GROUP BY order_id"""

CTES["payment_metrics"] = """
SELECT order_id,
       CAST(sum(payment_value) AS DECIMAL(18,2)) AS payment_value,
       max(payment_installments) AS max_payment_installments,
       coalesce(string_agg(DISTINCT payment_type, ', ' ORDER BY payment_type), '') AS payment_types
FROM stg_order_payments GROUP BY order_id"""

CTES["review_metrics"] = f"""
SELECT order_id,
       {double_mean('review_score')} AS average_review_score,
       count(DISTINCT review_id) AS review_count
FROM stg_order_reviews GROUP BY order_id"""

CTES["fct_orders"] = """
SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_state, c.customer_city,
       o.order_status, o.order_purchase_timestamp, o.order_approved_at,
       o.order_delivered_carrier_date, o.order_delivered_customer_date,
       o.order_estimated_delivery_date, o.purchase_date, o.purchase_month,
       i.merchandise_revenue, i.freight_revenue,
       CAST(i.merchandise_revenue + i.freight_revenue AS DECIMAL(18,2)) AS order_total_value,
       i.item_count, i.distinct_product_count, i.distinct_seller_count,
       p.payment_value, p.max_payment_installments, p.payment_types,
       r.average_review_score, r.review_count,
       CASE WHEN o.order_delivered_customer_date IS NOT NULL AND o.order_purchase_timestamp IS NOT NULL
            THEN CAST(date_diff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) AS INTEGER)
       END AS delivery_days,
       CASE WHEN o.order_delivered_customer_date IS NOT NULL AND o.order_estimated_delivery_date IS NOT NULL
            THEN CAST(date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date) AS INTEGER)
       END AS delivery_delay_days,
       CASE WHEN o.order_delivered_customer_date IS NOT NULL AND o.order_estimated_delivery_date IS NOT NULL
            THEN (epoch_us(o.order_delivered_customer_date) - epoch_us(o.order_estimated_delivery_date))
                 / 86400000000
       END AS delivery_delay_days_exact,
       CASE WHEN o.order_status = 'delivered' AND o.order_delivered_customer_date IS NOT NULL
                 AND o.order_estimated_delivery_date IS NOT NULL
            THEN CASE WHEN o.order_delivered_customer_date <= o.order_estimated_delivery_date
                      THEN 1 ELSE 0 END
       END AS on_time_delivery_flag
FROM stg_orders o
LEFT JOIN item_metrics i ON o.order_id = i.order_id
LEFT JOIN payment_metrics p ON o.order_id = p.order_id
LEFT JOIN review_metrics r ON o.order_id = r.order_id
LEFT JOIN dim_customers c ON o.customer_id = c.customer_id"""

CTES["semantic_order_metrics"] = """
SELECT order_id, customer_unique_id, customer_state, order_status, purchase_date, purchase_month,
       merchandise_revenue, freight_revenue, order_total_value, item_count, average_review_score,
       delivery_days, delivery_delay_days, delivery_delay_days_exact, on_time_delivery_flag
FROM fct_orders"""

CTES["semantic_product_metrics"] = """
SELECT order_id, order_item_id, product_id, seller_id, purchase_date, purchase_month,
       product_category_name_english, seller_state, item_price, freight_value, item_total_value
FROM fct_order_items"""


def _deps(name: str) -> list[str]:
    body = CTES[name]
    return [d for d in CTES if d != name and re.search(rf"\b{d}\b", body)]


def with_ctes(select: str) -> str:
    """``select`` prefixed by every CTE it (transitively) reads, in dependency order."""
    needed: list[str] = []

    def visit(n: str) -> None:
        for d in _deps(n):
            visit(d)
        if n not in needed:
            needed.append(n)

    for name in CTES:
        if re.search(rf"\b{name}\b", select):
            visit(name)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in needed) + "\n" + select


# --- registered queries ---------------------------------------------------

# The published delivery bucket labels and their bounds.
_DELIVERY_CASE = """CASE WHEN {d} <= -15 THEN '15+ days early'
            WHEN {d} <= -1 THEN '1-14 days early'
            WHEN {d} <= 0 THEN 'On estimated date'
            WHEN {d} <= 7 THEN '1-7 days late'
            ELSE '8+ days late' END"""


def _delivery(column: str) -> str:
    return f"""
SELECT {_DELIVERY_CASE.format(d=column)} AS delivery_bucket, count(*) AS orders
FROM semantic_order_metrics
WHERE order_status = 'delivered' AND {column} IS NOT NULL
GROUP BY 1"""


_REVIEW = spark_round(rounded_mean("average_review_score", 9), 2)
_ON_TIME = spark_round(double_mean("on_time_delivery_flag"), 4)

_TOP_CATEGORIES = f"""
SELECT product_category_name_english AS category,
       {money_total('item_price')} AS merchandise_revenue,
       count(DISTINCT order_id) AS orders
FROM semantic_product_metrics
GROUP BY product_category_name_english
ORDER BY merchandise_revenue DESC NULLS LAST, category ASC NULLS LAST
LIMIT 10"""

REPORTS: dict[str, str] = {
    "kpis": f"""
SELECT {money_total('merchandise_revenue')} AS merchandise_revenue,
       {money_total('freight_revenue')} AS freight_revenue,
       count(DISTINCT order_id) AS orders,
       count(DISTINCT customer_unique_id) AS customers,
       {_REVIEW} AS average_review_score,
       {_ON_TIME} AS on_time_delivery_rate,
       {cents_ratio('round(sum(merchandise_revenue), 2)', 'count(DISTINCT order_id)')} AS average_order_value
FROM semantic_order_metrics""",
    "monthly_sales": f"""
SELECT {MONTH.format('purchase_month')} AS purchase_month,
       {money_total('item_price')} AS merchandise_revenue,
       count(DISTINCT order_id) AS orders
FROM semantic_product_metrics
GROUP BY purchase_month""",
    "top_categories": _TOP_CATEGORIES,
    "state_performance": f"""
SELECT customer_state AS state,
       {money_total('merchandise_revenue')} AS merchandise_revenue,
       count(DISTINCT order_id) AS orders,
       {_ON_TIME} AS on_time_delivery_rate,
       {_REVIEW} AS average_review_score
FROM semantic_order_metrics
GROUP BY customer_state""",
    "delivery_distribution": _delivery("delivery_delay_days_exact"),
    "delivery_distribution_calendar_days": _delivery("delivery_delay_days"),
    "top_categories_bars": f"""
SELECT category, merchandise_revenue, orders,
       greatest(2, CAST({spark_bround(
           'CAST(merchandise_revenue AS DOUBLE) / CAST(greatest(max(merchandise_revenue) OVER (), 1) AS DOUBLE) * 100',
           0)} AS INTEGER)) AS bar_width
FROM ({_TOP_CATEGORIES})""",
    "monthly_orders": f"""
SELECT {MONTH.format('purchase_month')} AS purchase_month,
       {money_total('merchandise_revenue')} AS merchandise_revenue,
       count(DISTINCT order_id) AS orders
FROM semantic_order_metrics
GROUP BY purchase_month""",
    "category_matrix": f"""
SELECT category,
       {money_total('category_revenue')} AS merchandise_revenue,
       count(*) AS orders,
       {cents_ratio('sum(category_revenue)', 'count(*)')} AS average_order_value,
       {_REVIEW} AS average_review_score
FROM (SELECT product_category_name_english AS category, order_id, sum(item_price) AS category_revenue
      FROM semantic_product_metrics GROUP BY 1, 2) per_order
LEFT JOIN (SELECT order_id, average_review_score FROM semantic_order_metrics) r USING (order_id)
GROUP BY category""",
    "seller_state_contribution": f"""
SELECT seller_state,
       CAST(round(revenue, 2) AS DECIMAL(38,2)) AS merchandise_revenue,
       {spark_round('CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE)', 4)} AS revenue_share
FROM (SELECT seller_state, sum(item_price) AS revenue FROM semantic_product_metrics GROUP BY seller_state)""",
    "on_time_by_state": f"""
SELECT customer_state,
       count(DISTINCT CASE WHEN on_time_delivery_flag IS NOT NULL THEN order_id END) AS evaluable_orders,
       {_ON_TIME} AS on_time_delivery_rate
FROM semantic_order_metrics
GROUP BY customer_state""",
    "review_by_status_month": f"""
SELECT order_status, {MONTH.format('purchase_month')} AS purchase_month,
       count(average_review_score) AS reviewed_orders,
       {_REVIEW} AS average_review_score
FROM semantic_order_metrics
GROUP BY order_status, purchase_month""",
    "data_as_of": "SELECT max(purchase_date) AS data_as_of FROM semantic_order_metrics",
    "dim_date": """
SELECT CAST(d AS DATE) AS date,
       CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
       strftime(d, '%Y-%m') AS month_label,
       strftime(d, '%Y-%m-%d') AS date_label,
       CAST(date_trunc('month', d) AS DATE) AS month_start
FROM (SELECT unnest(generate_series(CAST(min(purchase_date) AS TIMESTAMP),
                                    CAST(max(purchase_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
      FROM stg_orders)""",
}



def _listed(select: str, fields: list[str], order: str, name: str) -> str:
    struct = "{" + ", ".join(f"'{f}': {f}" for f in fields) + "}"
    return f"(SELECT list({struct} ORDER BY {order}) AS {name} FROM ({select}))"


_KPI_FIELDS = ["merchandise_revenue", "freight_revenue", "orders", "customers", "average_review_score",
               "on_time_delivery_rate", "average_order_value"]

REPORTS["metric_snapshot"] = (
    "SELECT CAST(to_json({'kpis': kpis, 'monthly_sales': monthly_sales, 'top_categories': top_categories, "
    "'state_performance': state_performance, 'delivery_distribution': delivery_distribution}) AS VARCHAR) "
    "AS snapshot FROM "
    + "(SELECT {" + ", ".join(f"'{f}': {f}" for f in _KPI_FIELDS) + "} AS kpis FROM (" + REPORTS["kpis"] + ")), "
    + _listed(REPORTS["monthly_sales"], ["purchase_month", "merchandise_revenue", "orders"],
              "purchase_month ASC NULLS FIRST", "monthly_sales") + ", "
    + _listed(_TOP_CATEGORIES, ["category", "merchandise_revenue", "orders"],
              "merchandise_revenue DESC, category ASC", "top_categories") + ", "
    + _listed(REPORTS["state_performance"]
              + " ORDER BY merchandise_revenue DESC NULLS LAST, state ASC NULLS LAST LIMIT 8",
              ["state", "merchandise_revenue", "orders", "on_time_delivery_rate", "average_review_score"],
              "merchandise_revenue DESC, state ASC", "state_performance") + ", "
    + _listed(REPORTS["delivery_distribution"], ["delivery_bucket", "orders"],
              "orders DESC, delivery_bucket ASC", "delivery_distribution")
)

# --- metric catalogue queries ---------------------------------------------

_ORDER_MEASURES = {
    "merchandise_revenue": "CAST(sum(merchandise_revenue) AS DECIMAL(38,2))",
    "freight_revenue": "CAST(sum(freight_revenue) AS DECIMAL(38,2))",
    "order_total_value": "CAST(sum(merchandise_revenue) + sum(freight_revenue) AS DECIMAL(38,2))",
    "orders": "count(DISTINCT order_id)",
    "customers": "count(DISTINCT customer_unique_id)",
    "average_order_value": "CAST(sum(merchandise_revenue) AS DOUBLE) / NULLIF(count(DISTINCT order_id), 0)",
    "on_time_delivery_rate": double_mean("on_time_delivery_flag"),
    "average_review_score": rounded_mean("average_review_score", 9),
    "late_delivery_orders": "count(DISTINCT CASE WHEN on_time_delivery_flag = 0 THEN order_id END)",
}
_PRODUCT_MEASURES = {
    "item_merchandise_revenue": "CAST(sum(item_price) AS DECIMAL(38,2))",
    "item_freight_revenue": "CAST(sum(freight_value) AS DECIMAL(38,2))",
    "item_count": "count(order_item_id)",
}


def metric_sql(view: str, measures: dict[str, str], names: list[str], by: list[str], where: str = "") -> str:
    cols = ", ".join(by + [f"{measures[n]} AS {n}" for n in names])
    sql = f"SELECT {cols} FROM {view}"
    if where:
        sql += f" WHERE {where}"
    if by:
        sql += " GROUP BY " + ", ".join(by)
    return sql


METRICS: dict[str, str] = {
    "metrics_orders_by_month": metric_sql(
        "semantic_order_metrics", _ORDER_MEASURES, list(_ORDER_MEASURES), ["purchase_month"]
    ),
    "metrics_orders_total": metric_sql("semantic_order_metrics", _ORDER_MEASURES, list(_ORDER_MEASURES), []),
    "metrics_delivered_by_state": metric_sql(
        "semantic_order_metrics",
        _ORDER_MEASURES,
        ["orders", "on_time_delivery_rate", "late_delivery_orders", "average_order_value"],
        ["customer_state"],
        where="order_status = 'delivered'",
    ),
    "metrics_items_by_category_state": metric_sql(
        "semantic_product_metrics",
        _PRODUCT_MEASURES,
        list(_PRODUCT_MEASURES),
        ["product_category_name_english", "seller_state"],
    ),
}


# --- quality --------------------------------------------------------------

# The order status domain.
_STATUSES = "'delivered', 'invoiced', 'shipped', 'processing', 'unavailable', 'canceled', 'created', 'approved'"


def _result(order: int, name: str, passed: str, details: str, observed: str, severity: str = "error") -> str:
    return (
        f"SELECT {order} AS check_order, '{name}' AS name, coalesce(({passed}), false) AS passed, '{severity}' AS severity, "
        f"'{details}' AS details, CAST(({observed}) AS VARCHAR) AS observed"
    )


def _key_check(order: int, table: str, key: str, label: str) -> str:
    stats = f"SELECT count(*) AS n, count({key}) AS nn, count(DISTINCT {key}) AS dk FROM {table}"
    row = _result(
        order,
        f"unique_{table}_{label}",
        "n = nn AND nn = dk",
        "Every row has a key and no key repeats",
        "to_json({'rows': n, 'non_null': nn, 'distinct_keys': dk})",
    )
    return f"{row} FROM ({stats})"


def _orphans(order: int, child: str, parent: str, key: str) -> str:
    stats = (
        f"SELECT count(*) AS orphan_rows FROM {child} c WHERE c.{key} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"
    )
    row = _result(order, f"relationship_{child}_{parent}", "orphan_rows = 0", "Every reference has a row to refer to", "orphan_rows")
    return f"{row} FROM ({stats})"


_ITEM_KEY = "order_id || '|' || CAST(order_item_id AS VARCHAR)"

_CHECKS = [
    _key_check(1, "fct_orders", "order_id", "order_id"),
    _key_check(2, "fct_order_items", _ITEM_KEY, "order_id || ''|'' || order_item_id"),
    _key_check(3, "dim_customers", "customer_id", "customer_id"),
    _key_check(4, "dim_products", "product_id", "product_id"),
    _key_check(5, "dim_sellers", "seller_id", "seller_id"),
    _orphans(6, "fct_order_items", "fct_orders", "order_id"),
    _orphans(7, "fct_order_items", "dim_products", "product_id"),
    _orphans(8, "fct_order_items", "dim_sellers", "seller_id"),
    _orphans(9, "fct_orders", "dim_customers", "customer_id"),
    _result(
        10,
        "accepted_order_statuses",
        "len(bad) = 0",
        "No status outside the known eight",
        "to_json(bad)",
    )
    + f""" FROM (SELECT coalesce(list_sort(list(DISTINCT order_status) FILTER (
              WHERE order_status IS NOT NULL AND order_status NOT IN ({_STATUSES}))), []::VARCHAR[]) AS bad
      FROM fct_orders)""",
    _result(
        11,
        "non_negative_item_values",
        "neg_p + neg_f = 0",
        "No item with a price or freight below zero",
        "to_json({'negative_price': neg_p, 'negative_freight': neg_f})",
    )
    + """ FROM (SELECT CAST(count_if(item_price < 0) AS BIGINT) AS neg_p,
                   CAST(count_if(freight_value < 0) AS BIGINT) AS neg_f FROM fct_order_items)""",
    _result(12, "review_score_range", "bad = 0", "No raw review score outside 1 to 5", "bad")
    + """ FROM (SELECT CAST(count_if(review_score < 1 OR review_score > 5) AS BIGINT) AS bad
           FROM raw_order_reviews)""",
    _result(
        13,
        "timestamp_ordering",
        "a + b + c = 0",
        "Orders whose steps are out of sequence",
        "to_json({'approved_before_purchase': a, 'carrier_before_purchase': b, 'customer_before_carrier': c})",
        severity="warning",
    )
    + """ FROM (SELECT CAST(count_if(order_approved_at < order_purchase_timestamp) AS BIGINT) AS a,
                   CAST(count_if(order_delivered_carrier_date < order_purchase_timestamp) AS BIGINT) AS b,
                   CAST(count_if(order_delivered_customer_date < order_delivered_carrier_date) AS BIGINT) AS c
            FROM fct_orders)""",
    _result(
        14,
        "revenue_reconciliation",
        "abs(diff) < 0.01",
        "Revenue summed over items equals revenue summed over orders",
        "diff",
    )
    + """ FROM (SELECT round(i.r - o.r, 2) AS diff
            FROM (SELECT round(sum(item_price), 2) AS r FROM fct_order_items) i,
                 (SELECT round(sum(merchandise_revenue), 2) AS r FROM fct_orders) o)""",
]

QUALITY_CHECKS = "\nUNION ALL\n".join(_CHECKS)


def _test(order: int, name: str, failures_sql: str, kind: str, severity: str = "error") -> str:
    details = {
        "not_null": "Rows without a value",
        "unique": "Values found more than once",
        "relationships": "Rows that refer to nothing",
        "accepted_values": "Values outside the list",
    }[kind]
    return (
        f"SELECT {order} AS check_order, '{name}' AS name, coalesce(f = 0, false) AS passed, '{severity}' AS severity, "
        f"'{details}' AS details, CAST(f AS VARCHAR) AS observed FROM ({failures_sql})"
    )


def _not_null(table: str, col: str) -> str:
    return f"SELECT CAST(count_if({col} IS NULL) AS BIGINT) AS f FROM {table}"


def _unique(table: str, col: str) -> str:
    return (
        f"SELECT count(*) AS f FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL "
        f"GROUP BY {col} HAVING count(*) > 1)"
    )


def _relationship(table: str, col: str, parent: str) -> str:
    return (
        f"SELECT count(*) AS f FROM {table} c WHERE c.{col} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{col} = c.{col})"
    )


COLUMN_TESTS = "\nUNION ALL\n".join(
    [
        _test(1, "not_null_fct_orders_order_id", _not_null("fct_orders", "order_id"), "not_null"),
        _test(2, "unique_fct_orders_order_id", _unique("fct_orders", "order_id"), "unique"),
        _test(3, "not_null_fct_orders_customer_id", _not_null("fct_orders", "customer_id"), "not_null"),
        _test(
            4,
            "relationships_fct_orders_customer_id__dim_customers",
            _relationship("fct_orders", "customer_id", "dim_customers"),
            "relationships",
        ),
        _test(
            5,
            "accepted_values_fct_orders_order_status",
            f"SELECT count(DISTINCT CASE WHEN order_status NOT IN ({_STATUSES}) THEN order_status END) AS f "
            "FROM fct_orders",
            "accepted_values",
        ),
        _test(
            6,
            "not_null_fct_orders_merchandise_revenue",
            _not_null("fct_orders", "merchandise_revenue"),
            "not_null",
            severity="warning",
        ),
        _test(7, "not_null_fct_order_items_order_id", _not_null("fct_order_items", "order_id"), "not_null"),
        _test(
            8,
            "relationships_fct_order_items_order_id__fct_orders",
            _relationship("fct_order_items", "order_id", "fct_orders"),
            "relationships",
        ),
        _test(9, "not_null_fct_order_items_order_item_id", _not_null("fct_order_items", "order_item_id"), "not_null"),
        _test(
            10,
            "relationships_fct_order_items_product_id__dim_products",
            _relationship("fct_order_items", "product_id", "dim_products"),
            "relationships",
        ),
        _test(
            11,
            "relationships_fct_order_items_seller_id__dim_sellers",
            _relationship("fct_order_items", "seller_id", "dim_sellers"),
            "relationships",
        ),
        _test(12, "not_null_dim_products_product_id", _not_null("dim_products", "product_id"), "not_null"),
        _test(13, "unique_dim_products_product_id", _unique("dim_products", "product_id"), "unique"),
        _test(14, "not_null_dim_customers_customer_id", _not_null("dim_customers", "customer_id"), "not_null"),
        _test(15, "unique_dim_customers_customer_id", _unique("dim_customers", "customer_id"), "unique"),
        _test(16, "not_null_dim_sellers_seller_id", _not_null("dim_sellers", "seller_id"), "not_null"),
        _test(17, "unique_dim_sellers_seller_id", _unique("dim_sellers", "seller_id"), "unique"),
    ]
)

# The given tables are typed, so no value fails to parse.
_STAGED = [
    "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews", "stg_customers",
    "stg_products", "stg_sellers", "stg_geolocation", "stg_category_translation",
]

QUALITY: dict[str, str] = {
    "coercion_checks": "\nUNION ALL\n".join(
        _result(i, f"coerced_values_{t}", "n = 0", "Raw values that did not parse and are NULL", "n", severity="warning")
        + f" FROM (SELECT 0 * count(*) AS n FROM {t})"
        for i, t in enumerate(_STAGED, start=1)
    ),
    "quality_checks": QUALITY_CHECKS,
    "quality_verdict": f"""
SELECT count(*) > 0 AND count_if(NOT coalesce(passed, false) AND severity <> 'warning') = 0 AS passed,
       count(*) AS check_count,
       CAST(count_if(NOT passed AND severity = 'error') AS BIGINT) AS failed_count,
       CAST(count_if(NOT passed AND severity = 'warning') AS BIGINT) AS warning_count
FROM ({QUALITY_CHECKS})""",
    "column_tests": COLUMN_TESTS,
    "lineitem_key_check": _result(
        1,
        "unique_lineitem_l_orderkey || ''|'' || l_linenumber",
        "n = nn AND nn = dk",
        "Every row has a key and no key repeats",
        "to_json({'rows': n, 'non_null': nn, 'distinct_keys': dk})",
    )
    + """ FROM (SELECT count(*) AS n, count(k) AS nn, count(DISTINCT k) AS dk
            FROM (SELECT CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS k FROM lineitem))""",
    "row_constraint_summary": """
SELECT 'valid_order_id' AS constraint_name, CAST(count_if(NOT coalesce(order_id IS NOT NULL, false)) AS BIGINT)
       AS violating_rows FROM stg_order_items
UNION ALL
SELECT 'non_negative_price', CAST(count_if(NOT coalesce(item_price >= 0, false)) AS BIGINT) FROM stg_order_items""",
}


# --- repeat customers, distributions, monitoring, incremental load, access ----

_PER_PERSON = """(SELECT customer_unique_id, count(*) AS orders, sum(merchandise_revenue) AS revenue
      FROM semantic_order_metrics WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id)"""
_PER_COUNT = f"""(SELECT orders AS orders_per_customer, count(*) AS customers, sum(orders) AS orders, sum(revenue) AS revenue
      FROM {_PER_PERSON} GROUP BY orders)"""


def _share(x: str) -> str:
    return spark_round(f"CAST({x} AS DOUBLE) / NULLIF(CAST(sum({x}) OVER () AS DOUBLE), 0)", 4)


# The monitored tables, their timestamps and the age in days up to which they are fresh.
_MONITORED = (
    ("stg_orders", "stg_orders", "order_purchase_timestamp", 2),
    ("stg_order_item_values", "stg_order_items", "shipping_limit_date", 30),
    ("stg_order_reviews", "stg_order_reviews", "review_creation_timestamp", 2),
)

_DAYS = " UNION ALL ".join(
    f"""SELECT '{label}' AS "table", CAST(d AS DATE) AS day, coalesce(n, 0) AS n FROM
    (SELECT unnest(generate_series(min(CAST({ts} AS DATE)), max(CAST({ts} AS DATE)), INTERVAL 1 DAY)) AS d FROM {table}) AS days_{i}
    LEFT JOIN (SELECT CAST({ts} AS DATE) AS day, count(*) AS n FROM {table} GROUP BY 1) AS counts_{i} ON day = CAST(d AS DATE)"""
    for i, (label, table, ts, _) in enumerate(_MONITORED)
)
_POLICY = """(SELECT 'manager ' || lower(r_name) AS role, r_name AS value FROM region
      UNION ALL SELECT 'manager', r_name FROM region)"""
_MASKED = "sha256('12:example salt' || customer_unique_id)"

EXTENSIONS: dict[str, str] = {
    "orders_per_customer": f"""
SELECT orders_per_customer, customers, CAST(orders AS BIGINT) AS orders, CAST(revenue AS DECIMAL(38,2)) AS merchandise_revenue,
       {_share('customers')} AS customer_share, {_share('orders')} AS order_share, {_share('revenue')} AS revenue_share
FROM {_PER_COUNT}""",
    "repeat_customers": f"""
SELECT count(*) AS customers, count(*) FILTER (orders > 1) AS repeat_customers,
       {spark_round('CAST(count(*) FILTER (orders > 1) AS DOUBLE) / NULLIF(count(*), 0)', 4)} AS repeat_share,
       {spark_round('CAST(sum(orders) AS DOUBLE) / NULLIF(count(*), 0)', 4)} AS orders_per_customer,
       max(orders) AS most_orders,
       {spark_round('CAST(sum(orders) FILTER (orders > 1) AS DOUBLE) / NULLIF(sum(orders), 0)', 4)} AS repeat_order_share,
       {spark_round('CAST(sum(revenue) FILTER (orders > 1) AS DOUBLE) / NULLIF(CAST(sum(revenue) AS DOUBLE), 0)', 4)} AS repeat_revenue_share
FROM {_PER_PERSON}""",
    "repeat_interval": """
SELECT CAST(date_diff('month', first, second) AS INTEGER) AS months_between, count(*) AS customers
FROM (SELECT customer_unique_id, min(purchase_month) AS first, min(purchase_month) FILTER (place = 2) AS second
      FROM (SELECT customer_unique_id, purchase_month, dense_rank() OVER (PARTITION BY customer_unique_id ORDER BY purchase_month) AS place
            FROM semantic_order_metrics WHERE customer_unique_id IS NOT NULL AND purchase_month IS NOT NULL) AS ranked
      GROUP BY customer_unique_id) AS people
WHERE second IS NOT NULL GROUP BY 1""",
    "review_distribution": f"""
SELECT review_score, count(*) AS reviews, count(DISTINCT order_id) AS orders,
       {spark_round('CAST(count(*) AS DOUBLE) / sum(count(*)) OVER ()', 4)} AS review_share
FROM stg_order_reviews GROUP BY review_score""",
    "payment_distribution": f"""
SELECT payment_type, count(*) AS payments, count(DISTINCT order_id) AS orders,
       CAST(sum(payment_value) AS DECIMAL(38,2)) AS payment_value,
       {spark_round('CAST(sum(payment_value) AS DOUBLE) / CAST(sum(sum(payment_value)) OVER () AS DOUBLE)', 4)} AS value_share,
       {rounded_mean('payment_installments', 4)} AS average_installments
FROM stg_order_payments GROUP BY payment_type""",
    "freshness": """
SELECT *, CAST(date_diff('day', latest, as_of) AS INTEGER) AS age_days, coalesce(date_diff('day', latest, as_of) <= max_age_days, false) AS fresh
FROM (SELECT *, max(latest) OVER () AS as_of FROM (""" + " UNION ALL ".join(
        f"""SELECT '{label}' AS "table", count(*) AS rows, CAST(max({ts}) AS DATE) AS latest, {age} AS max_age_days FROM {table}"""
        for label, table, ts, age in _MONITORED
    ) + ") AS seen) AS dated",
    "volume_anomalies": f"""
SELECT "table", day, n AS rows, history_days, {spark_round('mean', 4)} AS trailing_mean, {spark_round('ratio', 4)} AS ratio,
       CASE WHEN history_days >= 7 AND ratio < 0.5 THEN 'low' WHEN history_days >= 7 AND ratio > 2 THEN 'high' END AS anomaly
FROM (SELECT *, n / NULLIF(mean, 0) AS ratio FROM (
    SELECT "table", day, n, count(*) OVER before AS history_days, CAST(sum(n) OVER before AS DOUBLE) / count(*) OVER before AS mean
    FROM ({_DAYS}) AS days
    WINDOW before AS (PARTITION BY "table" ORDER BY day RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)
) AS framed) AS judged""",
    "events_latest": """
SELECT user_id, event_type, event_id, ts, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type
        ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) AS place FROM events
) AS ranked WHERE place = 1""",
    "restricted_order_metrics": f"""
SELECT * REPLACE ({_MASKED} AS customer_unique_id) FROM semantic_order_metrics
WHERE customer_state IN (SELECT value FROM {_POLICY} AS policy WHERE role = 'manager asia')""",
    "orders_visible_by_role": f"""
SELECT role, count(*) AS orders, count(DISTINCT {_MASKED}) AS customers, {money_total('merchandise_revenue')} AS merchandise_revenue
FROM semantic_order_metrics JOIN {_POLICY} AS policy ON customer_state = value GROUP BY role""",
}


TABLES = [
    "raw_orders", "raw_order_items", "raw_order_payments", "raw_order_reviews", "raw_customers",
    "raw_products", "raw_sellers", "raw_geolocation", "raw_category_translation",
    "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews", "stg_customers",
    "stg_products", "stg_sellers", "stg_geolocation", "stg_category_translation",
    "dim_customers", "dim_sellers", "dim_products", "dim_geography",
    "fct_order_items", "fct_orders", "semantic_order_metrics", "semantic_product_metrics",
]


def statements() -> dict[str, str]:
    """Query name -> DuckDB statement."""
    out = {t: with_ctes(f"SELECT * FROM {t}") for t in TABLES}
    out.update({f"{t}_from_text": out[t] for t in TABLES if t.startswith("stg_")})
    for group in (REPORTS, METRICS, QUALITY, EXTENSIONS):
        out.update({k: with_ctes(v) for k, v in group.items()})
    return out
