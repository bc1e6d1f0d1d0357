"""Warehouse build: raw -> bronze -> staging views -> gold tables -> semantic
views -> quality reports -> build summary -> quality gate.

Every layer that is reused is written as a table and read back, so the
quality checks and reports run over stored data (an executor lost during the
checks recomputes from the tables, not from the raw sources).

With ``buckets``, the facts are stored bucketed on ``order_id`` so joins and
aggregations between them on that key read co-located files. It is off by
default: every row of one order lands in one bucket, so an order holding a
large share of the items would make one bucket (and its writer) hot.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession

from .. import session as _session
from ..operators import quality, reports
from ..operators.semantic import SEMANTIC_ORDER_COLUMNS, SEMANTIC_PRODUCT_COLUMNS
from ..operators.staging import STAGING, staging_sql
from ..sources import bronze
from ..sources.catalog import RAW_TABLES
from ..sources.tables import LazyTables
from . import proofs, sinks, snapshot
from .model import Model

# Table and column descriptions stored with the published tables.
TABLE_DESCRIPTIONS = {
    "dim_customers": "One row for each customer_id; rows of one person share customer_unique_id.",
    "dim_sellers": "Sellers with their location.",
    "dim_products": "Products with physical attributes and the English category name ('unknown' when untranslated).",
    "dim_geography": "One row per zip prefix: mean coordinates and a representative city and state.",
    "dim_date": "One row per day from the first to the last purchase date.",
    "fct_order_items": "Item grain: one row per (order_id, order_item_id), enriched with order, product and seller attributes.",
    "fct_orders": "Order grain: commercial, payment, review and delivery measures, one row per order_id.",
    "semantic_order_metrics": "Order-grain view for orders, customers, delivery and review metrics.",
    "semantic_product_metrics": "Item-grain view for category, seller, price and freight metrics.",
}
COLUMN_DESCRIPTIONS = {
    "order_id": "Order key (string).",
    "customer_unique_id": "Person identity; several customer_id values can share it.",
    "merchandise_revenue": "Sum of item prices of the order, excluding freight; NULL for an order without items.",
    "freight_revenue": "Sum of freight values of the order.",
    "delivery_days": "Calendar days from purchase to delivery.",
    "delivery_delay_days": "Calendar days from the estimated to the actual delivery date (negative = early).",
    "delivery_delay_days_exact": "Elapsed days from the estimated to the actual delivery time, fractional.",
    "on_time_delivery_flag": "1 when delivered by the estimated time, 0 when later, NULL when not evaluable.",
    "payment_types": "Distinct payment types of the order, sorted, comma-separated.",
    "item_total_value": "Item price plus freight.",
}


@dataclass(frozen=True)
class Layers:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    semantic: str = "semantic"

    def all(self) -> tuple[str, ...]:
        return (self.bronze, self.silver, self.gold, self.semantic)


@dataclass
class BuildResult:
    tables: dict[str, str]
    summary: DataFrame
    checks: DataFrame
    verdict: Row


class QualityGateError(RuntimeError):
    pass


DIMENSIONS = ("dim_customers", "dim_sellers", "dim_products", "dim_geography")
FACTS = ("fct_order_items", "fct_orders")


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    layers: Layers = Layers(),
    buckets: int | None = None,
    report_path: str | None = None,
    snapshot_path: str | None = None,
    gate: bool = True,
    constraints: str = "check",
) -> BuildResult:
    """Build the warehouse from the nine raw tables and run the quality gate.

    The gate looks at the runtime checks, the column tests and the counts of
    values that did not parse (warnings). ``constraints`` says what becomes of
    item rows that break a row constraint when the fact is written: ``check``
    leaves them to the checks, ``fail`` stops the write at the first one,
    ``quarantine`` stores them apart.

    The quality report (and, if asked, the metric snapshot) is written before
    the gate is applied, so a failing build still leaves its evidence.
    """
    if constraints not in ("check", "fail", "quarantine"):
        raise ValueError("constraints must be 'check', 'fail' or 'quarantine'")
    _session.prepare(spark)
    sinks.create_layers(spark, layers.all())

    # bronze: source shape + ingestion time
    bronze.land(raw, layers.bronze)
    landed = LazyTables(
        {
            name: (lambda name=name: spark.table(f"{layers.bronze}.raw_{name}").drop(bronze.INGESTED_AT))
            for name in RAW_TABLES
            if name in raw
        }
    )
    # One count of the order keys, which both facts and later the reports rely on.
    build_id = uuid.uuid4().hex
    orders = proofs.prove_unique(landed["orders"], ["order_id"], "orders")
    model = Model(landed, orders_proven=True)

    # silver: staging as persistent views over bronze
    tables: dict[str, str] = {}
    for name, (source, _) in STAGING.items():
        tables[name] = sinks.create_view(
            spark, f"{layers.silver}.{name}", f"{layers.bronze}.raw_{source}", staging_sql(name, landed[source]),
            f"Typed columns of raw_{source}; values that do not parse are NULL.",
        )

    # gold: dimensions and facts as tables, facts bucketed on order_id
    for name in DIMENSIONS + FACTS:
        relation = getattr(model, name)
        if name == "fct_order_items" and constraints == "fail":
            relation = quality.enforce_constraints(relation, quality.row_constraints(), name)
        elif name == "fct_order_items" and constraints == "quarantine":
            relation, refused = quality.split_by_constraints(relation, quality.row_constraints())
            tables["quarantined_order_items"] = sinks.write_table(
                refused, f"{layers.gold}.quarantined_order_items", description="Item rows that break a row constraint, with the names of those they break."
            )
        tables[name] = sinks.write_table(
            relation,
            f"{layers.gold}.{name}",
            bucket_by="order_id" if (buckets and name in FACTS) else None,
            buckets=buckets,
            description=TABLE_DESCRIPTIONS[name],
            column_descriptions=COLUMN_DESCRIPTIONS,
        )
    proofs.record(spark, tables["fct_orders"], "order_id", build_id, orders)
    stored = Model(landed)
    for name in DIMENSIONS + FACTS:
        stored.__dict__[name] = spark.table(tables[name])  # read back: cut lineage to the raw inputs
    tables["dim_date"] = sinks.write_table(reports.dim_date(stored), f"{layers.gold}.dim_date", description=TABLE_DESCRIPTIONS["dim_date"])

    # semantic: persistent views over the gold facts
    for name, source, cols in (
        ("semantic_order_metrics", "fct_orders", SEMANTIC_ORDER_COLUMNS),
        ("semantic_product_metrics", "fct_order_items", SEMANTIC_PRODUCT_COLUMNS),
    ):
        tables[name] = sinks.create_view(
            spark, f"{layers.semantic}.{name}", tables[source], cols, TABLE_DESCRIPTIONS[name]
        )

    # quality reports, written before the gate
    keys = quality.KeyTables(stored, keep=True)
    checks, column_tests, coerced = (
        spark.table(sinks.write_table(rows, f"{layers.gold}.{name}"))
        for name, rows in (
            ("quality_checks", quality.quality_checks(stored, keys)),
            ("column_tests", quality.column_tests(stored, keys=keys)),
            ("coercion_checks", quality.coercion_checks(stored)),
        )
    )
    sinks.write_table(
        quality.invalid_statuses(stored.fct_orders), f"{layers.gold}.invalid_statuses",
        description="Order statuses outside the known eight, with their orders.",
    )
    verdict = quality.verdict(checks.unionByName(column_tests).unionByName(coerced)).first()
    if report_path:
        report = snapshot.quality_report(checks, column_tests=column_tests, coercion_checks=coerced)
        sinks.write_document(report, report_path)
    if snapshot_path:
        sinks.write_document(snapshot.metric_snapshot(stored), snapshot_path)

    summary = sinks.row_counts(spark, [tables[n] for n in DIMENSIONS + FACTS])
    result = BuildResult(tables=tables, summary=summary, checks=checks, verdict=verdict)
    if gate and not verdict["passed"]:
        raise QualityGateError(
            f"quality gate failed: {verdict['failed_count']} of {verdict['check_count']} checks failed"
        )
    return result


class PublishedModel(Model):
    """A model whose marts are published tables; an order is one row if the build has proven it and nothing has changed since."""

    @property
    def spark(self) -> SparkSession:
        return self.fct_orders.sparkSession

    @cached_property
    def unique_orders(self) -> bool:
        return proofs.holds(self.spark, self.orders_table, "order_id")


def published_model(spark: SparkSession, layers: Layers = Layers()) -> Model:
    """A model whose marts and semantic views are the published tables."""
    from ..sources.sql import require_tables

    gold = [f"{layers.gold}.{n}" for n in DIMENSIONS + FACTS]
    require_tables(spark, gold)
    m = PublishedModel(LazyTables({}))
    m.orders_table = f"{layers.gold}.fct_orders"
    for name in DIMENSIONS + FACTS:
        m.__dict__[name] = spark.table(f"{layers.gold}.{name}")
    return m
