"""Warehouse build over CSV extracts: layers, tables, views, reports, gate."""

from __future__ import annotations

import glob
import json
import os

import pytest

from emporium.plans import sinks, warehouse
from emporium.plans.model import Model
from emporium.sources.csv import load_raw
from emporium.sources.sql import MissingTableError, require_tables, run_sql
from extracts import BASE, extended, write_extracts


def test_build_publishes_and_passes(spark, tmp_dir):
    raw = load_raw(spark, write_extracts(os.path.join(tmp_dir, "raw"), BASE))
    layers = warehouse.Layers("t1_bronze", "t1_silver", "t1_gold", "t1_semantic")
    report = os.path.join(tmp_dir, "quality_report")
    snap = os.path.join(tmp_dir, "snapshot")
    result = warehouse.build(spark, raw, layers, buckets=4, report_path=report, snapshot_path=snap)
    assert result.verdict["passed"]
    counts = {r["table"]: r["rows"] for r in result.summary.collect()}
    assert counts["t1_gold.fct_orders"] == 2 and counts["t1_gold.fct_order_items"] == 4
    assert spark.table("t1_bronze.raw_orders").columns[-1] == "_ingested_at"
    assert spark.table("t1_semantic.semantic_order_metrics").count() == 2
    silver = {t.name for t in spark.catalog.listTables("t1_silver") if not t.isTemporary}
    assert len(silver) == 9 and spark.table("t1_silver.stg_order_items").count() == 4
    assert spark.table("t1_silver.stg_order_items").dtypes == Model(raw).stg_order_items.dtypes
    assert spark.table("t1_gold.dim_date").count() == 47  # 5 March to 20 April 2018
    assert spark.table("t1_gold.column_tests").count() == 17 and spark.table("t1_gold.coercion_checks").count() == 9
    doc = json.loads(open(glob.glob(report + "/part-*")[0]).read())
    assert doc["passed"] and doc["check_count"] == 14 and len(doc["checks"]) == 14
    snapshot = json.loads(open(glob.glob(snap + "/part-*")[0]).read())
    assert snapshot["kpis"]["orders"] == 2
    assert snapshot["top_categories"][0]["category"] == "garden"
    assert "Order grain" in spark.catalog.getTable("t1_gold.fct_orders").description
    cols = {c.name: c.description for c in spark.catalog.listColumns("t1_gold.fct_orders")}
    assert "fractional" in cols["delivery_delay_days_exact"]
    top = run_sql(spark, "SELECT order_id FROM t1_gold.fct_order_items ORDER BY order_item_id LIMIT :n", n=1)
    assert top.first()["order_id"] in ("A1", "A2")
    require_tables(spark, ["t1_gold.fct_orders"])
    with pytest.raises(MissingTableError):
        require_tables(spark, ["t1_gold.nope", "t1_gold.fct_orders"])


def test_gate_fails_after_writing_the_report(spark, tmp_dir):
    bad = extended(order_items=[{"order_id": "A1", "order_item_id": "4", "product_id": "p_missing",
                                 "seller_id": "v1", "price": "1.0", "freight_value": "0.0"}])
    raw = load_raw(spark, write_extracts(os.path.join(tmp_dir, "raw"), bad))
    layers = warehouse.Layers("t2_bronze", "t2_silver", "t2_gold", "t2_semantic")
    with pytest.raises(warehouse.QualityGateError):
        warehouse.build(spark, raw, layers, buckets=2)
    failed = spark.table("t2_gold.quality_checks").where("NOT passed").collect()
    assert [r["name"] for r in failed] == ["relationship_fct_order_items_dim_products"]


def test_row_constraints_on_the_write_path(spark, tmp_dir):
    bad = extended(order_items=[{"order_id": "A1", "order_item_id": "4", "product_id": "hose",
                                 "seller_id": "v1", "price": "-1.0", "freight_value": "0.0"}])
    raw = load_raw(spark, write_extracts(os.path.join(tmp_dir, "raw"), bad))
    layers = warehouse.Layers("t3_bronze", "t3_silver", "t3_gold", "t3_semantic")
    with pytest.raises(Exception, match="constraint violated"):
        warehouse.build(spark, raw, layers, constraints="fail")
    result = warehouse.build(spark, raw, layers, constraints="quarantine", gate=False)
    assert spark.table("t3_gold.fct_order_items").count() == 4
    refused = spark.table(result.tables["quarantined_order_items"]).collect()
    assert [(r["order_item_id"], r["violations"]) for r in refused] == [(4, ["non_negative_price"])]


def test_descriptions_may_hold_quotes(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t4_silver")
    sinks.write_table(spark.range(3), "t4_silver.numbers", description="it's a \\ table")
    sinks.create_view(spark, "t4_silver.few", "t4_silver.numbers", ["id"], "it's a \\ view")
    assert spark.catalog.getTable("t4_silver.few").description == "it's a \\ view"
    assert spark.catalog.getTable("t4_silver.numbers").description == "it's a \\ table"
