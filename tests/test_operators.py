"""Smaller operators: create-if-absent landing, row constraints, display order, SQL parameters."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from emporium.operators import quality, reports
from emporium.plans.model import Model
from emporium.sources import bronze
from emporium.sources.csv import load_raw
from emporium.sources.sql import run_sql
from extracts import BASE, extended, write_extracts


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    rows = extended(order_items=[{"order_id": "A2", "order_item_id": "2", "product_id": "hose",
                                  "seller_id": "v2", "price": "-2.0", "freight_value": "0.0"},
                                 {"order_item_id": "1", "product_id": "drill", "seller_id": "v1",
                                  "price": "1.0", "freight_value": "0.0"}])
    d = write_extracts(str(tmp_path_factory.mktemp("ops")), rows)
    return Model(load_raw(spark, d))


def test_split_and_enforce_row_constraints(model):
    cons = quality.row_constraints()
    accepted, quarantined = quality.split_by_constraints(model.stg_order_items, cons)
    assert accepted.count() == 4
    bad = {tuple(r["violations"]) for r in quarantined.collect()}
    assert bad == {("non_negative_price",), ("valid_order_id",)}
    summary = {r["constraint_name"]: r["violating_rows"]
               for r in quality.constraint_summary(model.stg_order_items, cons).collect()}
    assert summary == {"valid_order_id": 1, "non_negative_price": 1}
    with pytest.raises(Exception, match="constraint violated"):
        quality.enforce_constraints(model.stg_order_items, cons, "stg_order_items").collect()


def test_create_if_absent_keeps_the_first_landing(spark, model):
    spark.sql("CREATE DATABASE IF NOT EXISTS ops_bronze")
    bronze.land({"sellers": model.raw["sellers"]}, "ops_bronze")
    first = spark.table("ops_bronze.raw_sellers").agg(F.max("_ingested_at")).first()[0]
    bronze.land({"sellers": model.raw["sellers"]}, "ops_bronze", if_absent=True)
    assert spark.table("ops_bronze.raw_sellers").agg(F.max("_ingested_at")).first()[0] == first
    assert spark.table("ops_bronze.raw_sellers").count() == 2


def test_top_categories_display_order(model):
    top = [r["category"] for r in reports.top_categories(model, limit=2).collect()]
    shown = [r["category"] for r in reports.top_categories(model, limit=2, display_ascending=True).collect()]
    assert shown == list(reversed(top))
    assert [r["category"] for r in reports.top_categories(model, limit=1).collect()] == top[:1]


def test_parameterised_sql(spark, model):
    model.fct_orders.createOrReplaceTempView("ops_orders")
    rows = run_sql(spark, "SELECT order_id FROM ops_orders WHERE order_status = :s LIMIT :n",
                   s="delivered", n=5).collect()
    assert sorted(r["order_id"] for r in rows) == ["A1", "A2"]
