"""Key tables of the checks, and uniqueness proven once for published tables."""

from __future__ import annotations

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from emporium.operators import quality, reports
from emporium.operators.quality import KeyTables, key_table
from emporium.plans import proofs, warehouse
from emporium.plans.model import Model
from emporium.sources.csv import load_raw
from extracts import BASE, extended, write_extracts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_table_is_brute_force(spark):
    rnd = random.Random(1)
    parents = [(rnd.choice([None, *range(20)]),) for _ in range(30)]
    children = [(rnd.choice([7] * 10 + [None, *range(15, 40)]),) for _ in range(300)]
    got = {r["k"]: (r["parent_rows"], r["child_rows"]) for r in key_table(("k",), spark.createDataFrame(parents, "k int"), spark.createDataFrame(children, "k int")).collect()}
    assert got == {k: (parents.count((k,)), children.count((k,))) for k in {r[0] for r in parents + children}}


@pytest.fixture()
def raw(spark, tmp_dir):
    more = extended(
        order_items=[{"order_id": "A1", "order_item_id": "1", "product_id": "lost", "seller_id": "v1", "price": "1", "freight_value": "1"},
                     {"order_id": "gone", "order_item_id": "", "product_id": "hose", "seller_id": "lost", "price": "1", "freight_value": "1"}],
        sellers=[{"seller_id": "", "seller_state": "XX"}],
    )
    return load_raw(spark, write_extracts(os.path.join(tmp_dir, "raw"), more))


def test_checks_from_key_tables(raw):
    rows = {r["name"]: r for r in quality.quality_checks(Model(raw)).collect()}
    items = json.loads(rows["unique_fct_order_items_order_id || '|' || order_item_id"]["observed"])
    assert items == {"rows": 6, "non_null": 5, "distinct_keys": 4}
    assert json.loads(rows["unique_dim_sellers_seller_id"]["observed"]) == {"rows": 3, "non_null": 2, "distinct_keys": 2}
    orphans = {n: r["observed"] for n, r in rows.items() if n.startswith("relationship_")}
    assert orphans == {"relationship_fct_order_items_fct_orders": "1", "relationship_fct_order_items_dim_products": "1",
                       "relationship_fct_order_items_dim_sellers": "1", "relationship_fct_orders_dim_customers": "0"}
    tests = {r["name"]: r["observed"] for r in quality.column_tests(Model(raw)).collect()}
    assert tests["not_null_dim_sellers_seller_id"] == "1" and tests["unique_dim_sellers_seller_id"] == "0"
    assert tests["relationships_fct_order_items_seller_id__dim_sellers"] == "1" and tests["not_null_fct_order_items_order_item_id"] == "1"


def test_item_keys_cross_one_shuffle(spark, raw):
    stored = Model(raw)
    for name in ("fct_orders", "fct_order_items", "dim_customers", "dim_products", "dim_sellers"):
        path = f"{spark.sparkContext.getConf().get('spark.checkpoint.dir')}/keys-test-{name}"
        getattr(stored, name).write.mode("overwrite").parquet(path)
        stored.__dict__[name] = spark.read.parquet(path)
    plan = _plan(quality.quality_checks(stored))
    by_item = [line for line in plan.splitlines() if "Exchange hashpartitioning(order_id" in line and "order_item_id" in line]
    assert len(by_item) == 1 and "concat(" not in plan
    keys = KeyTables(stored, keep=True)
    for df in (quality.quality_checks(stored, keys), quality.column_tests(stored, keys=keys)):
        # kept key tables are read: no key is shuffled for a check any more
        assert "hashpartitioning(order_id" not in _plan(df) and "hashpartitioning(product_id" not in _plan(df)
    assert quality.quality_checks(stored, keys).collect() == quality.quality_checks(stored).collect()


def test_a_long_status_list_says_so(spark, raw):
    statuses = spark.range(quality.LISTED_STATUSES + 5).select(F.format_string("s%05d", "id").alias("order_status"))
    stats = quality._status_list(statuses.withColumn("order_id", F.lit("x"))).select(quality._statuses_observed().alias("o"))
    found = json.loads(stats.first()["o"])
    assert found["statuses"] == quality.LISTED_STATUSES + 5 and found["all_in"] == "invalid_statuses"
    assert len(found["listed"]) == quality.LISTED_STATUSES
    assert quality.invalid_statuses(statuses).count() == quality.LISTED_STATUSES + 5


@pytest.fixture()
def published(spark, tmp_dir):
    layers = warehouse.Layers("pk_bronze", "pk_silver", "pk_gold", "pk_semantic")
    warehouse.build(spark, load_raw(spark, write_extracts(os.path.join(tmp_dir, "raw"), BASE)), layers)
    return layers


REPORTS = (reports.kpis, reports.monthly_orders, reports.state_performance, reports.on_time_by_state)


def test_proven_orders_are_not_shuffled_again(spark, published):
    model, counted = warehouse.published_model(spark, published), warehouse.published_model(spark, published)
    assert model.unique_orders
    counted.__dict__["unique_orders"] = False
    for report in REPORTS:
        with_proof, without = report(model), report(counted)
        assert sorted(with_proof.collect()) == sorted(without.collect())
        assert "order_id" not in "".join(x for x in _plan(with_proof).splitlines() if "Exchange hashpartitioning" in x)
        assert _plan(with_proof).count("Exchange") < _plan(without).count("Exchange") or report is reports.kpis
    # over one read of the fact: a single exchange, and the number of orders is not expanded
    assert "Expand" in _plan(reports.kpis(counted)) and "Expand" not in _plan(reports.kpis(model))
    assert _plan(reports.delivery_distribution(model)).count("Exchange hashpartitioning") == 1


def test_a_proof_does_not_outlive_its_rows(spark, published):
    table = "pk_gold.fct_orders"
    assert proofs.holds(spark, table, "order_id") and not proofs.holds(spark, table, "customer_id")
    spark.table(table).limit(1).write.insertInto(table)
    again = warehouse.published_model(spark, published)
    assert not again.unique_orders and reports.kpis(again).first()["orders"] == 2
    spark.createDataFrame(again.fct_orders.limit(3).collect(), again.fct_orders.schema).write.mode("overwrite").saveAsTable(table)
    assert not proofs.holds(spark, table, "order_id")


def test_a_repeated_order_stops_the_build(spark, tmp_dir):
    twice = extended(orders=[dict(BASE["orders"][0], customer_id="k2")])
    raw = load_raw(spark, write_extracts(os.path.join(tmp_dir, "raw"), twice))
    layers = warehouse.Layers("pk2_bronze", "pk2_silver", "pk2_gold", "pk2_semantic")
    with pytest.raises(proofs.DuplicateKeyError, match=r"duplicate key \(order_id\) in orders: 1 keys repeat"):
        warehouse.build(spark, raw, layers)
    with pytest.raises(Exception, match="duplicate key"):
        reports.kpis(Model(raw)).collect()


def test_the_report_lists_all_that_the_gate_judges(spark, tmp_dir):
    odd = extended(orders=[{"order_id": "A9", "order_status": "odd"}])
    raw = load_raw(spark, write_extracts(os.path.join(tmp_dir, "raw"), odd))
    report = os.path.join(tmp_dir, "report")
    layers = warehouse.Layers("pk3_bronze", "pk3_silver", "pk3_gold", "pk3_semantic")
    with pytest.raises(warehouse.QualityGateError):
        warehouse.build(spark, raw, layers, report_path=report)
    doc = json.loads(open(glob.glob(report + "/part-*")[0]).read())
    assert len(doc["checks"]) == 14 and len(doc["column_tests"]) == 17 and len(doc["coercion_checks"]) == 9
    assert doc["gate"]["check_count"] == 40 and not doc["gate"]["passed"]
    failed = [r["name"] for name in ("checks", "column_tests") for r in doc[name] if not r["passed"] and r["severity"] == "error"]
    assert len(failed) == doc["gate"]["failed_count"]
    assert spark.table("pk3_gold.invalid_statuses").collect() == [("odd", 1)]
