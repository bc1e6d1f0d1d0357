"""Metric catalogue: allowed dimensions, derived measures, slicers."""

from __future__ import annotations

import os

import pytest

from emporium.operators.semantic import CATALOGUE, MetricError, metric_query
from emporium.plans.model import Model
from emporium.sources.csv import load_raw
from extracts import BASE, write_extracts


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    d = write_extracts(str(tmp_path_factory.mktemp("sem")), BASE)
    return Model(load_raw(spark, d))


def test_catalogue_declares_both_models():
    assert set(CATALOGUE) == {"order_metrics", "product_metrics"}
    assert "average_order_value" in CATALOGUE["order_metrics"].measures


def test_order_measures(model):
    r = metric_query(model, "order_metrics", list(CATALOGUE["order_metrics"].measures)).first()
    assert float(r["merchandise_revenue"]) == 349.0
    assert float(r["order_total_value"]) == 407.75
    assert r["average_order_value"] == 174.5
    assert r["late_delivery_orders"] == 1
    assert r["on_time_delivery_rate"] == 0.5


def test_grouping_and_slicer(model):
    rows = metric_query(model, "product_metrics", ["item_count", "item_merchandise_revenue"],
                        by=["product_category_name_english"]).collect()
    assert {r["product_category_name_english"]: r["item_count"] for r in rows} == {
        "tools": 1, "garden": 3}
    none = metric_query(model, "order_metrics", ["orders"], by=["customer_state"],
                        where="order_status = 'canceled'").collect()
    assert none == []


def test_dimension_from_the_other_grain_is_refused(model):
    with pytest.raises(MetricError):
        metric_query(model, "order_metrics", ["merchandise_revenue"], by=["product_category_name_english"])
    with pytest.raises(MetricError):
        metric_query(model, "product_metrics", ["orders"])
