"""Repeat customers and distributions, worked out by hand."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest

from emporium.operators import reports
from emporium.plans.model import Model
from emporium.sources.csv import load_raw
from extracts import BASE, extended, write_extracts


@pytest.fixture()
def model(spark, tmp_dir):
    def order(i, customer, at):
        return {"order_id": i, "customer_id": customer, "order_status": "delivered", "order_purchase_timestamp": f"{at} 10:00:00"}

    more = extended(
        customers=[{"customer_id": "k3", "customer_unique_id": "ana", "customer_state": "RO"}, {"customer_id": "k4", "customer_unique_id": "eva"}],
        orders=[order("A3", "k3", "2018-07-01"), order("A4", "k1", "2018-07-30"), order("A5", "k4", "2019-01-01"), order("A6", "nobody", "2019-01-01")],
        order_items=[{"order_id": "A3", "order_item_id": "1", "product_id": "hose", "seller_id": "v1", "price": "100.00", "freight_value": "1.00"}],
        order_reviews=[{"review_id": "q9", "order_id": "A3"}, {"review_id": "q9", "order_id": "A4", "review_score": "5"}],
        order_payments=[{"order_id": "A3", "payment_sequential": "1", "payment_installments": "1", "payment_value": "101.00"}],
    )
    return Model(load_raw(spark, write_extracts(os.path.join(tmp_dir, "raw"), more)))


def test_orders_per_customer(model):
    # ana has A1 (100.00) and A3 (100.00) and A4 (nothing) under two ids, rui A2 (249.00), eva A5 (nothing); A6 is nobody's
    got = {r["orders_per_customer"]: r.asDict() for r in reports.orders_per_customer(model).collect()}
    assert set(got) == {1, 3}
    assert (got[3]["customers"], got[3]["orders"], got[3]["merchandise_revenue"]) == (1, 3, Decimal("200.00"))
    assert (got[1]["customers"], got[1]["orders"], got[1]["merchandise_revenue"]) == (2, 2, Decimal("249.00"))
    assert (got[3]["customer_share"], got[3]["order_share"], got[3]["revenue_share"]) == (0.3333, 0.6, 0.4454)


def test_repeat_customers(model):
    r = reports.repeat_customers(model).first().asDict()
    assert r == {"customers": 3, "repeat_customers": 1, "repeat_share": 0.3333, "orders_per_customer": 1.6667,
                 "most_orders": 3, "repeat_order_share": 0.6, "repeat_revenue_share": 0.4454}


def test_repeat_interval(model):
    # ana's orders are in March and twice in July
    assert [tuple(r) for r in reports.repeat_interval(model).collect()] == [(4, 1)]


def test_distributions(model):
    scores = {r["review_score"]: (r["reviews"], r["orders"], r["review_share"]) for r in reports.review_distribution(model).collect()}
    known = sum(1 for r in BASE["order_reviews"] if r["review_score"] == "5")
    total = len(BASE["order_reviews"]) + 2
    assert scores[None] == (1, 1, round(1 / total, 4)) and scores[5][0] == known + 1
    assert sum(n for n, _, _ in scores.values()) == total
    types = {r["payment_type"]: r.asDict() for r in reports.payment_distribution(model).collect()}
    assert types[None]["payment_value"] == Decimal("101.00") and types["boleto"]["payments"] == 1
    assert sum(t["payment_value"] for t in types.values()) == Decimal("508.75")
    assert types["boleto"]["value_share"] == round(280.10 / 508.75, 4) and types["credit_card"]["average_installments"] == 3.0


def test_nobody_and_empty_tables(spark, model):
    empty = Model({name: model.raw[name].limit(0) for name in model.raw})
    assert reports.orders_per_customer(empty).count() == 0 and reports.review_distribution(empty).count() == 0
    assert reports.repeat_customers(empty).first()["repeat_share"] is None


def test_people_are_counted_before_they_are_shuffled(model):
    plan = reports.orders_per_customer(model)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "collect_" not in plan
