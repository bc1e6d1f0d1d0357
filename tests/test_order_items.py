from emporium.operators.marts import order_item_metrics


def test_item_rows_are_not_multiplied_for_distinct_counts(spark):
    rows = [("o1", "p1", "s1"), ("o1", "p1", "s2"), ("o1", "p2", "s2"), ("o2", None, "s1"), ("o2", None, None), ("o3", None, None), (None, "p1", "s1")]
    items = spark.createDataFrame(
        [(*r, 1.25, 0.5) for r in rows], "order_id string, product_id string, seller_id string, item_price double, freight_value double"
    ).selectExpr("order_id", "product_id", "seller_id", "cast(item_price AS decimal(18,2)) AS item_price", "cast(freight_value AS decimal(18,2)) AS freight_value")
    got = order_item_metrics(items)
    assert dict(got.dtypes)["distinct_product_count"] == dict(got.dtypes)["distinct_seller_count"] == "bigint"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1
    assert {r.order_id: (r.item_count, r.distinct_product_count, r.distinct_seller_count, float(r.merchandise_revenue)) for r in got.collect()} == {
        "o1": (3, 2, 2, 3.75), "o2": (2, 0, 1, 2.5), "o3": (1, 0, 0, 1.25), None: (1, 1, 1, 1.25),
    }
