"""The model over CSV extracts: two orders worked out by hand, and the edge cases."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from emporium.operators import quality, reports
from emporium.plans.model import Model, from_tpch
from emporium.sources.catalog import RAW_TABLES
from emporium.sources.csv import MissingInputError, load_raw, malformed_rows, read_extract, resolve_files
from extracts import BASE, extended, write_extracts

SF = "/root/testdata/sf0.001"


def model_of(spark, tmp_dir, tables, **kw):
    write_extracts(os.path.join(tmp_dir, "raw"), tables, **kw)
    return Model(load_raw(spark, os.path.join(tmp_dir, "raw")))


def test_two_orders(spark, tmp_dir):
    m = model_of(spark, tmp_dir, BASE)
    o = {r["order_id"]: r for r in m.fct_orders.collect()}
    assert set(o) == {"A1", "A2"} and m.fct_order_items.count() == 4
    # A1: 59.90 + 2 * 20.05; freight 12.35 + 2 * 7.65
    assert o["A1"]["merchandise_revenue"] == Decimal("100.00") and o["A1"]["freight_revenue"] == Decimal("27.65")
    assert o["A1"]["order_total_value"] == Decimal("127.65") and o["A1"]["payment_value"] == Decimal("127.65")
    assert (o["A1"]["item_count"], o["A1"]["distinct_product_count"], o["A1"]["distinct_seller_count"]) == (3, 2, 2)
    assert o["A1"]["payment_types"] == "credit_card, voucher" and o["A1"]["max_payment_installments"] == 3
    # bought 5 March, due 10 March 0:00, came 12 March 15:30
    assert (o["A1"]["delivery_days"], o["A1"]["delivery_delay_days"]) == (7, 2)
    assert o["A1"]["delivery_delay_days_exact"] == pytest.approx(2 + 15.5 / 24)
    assert (o["A1"]["on_time_delivery_flag"], o["A2"]["on_time_delivery_flag"]) == (0, 1)
    assert o["A2"]["delivery_delay_days"] == -7
    assert o["A2"]["delivery_delay_days_exact"] == pytest.approx(-7 + 11 / 24)
    assert (o["A1"]["average_review_score"], o["A2"]["average_review_score"]) == (2.0, 4.5)
    k = reports.kpis(m).first()
    assert k["merchandise_revenue"] == Decimal("349.00") and k["freight_revenue"] == Decimal("58.75")
    assert (k["orders"], k["customers"]) == (2, 2) and k["average_order_value"] == Decimal("174.50")
    assert k["on_time_delivery_rate"] == 0.5 and k["average_review_score"] == 3.25
    buckets = {r["delivery_bucket"]: r["orders"] for r in reports.delivery_distribution(m).collect()}
    assert buckets == {"1-7 days late": 1, "1-14 days early": 1}
    top = [(r["category"], r["merchandise_revenue"], r["orders"]) for r in reports.top_categories(m).collect()]
    assert top == [("garden", Decimal("289.10"), 2), ("tools", Decimal("59.90"), 1)]
    v = quality.verdict(quality.quality_checks(m)).first()
    assert v["passed"] and v["check_count"] == 14 and v["failed_count"] == 0


def _order(oid, cust="k1", status="delivered", purchase="2017-01-01 00:00:00", delivered=None,
           estimated="2017-01-10 00:00:00", carrier="2017-01-02 00:00:00", approved="2017-01-01 01:00:00"):
    return {"order_id": oid, "customer_id": cust, "order_status": status,
            "order_purchase_timestamp": purchase, "order_approved_at": approved,
            "order_delivered_carrier_date": carrier, "order_delivered_customer_date": delivered,
            "order_estimated_delivery_date": estimated}


def _item(oid, n, product="drill", seller="v1", price="10.0", freight="1.0"):
    return {"order_id": oid, "order_item_id": str(n), "product_id": product, "seller_id": seller,
            "shipping_limit_date": "2017-01-02 00:00:00", "price": price, "freight_value": freight}


EDGE = extended(
    orders=[
        _order("o_noitems", delivered="2017-01-05 00:00:00"),
        _order("o_same_day_late", delivered="2017-01-10 06:00:00"),
        _order("o_late_7_5", delivered="2017-01-17 12:00:00"),
        _order("o_early_half", delivered="2017-01-09 12:00:00"),
        _order("o_shipped", status="shipped"),
        _order("o_delivered_no_date", delivered=None),
        _order("o_pay", cust="c2", delivered="2017-01-03 00:00:00"),
        _order("o_nullpay", cust="c3", delivered="2017-01-03 00:00:00"),
    ],
    order_items=[
        _item("o_same_day_late", 1), _item("o_late_7_5", 1), _item("o_early_half", 1),
        _item("o_pay", 1, product="p_nocat"), _item("o_pay", 2, product="p_untranslated"),
        _item("o_nullpay", 1, price="oops"),
    ],
    order_payments=[
        {"order_id": "o_pay", "payment_sequential": "1", "payment_type": "voucher",
         "payment_installments": "1", "payment_value": "5.0"},
        {"order_id": "o_pay", "payment_sequential": "2", "payment_type": "boleto",
         "payment_installments": "3", "payment_value": "10.0"},
        {"order_id": "o_pay", "payment_sequential": "3", "payment_type": "voucher",
         "payment_installments": "1", "payment_value": "5.0"},
        {"order_id": "o_nullpay", "payment_sequential": "1", "payment_type": "",
         "payment_installments": "1", "payment_value": "1.0"},
    ],
    order_reviews=[
        {"review_id": "r2", "order_id": "o_pay", "review_score": "4",
         "review_comment_title": 'said "great", really', "review_comment_message": "line one\nline two, ok",
         "review_creation_date": "2017-01-06 00:00:00", "review_answer_timestamp": "not a time"},
        {"review_id": "r2", "order_id": "o_pay", "review_score": "2",
         "review_creation_date": "2017-01-06 00:00:00"},
        {"review_id": "r3", "order_id": "o_pay", "review_score": "3",
         "review_creation_date": "2017-01-06 00:00:00"},
    ],
    customers=[
        {"customer_id": "c2", "customer_unique_id": "ana", "customer_zip_code_prefix": "01037",
         "customer_city": "campinas", "customer_state": "PE"},
        {"customer_id": "c3", "customer_unique_id": "u3", "customer_zip_code_prefix": "20000",
         "customer_city": "rio", "customer_state": "RJ"},
    ],
    products=[
        {"product_id": "p_nocat", "product_category_name": ""},
        {"product_id": "p_untranslated", "product_category_name": "sem_traducao"},
    ],
    geolocation=[
        {"geolocation_zip_code_prefix": "04500", "geolocation_lat": "-12.70", "geolocation_lng": "-60.10",
         "geolocation_city": "cabixi", "geolocation_state": "RO"},
        {"geolocation_zip_code_prefix": "01037", "geolocation_lat": "-23.0", "geolocation_lng": "-46.0",
         "geolocation_city": "centro", "geolocation_state": "PE"},
        {"geolocation_zip_code_prefix": "", "geolocation_lat": "1", "geolocation_lng": "2",
         "geolocation_city": "x", "geolocation_state": "PE"},
    ],
)


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("edge"))
    return model_of(spark, d, EDGE, bom=True)


def test_delivery_semantics(edge):
    o = {r["order_id"]: r for r in edge.fct_orders.collect()}
    assert o["o_noitems"]["merchandise_revenue"] is None
    late = o["o_same_day_late"]
    assert late["delivery_delay_days"] == 0 and late["on_time_delivery_flag"] == 0
    assert late["delivery_delay_days_exact"] == 0.25
    assert o["o_shipped"]["on_time_delivery_flag"] is None
    assert o["o_delivered_no_date"]["on_time_delivery_flag"] is None
    exact = {r["delivery_bucket"]: r["orders"] for r in reports.delivery_distribution(edge).collect()}
    assert exact["8+ days late"] == 1  # 7.5 days late
    assert exact["On estimated date"] == 1  # half a day early
    assert exact["1-7 days late"] == 2  # 6 hours late on the day itself; A1
    whole = {r["delivery_bucket"]: r["orders"]
             for r in reports.delivery_distribution(edge, "delivery_delay_days").collect()}
    assert whole["On estimated date"] == 1  # same calendar day, though 6 hours late
    assert whole["1-14 days early"] == 5  # incl. half a day early: crosses midnight, -1 day


def test_payments_reviews_customers(edge):
    o = {r["order_id"]: r for r in edge.fct_orders.collect()}
    assert o["o_pay"]["payment_types"] == "boleto, voucher"
    assert o["o_pay"]["max_payment_installments"] == 3
    assert o["o_pay"]["payment_value"] == Decimal("20.00")
    assert o["o_nullpay"]["payment_types"] == ""
    assert o["o_pay"]["review_count"] == 2  # r2 twice, r3
    assert o["o_pay"]["average_review_score"] == 3.0
    assert o["o_pay"]["customer_unique_id"] == "ana"
    k = reports.kpis(edge).first()
    assert k["customers"] == 3  # ana (k1, c2), rui and u3
    # the average of per-order averages: A1 2.0, A2 4.5 and o_pay 3.0
    assert k["average_review_score"] == 3.17


def test_categories_and_geography(edge):
    cats = {r["product_id"]: r["product_category_name_english"] for r in edge.dim_products.collect()}
    assert cats["p_nocat"] == "unknown" and cats["p_untranslated"] == "unknown"
    assert cats["drill"] == "tools"
    geo = {r["geolocation_zip_code_prefix"]: r for r in edge.dim_geography.collect()}
    assert set(geo) == {"04500", "88010", "01037", None}
    assert geo["04500"]["source_observation_count"] == 2
    assert geo["04500"]["latitude"] == -12.72
    assert geo["04500"]["representative_city"] == "cabixi"


def test_malformed_values_are_null_and_counted(edge, spark):
    items = {(r["order_id"]): r for r in edge.stg_order_items.collect()}
    assert items["o_nullpay"]["item_price"] is None
    reviews = edge.stg_order_reviews.where(F.col("review_comment_title").startswith("said")).first()
    assert reviews["review_answer_timestamp"] is None
    assert reviews["review_comment_title"] == 'said "great", really'
    assert reviews["review_comment_message"] == "line one\nline two, ok"
    counts = {r["name"]: r for r in quality.coercion_checks(edge).collect()}
    assert len(counts) == 9 and {r["severity"] for r in counts.values()} == {"warning"}
    failed = {n: r["observed"] for n, r in counts.items() if not r["passed"]}
    assert failed == {"coerced_values_stg_order_items": "1", "coerced_values_stg_order_reviews": "1"}


def test_bom_header_is_clean(edge):
    assert edge.raw["orders"].columns[0] == "order_id"


def test_missing_files_are_all_listed(spark, tmp_dir):
    d = write_extracts(os.path.join(tmp_dir, "raw"), BASE, skip=("orders", "sellers"))
    with pytest.raises(MissingInputError) as err:
        load_raw(spark, d)
    assert "orders.csv" in str(err.value) and "sellers.csv" in str(err.value)


def test_empty_inputs(spark, tmp_dir):
    m = model_of(spark, tmp_dir, {})
    k = reports.kpis(m).first()
    assert k["orders"] == 0 and k["average_order_value"] is None and k["merchandise_revenue"] is None
    checks = quality.quality_checks(m)
    v = quality.verdict(checks).first()
    # no revenue to compare: the reconciliation cannot be evaluated, so it has not passed
    assert not v["passed"] and v["failed_count"] == 1
    assert [r["name"] for r in checks.where("not passed").collect()] == ["revenue_reconciliation"]
    assert quality.verdict(checks.limit(0)).first()["passed"] is False


def test_a_check_that_cannot_be_evaluated_fails(spark, tmp_dir):
    broken = [dict(r, price="n/a", freight_value="-") for r in BASE["order_items"]]
    m = model_of(spark, tmp_dir, {**BASE, "order_items": broken})
    checks = {r["name"]: r for r in quality.quality_checks(m).collect()}
    assert checks["revenue_reconciliation"]["passed"] is False and checks["revenue_reconciliation"]["observed"] is None
    assert not quality.verdict(quality.quality_checks(m)).first()["passed"]
    coerced = {r["name"]: r["observed"] for r in quality.coercion_checks(m).collect()}
    assert coerced["coerced_values_stg_order_items"] == "8"


def test_raw_scores_are_checked_before_they_are_cast(spark, tmp_dir):
    scores = ["7.5", "5.0", "3", " 4 ", "0", "NaN", "good", ""]
    reviews = [{"review_id": f"x{i}", "order_id": "A1", "review_score": s} for i, s in enumerate(scores)]
    m = model_of(spark, tmp_dir, {**BASE, "order_reviews": reviews})
    staged = {r["review_id"]: r["review_score"] for r in m.stg_order_reviews.collect()}
    assert [staged[f"x{i}"] for i in range(len(scores))] == [None, 5, 3, 4, 0, None, None, None]
    check = {r["name"]: r for r in quality.quality_checks(m).collect()}["review_score_range"]
    assert not check["passed"] and check["observed"] == "3"  # 7.5, 0 and NaN
    coerced = {r["name"]: r["observed"] for r in quality.coercion_checks(m).collect()}
    assert coerced["coerced_values_stg_order_reviews"] == "3"  # 7.5, NaN and good


def test_failing_checks(spark, tmp_dir):
    bad = extended(
        orders=[_order("o_bad", cust="c_missing", status="lost", carrier="2016-12-31 00:00:00")],
        order_items=[_item("o_bad", 1, product="p_missing", seller="s_missing", price="-1.0")],
        order_reviews=[{"review_id": "r9", "order_id": "o_bad", "review_score": "6"}],
    )
    m = model_of(spark, tmp_dir, bad)
    assert [tuple(r) for r in quality.invalid_statuses(m.fct_orders).collect()] == [("lost", 1)]
    checks = {r["name"]: r for r in quality.quality_checks(m).collect()}
    assert not checks["relationship_fct_order_items_dim_products"]["passed"]
    assert not checks["relationship_fct_order_items_dim_sellers"]["passed"]
    assert not checks["relationship_fct_orders_dim_customers"]["passed"]
    assert checks["relationship_fct_order_items_fct_orders"]["passed"]
    assert checks["accepted_order_statuses"]["observed"] == '["lost"]'
    assert not checks["non_negative_item_values"]["passed"]
    assert checks["review_score_range"]["observed"] == "1"
    ts = checks["timestamp_ordering"]
    assert not ts["passed"] and ts["severity"] == "warning"
    assert '"carrier_before_purchase":1' in ts["observed"]
    v = quality.verdict(quality.quality_checks(m)).first()
    assert not v["passed"] and v["failed_count"] == 6 and v["warning_count"] == 1


def test_duplicate_dimension_key_fails_the_join(spark, tmp_dir):
    dup = extended(products=[dict(BASE["products"][0])])
    m = model_of(spark, tmp_dir, dup)
    with pytest.raises(Exception, match="duplicate key"):
        m.fct_order_items.collect()


def test_a_repeated_order_fails_every_report(spark, tmp_dir):
    m = model_of(spark, tmp_dir, extended(orders=[dict(BASE["orders"][0])]))
    for report in (
        reports.kpis, reports.monthly_sales, reports.top_categories, reports.state_performance,
        reports.delivery_distribution, reports.monthly_orders, reports.category_matrix, reports.on_time_by_state,
        reports.review_by_status_month, reports.data_as_of, reports.seller_state_contribution,
    ):
        if report in (reports.top_categories, reports.seller_state_contribution):
            continue  # these use no column of the orders, so no order row can double an item
        with pytest.raises(Exception, match="duplicate key"):
            report(m).collect()
    assert reports.top_categories(m).first()["merchandise_revenue"] == Decimal("289.10")


def test_null_order_keys_stay(spark, tmp_dir):
    m = model_of(spark, tmp_dir, extended(orders=[_order(""), _order("")]))
    assert m.fct_orders.where("order_id is null").count() == 2
    checks = {r["name"]: r for r in quality.quality_checks(m).collect()}
    assert not checks["unique_fct_orders_order_id"]["passed"]


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_unused_joins_are_dropped(spark):
    m = from_tpch(spark, SF)
    plan = reports.delivery_distribution(m)._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" not in plan and "NestedLoop" not in plan
    assert _scans(reports.delivery_distribution(m)) <= 2  # orders, and their keys
    assert _scans(reports.seller_state_contribution(m)) <= 4  # items, sellers and where they are
    assert "BroadcastNestedLoop" not in reports.category_matrix(m)._jdf.queryExecution().executedPlan().toString()


def test_each_check_group_reads_a_fact_once(spark):
    m = from_tpch(spark, SF)
    stored = Model(m.raw)
    for name in ("fct_orders", "fct_order_items", "dim_customers", "dim_products", "dim_sellers"):
        stored.__dict__[name] = spark.createDataFrame(getattr(m, name).limit(5).collect(), getattr(m, name).schema)
    plan = quality.quality_checks(stored)._jdf.queryExecution().optimizedPlan().toString()
    # the item fact: one pass for the checks, one for each of three references; the order fact: one
    # pass, one for its reference, one for the statuses (counted and listed) and one as a parent
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 16


def test_malformed_rows_are_counted(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sellers.csv")
    with open(path, "w") as fh:
        fh.write("seller_city,seller_id,seller_zip_code_prefix,seller_state\nlages,v1,88010,SC\n")
        fh.write("lages,v2,88010,SC,surplus\nlages,v3\n\"a, b\",v4,88010,SC\n")
    r = malformed_rows(spark, path, RAW_TABLES["sellers"]).first()
    assert (r["table"], r["rows"], r["malformed_rows"]) == ("sellers", 4, 2)
    rows = {r["seller_id"]: r for r in read_extract(spark, path, RAW_TABLES["sellers"]).collect()}
    assert set(rows) == {"v1", "v2", "v3", "v4"} and rows["v4"]["seller_city"] == "a, b"
    assert rows["v3"]["seller_state"] is None


def test_files_are_found_by_their_names(spark, tmp_dir):
    d = os.path.join(tmp_dir, "named")
    write_extracts(d, BASE)
    for name in RAW_TABLES:
        target = "product_category_name_translation.csv" if name == "category_translation" else f"shop_{name}_dataset.csv"
        os.rename(os.path.join(d, f"{name}.csv"), os.path.join(d, target))
    assert resolve_files(spark, d)["order_items"] == "shop_order_items_dataset.csv"
    assert Model(load_raw(spark, d)).fct_orders.count() == 2
    with open(os.path.join(d, "orders.csv"), "w") as fh:
        fh.write("order_id\n")
    with pytest.raises(ValueError, match="more than one file"):
        load_raw(spark, d)
