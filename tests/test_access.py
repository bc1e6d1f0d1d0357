"""Row-level restriction and masking."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from emporium.operators import access
from emporium.operators.access import POLICY_SCHEMA, PolicyError, allowed_values, masked, publish_restricted_views, restricted, visible_by_role
from emporium.plans import warehouse
from emporium.sources.csv import load_raw
from extracts import BASE, write_extracts

POLICY = [("north", "RO"), ("north", "RO"), ("north", "AM"), ("all", "RO"), ("all", "SC"), ("none", None), (None, "SC"), ("o'south", "SC")]


def _policy(spark):
    return spark.createDataFrame(POLICY, POLICY_SCHEMA)


def _fact(spark):
    return spark.createDataFrame([(1, "ana", "RO"), (2, "rui", "SC"), (3, "ana", None), (4, None, "AM")], "order_id int, customer_unique_id string, customer_state string")


def test_a_role_sees_its_rows(spark):
    seen = {role: {r["order_id"] for r in restricted(_fact(spark), _policy(spark), role, "customer_state").collect()} for role in ("north", "all", "none", "other", "o'south")}
    assert seen == {"north": {1, 4}, "all": {1, 2}, "none": set(), "other": set(), "o'south": {2}}
    joined = restricted(_fact(spark), _policy(spark), "all", "customer_state", most=1)
    assert {r["order_id"] for r in joined.collect()} == {1, 2}
    assert allowed_values(_policy(spark), "all", 1) is None and allowed_values(_policy(spark), "north") == ["AM", "RO"]


def test_roles_side_by_side_see_no_row_twice(spark):
    rows = sorted((r["role"], r["order_id"]) for r in visible_by_role(_fact(spark), _policy(spark), "customer_state").collect())
    assert rows == [("all", 1), ("all", 2), ("north", 1), ("north", 4), ("o'south", 2)]


def test_masks_are_salted_hashes(spark):
    got = _fact(spark).select("customer_unique_id", masked("customer_unique_id", "pepper").alias("m"), masked("customer_unique_id", "other").alias("o")).collect()
    for r in got:
        want = r[0] and hashlib.sha256(f"6:pepper{r[0]}".encode()).hexdigest()
        assert r["m"] == want and (r["m"] is None or r["m"] != r["o"])
    # a salt and an identity do not run together
    df = spark.createDataFrame([("bc", "c")], "x string, y string")
    assert df.select(masked("x", "a") == masked("y", "ab")).first()[0] is False


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    raw = load_raw(spark, write_extracts(os.path.join(tmp_path_factory.mktemp("raw")), BASE))
    layers = warehouse.Layers("ac_bronze", "ac_silver", "ac_gold", "ac_semantic")
    warehouse.build(spark, raw, layers)
    spark.createDataFrame([("pepper",)], "salt string").write.mode("overwrite").saveAsTable("ac_gold.salt")
    return "ac_gold.fct_orders"


def test_views_of_the_semantic_layer(spark, gold):
    names = publish_restricted_views(spark, _policy(spark), gold, "ac_gold.salt", "ac_semantic")
    assert names["north"] == "ac_semantic.semantic_order_metrics_north"
    north = spark.table(names["north"])
    assert north.columns == spark.table("ac_semantic.semantic_order_metrics").columns
    rows = north.collect()
    assert [(r["order_id"], r["customer_unique_id"]) for r in rows] == [("A1", hashlib.sha256(b"6:pepperana").hexdigest())]
    assert spark.table(names["all"]).count() == 2 and spark.table(names["none"]).count() == 0
    assert spark.table(names["o'south"]).first()["order_id"] == "A2"
    text = spark.sql(f"SHOW CREATE TABLE {names['north']}").first()[0]
    assert "pepper" not in text
    # a role that has left the policy sees nothing any more; the plain view is not touched
    publish_restricted_views(spark, _policy(spark).where("role = 'all'"), gold, "ac_gold.salt", "ac_semantic")
    assert spark.table(names["north"]).count() == 0 and spark.table(names["all"]).count() == 2
    assert spark.table("ac_semantic.semantic_order_metrics").count() == 2


def test_the_filter_reaches_the_scan(spark, gold):
    names = publish_restricted_views(spark, _policy(spark), gold, "ac_gold.salt", "ac_semantic")
    for df in (spark.table(names["north"]), restricted(spark.table(gold), _policy(spark), "north", "customer_state")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed = plan.split("PushedFilters: [")[1].split("]")[0] if "PushedFilters: [" in plan else plan
        assert "In(customer_state, [AM,RO" in plan or "customer_state" in pushed
        assert "In(customer_state" in plan
    narrow = spark.table(names["north"]).select("order_id")._jdf.queryExecution().executedPlan().toString()
    assert "customer_unique_id" not in narrow.split("ReadSchema")[1]  # what is not shown is not read


def test_policies_that_cannot_be_applied(spark, gold):
    with pytest.raises(PolicyError, match="share a view name"):
        two = spark.createDataFrame([("a b", "RO"), ("A-b", "SC")], POLICY_SCHEMA)
        publish_restricted_views(spark, two, gold, "ac_gold.salt", "ac_semantic")
    with pytest.raises(PolicyError, match="no letters"):
        publish_restricted_views(spark, spark.createDataFrame([("--", "RO")], POLICY_SCHEMA), gold, "ac_gold.salt", "ac_semantic")
    spark.createDataFrame([("",)], "salt string").write.mode("overwrite").saveAsTable("ac_gold.no_salt")
    with pytest.raises(PolicyError, match="salt"):
        publish_restricted_views(spark, _policy(spark), gold, "ac_gold.no_salt", "ac_semantic")
    assert access.masked_columns(_fact(spark), F.lit("x"))[1] is not None
