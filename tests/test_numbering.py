"""Row numbering within a key over range partitions equals the plain window."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from emporium.operators.numbering import number_within


def _data(spark):
    # key 0 holds most rows, NULL many; keys 1..49 are small groups
    rows = [(0 if i % 10 < 6 else None if i % 10 < 8 else i % 50, i % 7, (i * 37) % 101, float(i)) for i in range(3000)]
    return spark.createDataFrame(rows, "k long, a int, b long, c double")


def _expected(df):
    w = Window.partitionBy("k").orderBy("a", "b", "c")
    return {tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).collect()}


@pytest.mark.parametrize("partitions", [1, 6, 40])
def test_numbers_are_those_of_the_window(spark, partitions):
    df = _data(spark)
    out = number_within(df, "k", ["a", "b", "c"], "rn", partitions)
    assert {tuple(r) for r in out.collect()} == _expected(df)
    assert {tuple(r) for r in out.collect()} == _expected(df)  # and again


def test_a_hot_key_spans_partitions(spark):
    out = number_within(_data(spark), "k", ["a", "b", "c"], "rn", 6)
    assert "Window [row_number" not in out._jdf.queryExecution().optimizedPlan().toString()
    hot = sorted(r["rn"] for r in out.where("k = 0").collect())
    assert hot == list(range(1, len(hot) + 1))


def test_empty_table(spark):
    assert number_within(_data(spark).limit(0), "k", ["a"], "rn").count() == 0


@pytest.mark.parametrize("setting", ["spark.sql.exchange.reuse", "spark.sql.adaptive.enabled"])
def test_numbers_do_not_depend_on_the_optimizer(spark, setting):
    # many more rows than the range sampler looks at, so its bounds are estimates
    df = spark.range(400_000).selectExpr("hash(id) % 5 AS k", "xxhash64(id) AS a")
    numbered = number_within(df, "k", ["a"], "rn", 7)
    counts = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    before = spark.conf.get(setting)
    try:
        for value in ("true", "false"):
            spark.conf.set(setting, value)
            found = numbered.groupBy("k").agg(F.min("rn").alias("lo"), F.max("rn").alias("hi"), F.count_distinct("rn").alias("n"))
            assert {r["k"]: (r["lo"], r["hi"], r["n"]) for r in found.collect()} == {k: (1, n, n) for k, n in counts.items()}
    finally:
        spark.conf.set(setting, before)


def test_item_numbers_without_exchange_reuse(spark):
    from emporium.plans.model import from_tpch

    try:
        spark.conf.set("spark.sql.exchange.reuse", "false")
        items = from_tpch(spark, "/root/testdata/sf0.01").stg_order_items
        found = items.groupBy("order_id").agg(F.min("order_item_id").alias("lo"), F.max("order_item_id").alias("hi"), F.count("*").alias("n"))
        assert found.where("lo <> 1 OR hi <> n").count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_every_row_keeps_its_number_in_a_self_join(spark):
    numbered = number_within(_data(spark), "k", ["a", "b", "c"], "rn", 6)
    a, b = numbered.alias("a"), numbered.where("k = 0").alias("b")
    joined = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.rn") == F.col("b.rn")))
    assert joined.where("a.c <> b.c").count() == 0 and joined.count() == numbered.where("k = 0").count()


def test_the_shared_folder_is_not_invented_on_a_cluster():
    from types import SimpleNamespace

    from emporium.session import shared_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context))
