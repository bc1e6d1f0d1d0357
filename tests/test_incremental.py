"""Incremental load: the latest row of each key, only touched partitions replaced, reruns change nothing."""

from __future__ import annotations

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from emporium.plans import incremental
from emporium.plans.incremental import MovedKeyError, changed_since, latest, merge_latest, read_table

SCHEMA = "order_id string, month string, status string, updated_at timestamp"


def _rows(spark, rows):
    return spark.createDataFrame(rows, "order_id string, month string, status string, at string").select(
        "order_id", "month", "status", F.to_timestamp("at").alias("updated_at")
    )


def _load(rows, path, load_id, **kw):
    return merge_latest(rows, path, ["order_id"], "updated_at", ["month"], load_id, **kw)


def _files(path):
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=*/*.parquet")}


def _found(spark, path, like):
    return {tuple(r) for r in read_table(spark, path, like).select("order_id", "month", "status").collect()}


@pytest.fixture()
def base(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    first = _rows(spark, [("a", "2018-01", "new", "2018-01-01"), ("b", "2018-01", "new", "2018-01-02"), ("c", "2018-02", "new", "2018-02-01"), ("d", "2018-03", "new", "2018-03-01")])
    load = _load(first, path, "1")
    assert load.partitions == [("2018-01",), ("2018-02",), ("2018-03",)] and load.rows == 4
    return path, first


def test_a_second_load_touches_changed_partitions_only(spark, base):
    path, first = base
    before = _files(path)
    load = _load(_rows(spark, [("a", "2018-01", "paid", "2018-01-05"), ("e", "2018-04", "new", "2018-04-01")]), path, "2")
    assert load.partitions == [("2018-01",), ("2018-04",)] and load.rows == 3
    after = _files(path)
    kept = {f for f in before if "month=2018-01" not in f}
    assert {f: after.get(f) for f in kept} == {f: before[f] for f in kept}
    assert not {f for f in before if "month=2018-01" in f} & set(after)
    assert _found(spark, path, first) == {("a", "2018-01", "paid"), ("b", "2018-01", "new"), ("c", "2018-02", "new"), ("d", "2018-03", "new"), ("e", "2018-04", "new")}


def test_reruns_and_late_updates_change_nothing(spark, base):
    path, first = base
    update = _rows(spark, [("a", "2018-01", "paid", "2018-01-05")])
    _load(update, path, "2")
    want = _found(spark, path, first)
    _load(update, path, "2")  # the same load again
    _load(update, path, "3")  # the same rows again
    _load(_rows(spark, [("a", "2018-01", "older", "2017-12-31")]), path, "4")
    assert _found(spark, path, first) == want
    assert _load(update.limit(0), path, "5").partitions == [] and _found(spark, path, first) == want


def test_a_load_that_stops_while_replacing_goes_on(spark, base, monkeypatch):
    path, first = base
    update = _rows(spark, [("a", "2018-01", "paid", "2018-01-05")])
    monkeypatch.setattr(incremental, "_spread", lambda *a: 1 / 0)  # after the merge, before the replacement
    with pytest.raises(ZeroDivisionError):
        _load(update, path, "2")
    monkeypatch.undo()
    for f in glob.glob(f"{path}/month=2018-01/*"):  # as if the partition had been cleared already
        os.remove(f)
    _load(update, path, "2")
    assert _found(spark, path, first) == {("a", "2018-01", "paid"), ("b", "2018-01", "new"), ("c", "2018-02", "new"), ("d", "2018-03", "new")}


def test_only_touched_partitions_are_read(spark, base):
    path, first = base
    rows = read_table(spark, path, first).where(incremental._in_partitions(["month"], [("2018-01",)]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2018-01" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0].split("/")[-2] for r in rows.select(F.input_file_name()).collect()} == {"month=2018-01"}


def test_a_key_may_not_move(spark, base):
    path, first = base
    before = _files(path)
    with pytest.raises(MovedKeyError):
        _load(_rows(spark, [("a", "2018-02", "paid", "2018-01-05")]), path, "2")
    with pytest.raises(MovedKeyError):
        _load(_rows(spark, [("z", "2018-02", "x", "2018-01-05"), ("z", "2018-03", "x", "2018-01-05")]), path, "3")
    assert _files(path) == before


def test_changed_since_takes_the_bound_in(spark, base):
    path, first = base
    source = first.unionByName(_rows(spark, [("f", "2018-03", "new", "2018-03-01"), ("g", "2018-03", "new", None), ("h", "2018-02", "old", "2018-02-28")]))
    assert {r[0] for r in changed_since(source, read_table(spark, path, first), "updated_at").collect()} == {"d", "f", "g"}
    assert changed_since(source, None, "updated_at").count() == source.count()


def test_latest_is_brute_force(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["hot"] * 5 + [f"k{i}" for i in range(30)] + [None]), "m", rnd.choice(["x", "y", None]), rnd.choice([f"2018-01-0{d}" for d in range(1, 6)] + [None])) for _ in range(500)]
    got = {r["order_id"]: (r["status"], r["updated_at"] and str(r["updated_at"])[:10]) for r in latest(_rows(spark, rows), ["order_id"], "updated_at").collect()}
    low = lambda v: (v is not None, v or "")
    want = {}
    for k, _, status, at in rows:
        best = want.get(k)
        if best is None or (low(at), low(status)) > (low(best[1]), low(best[0])):
            want[k] = (status, at)
    assert got == want


def test_several_partition_columns_and_nulls(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    def rows(data):
        return spark.createDataFrame(data, "k int, year int, region string, v int, at long")
    def load(data, i):
        return merge_latest(rows(data), path, ["k"], "at", ["year", "region"], str(i))
    load([(1, 2018, None, 1, 1), (2, 2018, "01", 1, 1), (3, 2019, "x", 1, 1)], 1)
    assert load([(1, 2018, None, 2, 2), (2, 2018, "01", 2, 2)], 2).partitions == [(2018, "01"), (2018, None)]
    found = read_table(spark, path, rows([]))
    assert {tuple(r) for r in found.collect()} == {(1, 2018, None, 2, 2), (2, 2018, "01", 2, 2), (3, 2019, "x", 1, 1)}
