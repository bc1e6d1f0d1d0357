"""Freshness and volume rows against hand-worked and brute-force days."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from emporium.operators.monitoring import Monitored, daily_volume, freshness, monitoring_checks, volume_anomalies


class Tables:
    """A model of a few given tables."""

    def __init__(self, spark, **tables):
        self.spark, self._tables = spark, tables

    def table(self, name):
        return self._tables[name]


WATCHED = (Monitored("a", "at", 1), Monitored("b", "at", 10))
START = dt.date(2020, 2, 20)


def _table(spark, days):
    """``days``: day offset -> rows on that day; None -> rows without a time."""
    rows = [(None if d is None else f"{START + dt.timedelta(days=d)} {i % 24:02d}:00:00",) for d, n in days.items() for i in range(n)]
    return spark.createDataFrame(rows, "t string").select(F.to_timestamp("t").alias("at"))


@pytest.fixture()
def model(spark):
    rnd = random.Random(4)
    days = {d: rnd.choice([0, 3, 10, 11, 12, 40]) for d in range(60)}
    days[0], days[59] = 5, 2
    return Tables(spark, a=_table(spark, {**days, None: 3}), b=_table(spark, {0: 1, 50: 8})), days


def test_days_without_rows_are_days(model):
    tables, days = model
    got = {(r["table"], r["day"]): r["rows"] for r in daily_volume(tables, WATCHED).collect()}
    want = {("a", START + dt.timedelta(days=d)): n for d, n in days.items()}
    want |= {("b", START + dt.timedelta(days=d)): {0: 1, 50: 8}.get(d, 0) for d in range(51)}
    assert got == want  # over the 29th of February


def test_anomalies_are_brute_force(model):
    tables, days = model
    got = {r["day"]: r for r in volume_anomalies(tables, WATCHED, trailing_days=14, min_history=5).where("table = 'a'").collect()}
    assert {r["anomaly"] for r in got.values()} == {None, "low", "high"}
    for d, n in days.items():
        before = [days[x] for x in range(max(0, d - 14), d)]
        r = got[START + dt.timedelta(days=d)]
        assert r["history_days"] == len(before)
        if not before or not sum(before):
            assert r["ratio"] is None and r["anomaly"] is None
            continue
        mean = sum(before) / len(before)
        assert r["trailing_mean"] == pytest.approx(mean, abs=1e-4) and r["ratio"] == pytest.approx(n / mean, abs=1e-4)
        want = None if len(before) < 5 else "low" if n < 0.5 * mean else "high" if n > 2 * mean else None
        assert r["anomaly"] == want


def test_freshness(spark, model):
    tables, _ = model
    tables._tables["c"] = _table(spark, {None: 2})
    watched = (*WATCHED, Monitored("c", "at"))
    got = {r["table"]: r for r in freshness(tables, watched).collect()}
    assert {t: (r["rows"], r["age_days"], r["fresh"]) for t, r in got.items()} == {
        "a": (tables.table("a").count(), 0, True), "b": (9, 9, True), "c": (2, None, False)
    }
    later = freshness(tables, watched, as_of=F.lit(START + dt.timedelta(days=61))).collect()
    assert {r["table"]: r["fresh"] for r in later} == {"a": False, "b": False, "c": False}


def test_checks_have_the_shape_of_the_quality_checks(spark, model):
    tables, days = model
    tables._tables["c"] = _table(spark, {})
    rows = monitoring_checks(tables, (*WATCHED, Monitored("c", "at")), trailing_days=14, min_history=5).orderBy("check_order").collect()
    assert [r["name"] for r in rows] == ["freshness_a", "volume_a", "freshness_b", "volume_b", "freshness_c", "volume_c"]
    assert {r["severity"] for r in rows} == {"warning"}
    by = {r["name"]: r for r in rows}
    assert not by["volume_a"]["passed"] and json.loads(by["volume_a"]["observed"])["anomaly"] == "low"  # 2 rows on the last day
    assert by["freshness_a"]["passed"] and by["freshness_b"]["passed"] and by["volume_b"]["passed"]  # b has no rows to compare with
    assert not by["freshness_c"]["passed"] and not by["volume_c"]["passed"]


def test_the_window_is_over_days_not_rows(spark, model):
    plan = volume_anomalies(model[0], WATCHED)._jdf.queryExecution().optimizedPlan().toString()
    window, below = plan.split("Window [", 1)[1], plan.split("Window [", 1)[1]
    assert "Aggregate" in below and "RangeFrame" in window
