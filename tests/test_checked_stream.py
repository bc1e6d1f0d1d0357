"""Typed, checked landing: rows that break a constraint are quarantined, a replayed batch lands once."""

from __future__ import annotations

import os

import pytest

from emporium.operators.quality import row_constraints
from emporium.sources.catalog import RAW_TABLES
from emporium.streaming import ingest
from emporium.streaming.ingest import land_checked_stream, land_files

COLUMNS = RAW_TABLES["order_items"].columns
GOOD = {"order_id": "o1", "order_item_id": "1", "product_id": "p", "seller_id": "s", "shipping_limit_date": "2018-01-01 00:00:00", "price": "5.00", "freight_value": "1.00"}


def _drop(folder, name, rows, columns=COLUMNS, extra=""):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(",".join(columns) + "\n" + "".join(",".join({**GOOD, **r}[c] for c in columns) + "\n" for r in rows) + extra)


def _tables(spark, name):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return f"{name}.items", f"{name}.refused"


def _start(spark, src, tables, tmp_dir, **kw):
    return land_checked_stream(spark, src, "stg_order_items", *tables, row_constraints(), checkpoint=os.path.join(tmp_dir, "c"), **kw)


def _seen(spark, tables):
    for t in tables:  # this session may have listed a partition that the stream's session has replaced since
        spark.catalog.refreshTable(t)
    accepted = sorted((r["order_id"], float(r["item_price"])) for r in spark.table(tables[0]).collect())
    refused = sorted((r["order_id"] or "", tuple(r["violations"])) for r in spark.table(tables[1]).collect())
    return accepted, refused


def test_rows_are_typed_and_quarantined(spark, tmp_dir):
    src, tables = os.path.join(tmp_dir, "drops"), _tables(spark, "cs1")
    _drop(src, "a.csv", [{}, {"order_id": "o2", "price": "-1"}, {"order_id": "", "price": "x"}])
    _drop(src, "b.csv", [{"order_id": "o3", "price": "7"}], tuple(reversed(COLUMNS)), extra="too,few\n")
    _start(spark, src, tables, tmp_dir).awaitTermination()
    accepted, refused = _seen(spark, tables)
    assert accepted == [("o1", 5.0), ("o3", 7.0)]
    assert sorted(len(v) for _, v in refused) == [1, 2, 3]  # the short row breaks all three
    assert ("o2", ("non_negative_price",)) in refused
    assert dict(spark.table(tables[0]).dtypes)["item_price"] == "decimal(18,2)"
    assert {r["_source_file"] for r in spark.table(tables[0]).collect()} == {"a.csv", "b.csv"}
    # new files only, in a new batch
    _drop(src, "c.csv", [{"order_id": "o4"}])
    _start(spark, src, tables, tmp_dir).awaitTermination()
    assert [k for k, _ in _seen(spark, tables)[0]] == ["o1", "o3", "o4"]
    assert {r["_batch_id"] for r in spark.table(tables[0]).collect()} == {0, 1}


def test_a_replayed_batch_lands_once(spark, tmp_dir):
    src, tables = os.path.join(tmp_dir, "drops"), _tables(spark, "cs2")
    _drop(src, "a.csv", [{}, {"order_id": "o2", "price": "-1"}])
    files = [os.path.join(src, "a.csv")]
    for batch_id in (0, 0, 1, 0):
        land_files(spark, files, "stg_order_items", *tables, row_constraints(), batch_id)
    assert spark.table(tables[0]).where("_batch_id = 0").count() == 1 and spark.table(tables[1]).where("_batch_id = 0").count() == 1
    assert spark.table(tables[0]).count() == 2


def test_a_batch_that_fails_between_the_tables_lands_once(spark, tmp_dir, monkeypatch):
    src, tables = os.path.join(tmp_dir, "drops"), _tables(spark, "cs3")
    _drop(src, "a.csv", [{}, {"order_id": "o2", "price": "-1"}])
    write = ingest.write_batch

    def fails_second(df, name, batch_id):
        if name == tables[1]:
            raise RuntimeError("lost")
        write(df, name, batch_id)

    monkeypatch.setattr(ingest, "write_batch", fails_second)
    with pytest.raises(Exception):
        _start(spark, src, tables, tmp_dir).awaitTermination()
    assert spark.table(tables[0]).count() == 1
    monkeypatch.undo()
    _start(spark, src, tables, tmp_dir).awaitTermination()
    assert _seen(spark, tables) == ([("o1", 5.0)], [("o2", ("non_negative_price",))])


def test_a_file_without_a_needed_column_stops_its_batch_only(spark, tmp_dir):
    src, tables = os.path.join(tmp_dir, "drops"), _tables(spark, "cs4")
    _drop(src, "a.csv", [{}])
    _start(spark, src, tables, tmp_dir, max_files_per_trigger=1).awaitTermination()
    _drop(src, "late.csv", [{}], COLUMNS[:-1])
    with pytest.raises(Exception, match="late.csv: missing columns"):
        _start(spark, src, tables, tmp_dir, max_files_per_trigger=1).awaitTermination()
    assert _seen(spark, tables) == ([("o1", 5.0)], [])

