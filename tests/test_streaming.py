"""Incremental bronze landing: each file is landed once across runs."""

from __future__ import annotations

import csv
import os

import pytest

from emporium.sources.catalog import RAW_TABLES
from emporium.streaming.ingest import land_stream


def _drop(directory, name, rows):
    cols = RAW_TABLES["order_payments"].columns
    with open(os.path.join(directory, name), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(cols)
        w.writerows(rows)


def test_new_files_are_landed_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "drops")
    os.makedirs(src)
    _drop(src, "a.csv", [["o1", "1", "voucher", "1", "5.0"], ["o1", "2", "boleto", "1", "5.0"]])
    spark.sql("CREATE DATABASE IF NOT EXISTS s_bronze")
    ckpt = os.path.join(tmp_dir, "ckpt")
    land_stream(spark, src, "order_payments", "s_bronze.raw_order_payments", checkpoint=ckpt).awaitTermination()
    assert spark.table("s_bronze.raw_order_payments").count() == 2
    _drop(src, "b.csv", [["o2", "1", "credit_card", "3", "7.5"]])
    land_stream(spark, src, "order_payments", "s_bronze.raw_order_payments", checkpoint=ckpt).awaitTermination()
    landed = spark.table("s_bronze.raw_order_payments")
    assert landed.count() == 3
    assert {r["_source_file"] for r in landed.collect()} == {"a.csv", "b.csv"}
    assert landed.where("_ingested_at IS NULL").count() == 0


def test_a_file_with_other_columns_is_refused(spark, tmp_dir):
    src = os.path.join(tmp_dir, "drops")
    os.makedirs(src)
    cols = RAW_TABLES["order_payments"].columns
    with open(os.path.join(src, "reversed.csv"), "w") as fh:
        fh.write(",".join(reversed(cols)) + "\n5.0,1,voucher,1,o1\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS s2_bronze")
    query = land_stream(spark, src, "order_payments", "s2_bronze.raw_order_payments", checkpoint=os.path.join(tmp_dir, "c"))
    with pytest.raises(Exception):
        query.awaitTermination()
    assert spark.table("s2_bronze.raw_order_payments").count() == 0
