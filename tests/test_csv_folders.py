"""An extract of several files: each is read by its own header."""

from __future__ import annotations

import os

import pytest

from emporium.operators.staging import stage
from emporium.sources.bronze import land
from emporium.sources.catalog import RAW_TABLES
from emporium.sources.csv import MissingInputError, first_lines, files_of, headers_of, load_raw, malformed_rows, read_extract

SELLERS = RAW_TABLES["sellers"]


def _write(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding=encoding) as fh:
        fh.write(text)
    return path


def _two_orders(folder):
    _write(folder, "a.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\nv1,01000,sao paulo,SP\n")
    _write(folder, "b.csv", 'seller_state,seller_city,"seller_zip_code_prefix",seller_id\r\nRJ,"rio, novo",02000,v2\r\n')
    _write(folder, "c.csv", "note,seller_state,seller_id,seller_city,seller_zip_code_prefix\nx,BA,v3,ilheus,03000\n", "utf-8-sig")
    _write(folder, "d.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\nv4,04000,santos,SP\n")


EXPECTED = [("v1", "01000", "sao paulo", "SP"), ("v2", "02000", "rio, novo", "RJ"), ("v3", "03000", "ilheus", "BA"), ("v4", "04000", "santos", "SP")]


def test_files_with_other_column_orders_land_right(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "sellers")
    _two_orders(folder)
    rows = read_extract(spark, folder, SELLERS)
    assert rows.columns == list(SELLERS.columns)
    assert sorted(map(tuple, rows.collect())) == EXPECTED
    # three headers are three scans, not one for each file
    assert len(headers_of(spark, files_of(spark, folder), SELLERS)) == 3
    assert sorted(map(tuple, read_extract(spark, folder + "/[ab].csv", SELLERS).collect())) == EXPECTED[:2]


def test_a_folder_lands_in_bronze(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "sellers")
    _two_orders(folder)
    raw = load_raw(spark, tmp_dir, {"sellers": "sellers"})
    spark.sql("CREATE DATABASE IF NOT EXISTS folder_bronze")
    land(raw, "folder_bronze")
    landed = spark.table("folder_bronze.raw_sellers")
    assert sorted(map(tuple, landed.drop("_ingested_at").collect())) == EXPECTED
    assert stage("stg_sellers", landed).count() == 4


def test_a_file_without_a_needed_column_fails_by_name(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "sellers")
    _two_orders(folder)
    _write(folder, "late.csv", "seller_id,seller_city,seller_state\nv5,natal,RN\n")
    with pytest.raises(ValueError, match=r"late\.csv: missing columns \['seller_zip_code_prefix'\]"):
        read_extract(spark, folder, SELLERS)


def test_files_without_a_header_and_double_columns_fail_by_name(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "sellers")
    _two_orders(folder)
    _write(folder, "nothing.csv", "")  # a file of no bytes is passed over
    assert read_extract(spark, folder, SELLERS).count() == 4
    _write(folder, "blank.csv", "\n")
    with pytest.raises(ValueError, match=r"blank\.csv: missing columns"):
        read_extract(spark, folder, SELLERS)
    other = os.path.join(tmp_dir, "double")
    _two_orders(other)
    _write(other, "twice.csv", "seller_id,seller_id,seller_zip_code_prefix,seller_city,seller_state\nv5,v6,1,natal,RN\n")
    with pytest.raises(ValueError, match=r"twice\.csv: columns named twice \['seller_id'\]"):
        read_extract(spark, other, SELLERS)
    with pytest.raises(MissingInputError):
        os.makedirs(os.path.join(tmp_dir, "none"))
        read_extract(spark, os.path.join(tmp_dir, "none"), SELLERS)


def test_malformed_rows_are_counted_in_every_file(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "sellers")
    _two_orders(folder)
    _write(folder, "e.csv", "seller_state,seller_city,seller_zip_code_prefix,seller_id\nRN,natal\nRN,natal,05000,v6,more\nRN,natal,06000,v7\n")
    r = malformed_rows(spark, folder, SELLERS).first()
    assert (r["rows"], r["malformed_rows"]) == (7, 2)


def test_only_the_first_lines_are_read(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "long")
    names = ["a.csv", "b.csv", "c.csv"]
    for k, name in enumerate(names):
        _write(folder, name, f"header {k}\n" + "row\n" * 20_000)
    files = files_of(spark, folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert [first_lines(spark, files)[f] for f in files] == ["header 0", "header 1", "header 2"]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
