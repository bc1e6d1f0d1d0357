import duckdb
import pytest

from emporium.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    found = con.sql(oracle_sql()[name])
    df = queries()[name](spark, SF)
    assert set(df.columns) == set(found.columns)
    columns = sorted(df.columns)
    expected = sorted(map(repr, con.sql(f"select {', '.join(columns)} from ({oracle_sql()[name]})").fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == expected


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs_on_the_given_tables(spark, name):
    df = queries()[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_contract_columns(spark):
    first = {
        "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op2_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
        "op10_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    }
    for name, types in first.items():
        assert dict(queries()[name](spark, SF).dtypes) == types
