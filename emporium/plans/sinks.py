"""Sinks: layer namespaces, table writes with descriptions, views, documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_layers(spark: SparkSession, databases: Sequence[str]) -> None:
    for db in databases:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def describe(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions as field metadata (stored as column comments)."""
    for name, text in columns.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": text})
    return df


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    bucket_by: str | None = None,
    buckets: int | None = None,
    description: str | None = None,
    column_descriptions: Mapping[str, str] | None = None,
    file_format: str = "parquet",
) -> str:
    """Write (replace by default) table ``name``.

    With ``bucket_by``, rows are hash-partitioned into ``buckets`` files on
    that column first, so later joins and aggregations on it between tables
    bucketed the same way read co-located data without a shuffle.
    """
    spark = df.sparkSession
    if column_descriptions:
        df = describe(df, column_descriptions)
    writer = df
    if bucket_by:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = df.repartition(n, bucket_by)
        w = writer.write.format(file_format).mode(mode).bucketBy(n, bucket_by).sortBy(bucket_by)
    else:
        w = writer.write.format(file_format).mode(mode)
    w.saveAsTable(name)
    if description:
        text = description.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('comment' = '{text}')")
    return name


def create_view(spark: SparkSession, name: str, source: str, columns: Sequence[str], description: str = "") -> str:
    """Persistent view ``name`` projecting ``columns`` (SQL expressions) of table ``source``."""
    text = description.replace("\\", "\\\\").replace("'", "\\'")
    comment = f" COMMENT '{text}'" if description else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{comment} AS SELECT {', '.join(columns)} FROM {source}")
    return name


def row_counts(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """One row per table: ``table, rows`` (counts read from the written tables)."""
    parts = [spark.table(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows")
             for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_document(doc: DataFrame, path: str) -> str:
    """Write a one-row, one-string-column DataFrame as a single text file."""
    if len(doc.columns) != 1:
        raise ValueError("a document is one string column")
    doc.coalesce(1).write.mode("overwrite").text(path)
    return path
