"""Bronze landing: raw tables kept in source shape plus ingestion metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import RAW_TABLES

INGESTED_AT = "_ingested_at"


def with_ingestion_time(df: DataFrame) -> DataFrame:
    """All source columns unchanged, plus the ingestion timestamp."""
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def land(
    raw: Mapping[str, DataFrame],
    database: str,
    prefix: str = "raw_",
    if_absent: bool = False,
    file_format: str = "parquet",
) -> list[str]:
    """Write every raw table as ``{database}.{prefix}{name}``.

    ``if_absent`` keeps an existing table untouched (create-if-not-exists);
    otherwise the table is replaced. Returns the table names written.
    """
    written = []
    for name in raw:
        if name not in RAW_TABLES:
            continue  # derived helpers of a source adapter are not extracts
        df = raw[name]
        table = f"{database}.{prefix}{name}"
        (
            with_ingestion_time(df)
            .write.format(file_format)
            .mode("ignore" if if_absent else "overwrite")
            .saveAsTable(table)
        )
        written.append(table)
    return written
