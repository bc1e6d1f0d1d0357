"""Incremental bronze landing of extract files with Structured Streaming.

The batch landing (:mod:`emporium.sources.bronze`) rewrites a bronze table
from the full extract. When extracts arrive as new files in a folder, the
same landing can run incrementally: a file stream picks up only files it has
not seen (tracked in the checkpoint), appends them with the ingestion time
and the source file name, and stops when the backlog is drained
(``availableNow``). Rerunning after a failure resumes from the checkpoint, so
each file is landed exactly once.

The checkpoint lives under ``spark.checkpoint.dir`` (a shared folder on a
cluster) unless a location is given.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import violations
from ..operators.staging import STAGING, staging_sql
from ..session import checkpoint_dir, stored
from ..sources.bronze import INGESTED_AT
from ..sources.catalog import RAW_TABLES
from ..sources.csv import MALFORMED, read_with_malformed

SOURCE_FILE = "_source_file"


def land_stream(
    spark: SparkSession,
    source_dir: str,
    table: str,
    target: str,
    checkpoint: str | None = None,
    file_glob: str = "*.csv",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start landing new ``file_glob`` files of ``source_dir`` into table ``target``.

    ``table`` names the raw extract, whose columns are read as text. Every
    file's header must name them in catalogue order; the query fails on a file
    whose columns are in another order, rather than landing them under wrong
    names. Returns the running query; call ``awaitTermination()`` to wait for
    the backlog to drain.
    """
    spec = RAW_TABLES[table]
    location = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/bronze_{target.replace('.', '_')}"
    reader = (
        spark.readStream.schema(spec.schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", spec.free_text)
        .option("escape", '"')
        .option("pathGlobFilter", file_glob)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source_dir).select(
        "*",
        F.current_timestamp().alias(INGESTED_AT),
        F.col("_metadata.file_name").alias(SOURCE_FILE),
    )
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .outputMode("append")
        .toTable(target)
    )


BATCH_ID = "_batch_id"

_FILES = "path string, modificationTime timestamp, length long, content binary"


def _batch_table(df: DataFrame, name: str) -> None:
    """Create ``name`` with the columns of ``df``, partitioned by the batch that brought a row, if it is not there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {BATCH_ID} BIGINT) USING parquet PARTITIONED BY ({BATCH_ID})")


def write_batch(df: DataFrame, name: str, batch_id: int) -> None:
    """Make ``df`` the rows that batch ``batch_id`` has brought into table ``name``: a batch that is run again replaces its own."""
    spark = df.sparkSession
    _batch_table(df, name)
    columns = [c for c in spark.table(name).columns if c != BATCH_ID]
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH_ID} = {int(batch_id)}) SELECT {', '.join(f'`{c}`' for c in columns)} FROM {{df}}",
        df=df,
    )


def land_files(
    spark: SparkSession,
    files: list[str],
    staged_table: str,
    target: str,
    quarantine: str,
    constraints: Mapping[str, Column],
    batch_id: int,
) -> None:
    """One micro-batch: the rows of ``files``, typed, into ``target`` or, where they break a constraint, into ``quarantine``.

    Rows of the wrong width are quarantined too. Files are read by their own
    headers and parsed once; both tables hold the batch under its id.
    """
    source = STAGING[staged_table][0]
    origin = F.col("_metadata.file_name").alias(SOURCE_FILE)
    raw = read_with_malformed(spark, files, RAW_TABLES[source], origin)
    typed = staging_sql(staged_table, raw)
    rows = raw.selectExpr(*typed, f"`{MALFORMED}`", f"`{SOURCE_FILE}`", f"current_timestamp() AS `{INGESTED_AT}`")
    whole = {MALFORMED_ROW: F.col(MALFORMED).isNull()}
    tagged = stored(rows.withColumn("violations", violations(rows, {**constraints, **whole})), "landing")
    broken = F.size("violations") > 0
    write_batch(tagged.where(~broken).drop("violations", MALFORMED), target, batch_id)
    write_batch(tagged.where(broken), quarantine, batch_id)


#: The name under which a row with too few or too many fields is quarantined.
MALFORMED_ROW = "as_many_fields_as_the_header"


def land_checked_stream(
    spark: SparkSession,
    source_dir: str,
    staged_table: str,
    target: str,
    quarantine: str,
    constraints: Mapping[str, Column],
    checkpoint: str | None = None,
    file_glob: str = "*.csv",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Land new ``file_glob`` files of ``source_dir`` as typed rows of ``staged_table``, checked row by row.

    Rows that meet ``constraints`` go to table ``target``, the others to
    ``quarantine`` with the names of those they break. The stream is of file
    names; a micro-batch reads its files, each by its own header, so files with
    other column orders land right, and a file without a needed column fails
    the query by name before anything of its batch is written. Both tables are
    partitioned by batch id and a batch overwrites its own partition: one that is
    run again after a failure, even between the two tables, lands once; a session
    that has read a table before then refreshes it. An empty batch lands nothing.
    """
    location = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/checked_{target.replace('.', '_')}"
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def land(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.select("path").collect())  # names only
        if files:
            land_files(batch.sparkSession, files, staged_table, target, quarantine, constraints, batch_id)

    stream = reader.load(source_dir).select("path")
    return stream.writeStream.foreachBatch(land).option("checkpointLocation", location).trigger(availableNow=True).start()
