"""CSV extracts: presence check, header-aware string read, lazy loading of the set.

An extract may be one file, a folder or a pattern of files. Each file is read by
its own header: files whose headers agree are one scan, and the scans are united
by column name. Every raw column is read as text (no inference: zip prefixes keep their
leading zeros, and a malformed number cannot change a column's type). Quoted
fields may contain commas, doubled quotes and line breaks.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce
from itertools import islice
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import RAW_TABLES, RawTable
from .tables import LazyTables

BOM = "\ufeff"


class MissingInputError(FileNotFoundError):
    """Raised once, naming every required input that is absent."""


def _join(directory: str, name: str) -> str:
    return f"{directory.rstrip('/')}/{name}"


def missing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The paths that do not exist (checked through Spark's file system layer,
    so object stores and HDFS work the same as local disk)."""
    missing = []
    for path in paths:
        try:
            spark.read.format("binaryFile").load(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                missing.append(path)
            else:
                raise
    return missing


def require_inputs(spark: SparkSession, directory: str, files: Mapping[str, str]) -> None:
    """Fail with one error listing all missing files, not just the first."""
    missing = missing_paths(spark, [_join(directory, f) for f in files.values()])
    if missing:
        names = [m.rsplit("/", 1)[-1] for m in missing]
        raise MissingInputError(f"Missing input files in {directory}: " + ", ".join(names))


def clean_header(df: DataFrame) -> DataFrame:
    """Strip a byte-order mark that survived into a column name."""
    names = [c.lstrip(BOM).strip() for c in df.columns]
    return df if names == df.columns else df.toDF(*names)


#: Rows that do not have the header's number of fields go here, whole.
MALFORMED = "_malformed_row"


def _reader(spark: SparkSession, table: RawTable):
    # Only extracts with free text can have line breaks in a field. Without
    # them a file is split at its lines, so a large one is read by many tasks.
    return (
        spark.read.option("multiLine", table.free_text)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
    )


def _checked(path: str, names: list[str], table: RawTable) -> list[str]:
    """The column names in a file's header; the catalogue's columns must be among them, each once."""
    absent = [c for c in table.columns if c not in names]
    if absent:
        raise ValueError(f"{path}: missing columns {absent}")
    double = sorted({c for c in names if names.count(c) > 1})
    if double:
        raise ValueError(f"{path}: columns named twice {double}")
    return names


def files_of(spark: SparkSession, path: str, file_glob: str = "*") -> list[str]:
    """The files that ``path`` (a file, a folder or a pattern) stands for, but for those of no bytes.

    Their content is not read.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", file_glob).load(path)
    return sorted(r["path"] for r in listing.select("path").collect())


def _plain(path: str) -> str:
    """One spelling of a path: the listing and the rows' metadata write slashes and blanks in different ways."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(path))


def _first(rows: Iterator) -> Iterator:
    return islice(rows, 1)


def first_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The first line of each file that has one, by one job in which a task stops at a file's first line."""
    # A file that costs more to open than a partition holds is never packed with another, nor cut.
    settings = {"spark.sql.files.openCostInBytes": str(1 << 50), "spark.sql.files.maxPartitionBytes": str(1 << 50)}
    before = {k: spark.conf.get(k) for k in settings}
    lines = spark.read.text(files).select("_metadata.file_path", "value")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = {_plain(r["file_path"]): r["value"] for r in lines.rdd.mapPartitions(_first).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return {f: found[_plain(f)] for f in files if _plain(f) in found}


def headers_of(spark: SparkSession, files: list[str], table: RawTable) -> dict[tuple[str, ...], list[str]]:
    """Header -> the files that have it, each header checked against the catalogue.

    Fails by name on files without a needed column or with a column named twice,
    and so on files without a header. Only the header lines reach the driver.
    """
    if len(files) == 1:  # Spark reads a single header without a job over the file
        names = clean_header(_reader(spark, table).option("header", True).option("inferSchema", False).csv(files[0])).columns
        return {tuple(_checked(files[0], names, table)): files}
    lines = first_lines(spark, files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        names = [n.lstrip(BOM).strip() for n in next(csv.reader([lines.get(file, "").lstrip(BOM)]), [])]
        groups.setdefault(tuple(_checked(file, names, table)), []).append(file)
    return groups


def read_with_malformed(spark: SparkSession, path: str | list[str], table: RawTable, *more: Column) -> DataFrame:
    """One extract as strings by header name, with :data:`MALFORMED` (NULL for a row of the right width).

    ``path`` is a file, a folder, a pattern or a list of files; every file is
    read by its own header. A row with too few or too many fields keeps the
    values it has, and its text in :data:`MALFORMED`, so it can be counted.
    ``more`` are further columns of the scan, such as the file's name.
    """
    files = files_of(spark, path) if isinstance(path, str) else list(path)
    if not files:
        raise MissingInputError(f"no files in {path}")
    parts = []
    for names, group in headers_of(spark, files, table).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
        reader = _reader(spark, table).option("header", True).option("enforceSchema", True).option("columnNameOfCorruptRecord", MALFORMED)
        parts.append(reader.schema(schema).csv(group).select(*table.columns, MALFORMED, *more))
    return reduce(DataFrame.unionByName, parts)


def malformed_rows(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    """One row: ``table, rows, malformed_rows`` of an extract."""
    df = read_with_malformed(spark, path, table)
    # All columns are named, so that the scan parses every field of a row.
    read = F.length(F.concat_ws("", *table.columns)) >= 0
    return df.agg(
        F.lit(table.name).alias("table"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(MALFORMED).isNotNull() & read).alias("malformed_rows"),
    )


def read_extract(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    """One extract (a file, a folder or a pattern) as strings, by each file's header, in catalogue order."""
    return read_with_malformed(spark, path, table).drop(MALFORMED)


def resolve_files(spark: SparkSession, directory: str) -> dict[str, str]:
    """Table -> file name in ``directory``, by the catalogue's name patterns.

    An extract may be called ``<table>.csv`` or anything that ends in
    ``<table>_dataset.csv``. The longest table name that fits a file has it
    (``x_order_items_dataset.csv`` is no ``items``); two files for one table are
    an error, and a table without one keeps its default name, which the presence
    check then reports.
    """
    found: dict[str, list[str]] = {}
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(directory).select("path")
    for row in listing.collect():  # one row for each file of the folder
        name = row["path"].rsplit("/", 1)[-1]
        fits = [t for t, spec in RAW_TABLES.items() if spec.fits(name)]
        if fits:
            found.setdefault(max(fits, key=len), []).append(name)
    double = {t: sorted(names) for t, names in found.items() if len(names) > 1}
    if double:
        raise ValueError(f"more than one file for a table in {directory}: {double}")
    return {t: found.get(t, [spec.default_file])[0] for t, spec in RAW_TABLES.items()}


def load_raw(
    spark: SparkSession,
    directory: str,
    files: Mapping[str, str] | None = None,
) -> LazyTables:
    """The nine raw extracts of ``directory`` (``files`` maps table -> file name; else by name pattern).

    All files are checked before anything is read.
    """
    files = dict(files or resolve_files(spark, directory))
    unknown = set(files) - set(RAW_TABLES)
    if unknown:
        raise ValueError(f"unknown raw tables {sorted(unknown)}")
    require_inputs(spark, directory, files)
    return LazyTables(
        {
            name: (lambda name=name: read_extract(spark, _join(directory, files[name]), RAW_TABLES[name]))
            for name in files
        }
    )
