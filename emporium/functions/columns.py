"""Scalar column expressions used by the model (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000


def staged_sql(source: T.DataType, name: str, dtype: str) -> str:
    """SQL text that casts raw column ``name`` (of type ``source``) to the staged type ``dtype``.

    Raw text (the CSV path) is parsed with the ``try_`` family, so malformed
    values become NULL instead of failing the job under ANSI mode. A whole
    number may be written with a fraction of zeros (``5.0``); any other fraction
    is malformed. Already typed input (the parquet path) is cast directly; a
    timestamp without time zone becomes a session-zone timestamp with the same
    wall clock.
    """
    col = f"`{name}`"
    if isinstance(source, T.StringType):
        if dtype == "timestamp":
            return f"try_to_timestamp({col})"
        if dtype == "string":
            return col
        if dtype == "int":
            return f"try_cast(regexp_replace(trim({col}), '\\\\.0*$', '') AS int)"
        return f"try_cast({col} AS {dtype})"
    if source.simpleString() == dtype:
        return col
    return f"try_cast({col} AS {dtype})"


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    """Column name -> type, fetched once (each ``df.schema`` is a JVM round trip)."""
    return {f.name: f.dataType for f in df.schema.fields}


def malformed(source: T.DataType, name: str, dtype: str) -> Column:
    """True where raw ``name`` holds a value that does not parse as ``dtype``."""
    return F.col(name).isNotNull() & F.expr(staged_sql(source, name, dtype)).isNull()


def whole_days(end: Column | str, start: Column | str) -> Column:
    """Calendar days between two timestamps (midnights crossed)."""
    return F.datediff(_c(end), _c(start))


def fractional_days(end: Column | str, start: Column | str) -> Column:
    """Exact elapsed days between two timestamps, as a double."""
    return (F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / F.lit(MICROS_PER_DAY)


def when_both_present(a: Column | str, b: Column | str, value: Column) -> Column:
    """``value`` when both inputs are non-null, otherwise NULL (no ELSE)."""
    return F.when(_c(a).isNotNull() & _c(b).isNotNull(), value)


def month_label(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM")


def date_label(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd")


def month_start(ts: Column | str) -> Column:
    return F.date_trunc("month", _c(ts)).cast("date")


def composite_key(*cols: Column | str, sep: str = "|") -> Column:
    """Null-propagating key ``a || sep || b``: a NULL part makes the key NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / nullif(denominator, 0)`` (ANSI division by zero raises)."""
    return _c(numerator) / F.nullif(_c(denominator), F.lit(0))


def money(c: Column | str) -> Column:
    """Money is decimal(18,2) throughout the model."""
    return _c(c).cast(T.DecimalType(18, 2))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
