"""Join operators: cardinality-checked joins and orphan (anti-join) counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CARDINALITIES = {"many_to_one", "one_to_one", "one_to_many", "many_to_many"}


def _raise_above_one(count: str, message: str) -> Column:
    """A filter condition that keeps every row and fails where ``count`` is over one.

    It sits in a filter, so column pruning cannot remove it.
    """
    return F.when(F.col(count) > 1, F.raise_error(F.lit(message))).isNull()


def unique_by(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """``df``'s rows with a complete key, one for each key; the query fails if a key repeats.

    The key is unique because the rows are grouped by it, which the optimizer
    can see: a left join to the result is dropped altogether when none of its
    columns is used. Rows with a NULL key are left out, as they match nothing.
    The grouping shuffles on the key, and a sort-merge join on the key reuses
    that shuffle. Filters on other columns stay above it.
    """
    keys = list(keys)
    values = [c for c in df.columns if c not in keys]
    complete = df.dropna(subset=keys)
    grouped = complete.groupBy(*keys).agg(*[F.first(c).alias(c) for c in values], F.count(F.lit(1)).alias("_key_rows"))
    message = f"duplicate key ({', '.join(keys)}) in {label}"
    return grouped.where(_raise_above_one("_key_rows", message)).select(*df.columns)


def require_unique(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """``df`` unchanged, rows with a NULL key included; the query fails if a key repeats.

    For the left side of joins on the same key: the keys alone are counted and
    joined back, partitioned as those joins need it, so only the key column is
    read and shuffled once more.
    """
    keys = list(keys)
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_key_rows"))
    message = f"duplicate key ({', '.join(keys)}) in {label}"
    counted = df.join(counts, keys, "left")
    return counted.where(_raise_above_one("_key_rows", message)).select(*df.columns)


def guarded_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    validate: str = "many_to_one",
    label: str = "join",
) -> DataFrame:
    """Equi-join that fails instead of silently fanning out.

    ``validate`` states the expected cardinality: ``many_to_one`` requires the
    right keys to be unique, ``one_to_many`` the left keys, ``one_to_one``
    both. NULL keys follow SQL semantics and never match.
    """
    if validate not in _CARDINALITIES:
        raise ValueError(f"validate must be one of {sorted(_CARDINALITIES)}")
    if how not in ("left", "inner"):
        raise ValueError("a guarded join is a left or an inner join")
    keys = [on] if isinstance(on, str) else list(on)
    if validate in ("one_to_one", "one_to_many"):
        left = require_unique(left, keys, f"left side of {label}")
    if validate in ("one_to_one", "many_to_one"):
        right = unique_by(right, keys, f"right side of {label}")
    return left.join(right, keys, how)


def orphan_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row, ``orphan_rows``: child rows whose non-null ``key`` has no parent.

    Child keys are counted first (combined map-side, so a key repeated in a
    third of the child rows costs one row per map task), then anti-joined to
    the parent keys; only the key counts cross the shuffle.
    """
    keyed = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    parents = parent.select(key).where(F.col(key).isNotNull())
    orphans = keyed.join(parents, key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("orphan_rows"))
