"""Row-level restriction and masking: what a role may see of a fact, from a policy table.

A policy has rows ``role, value``: a role sees the rows whose restricted column
has one of its values. A role without rows sees nothing. Identities are shown as
salted hashes: equal within a salt, so counts of people and joins between masked
tables still work, and not to be found by hashing known identities without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .semantic import SEMANTIC_ORDER_COLUMNS

#: Up to this many values of a role become literals of a filter; a role with more is joined.
LITERAL_VALUES = 1000
POLICY_SCHEMA = "role string, value string"
#: Columns of the order fact that tell who a customer is; the rest of a masked view is left as it is.
IDENTITIES = ("customer_unique_id",)


class PolicyError(ValueError):
    """A policy that cannot be applied."""


def masked(identity: Column | str, salt: Column | str) -> Column:
    """The salted hash of an identity; NULL stays NULL. The salt's length is hashed, so no two pairs run together."""
    value = (F.col(identity) if isinstance(identity, str) else identity).cast("string")
    key = F.lit(salt) if isinstance(salt, str) else salt
    return F.when(value.isNotNull(), F.sha2(F.concat(F.length(key).cast("string"), F.lit(":"), key, value), 256))


def masked_columns(df: DataFrame, salt: Column | str, identities: Sequence[str] = IDENTITIES) -> list[Column]:
    return [masked(c, salt).alias(c) if c in identities else F.col(c) for c in df.columns]


def allowed_values(policy: DataFrame, role: str, most: int = LITERAL_VALUES) -> list[str] | None:
    """The distinct values of a role, sorted; None if there are more than ``most``."""
    rows = policy.where((F.col("role") == role) & F.col("value").isNotNull()).select("value").distinct().limit(most + 1).collect()
    return None if len(rows) > most else sorted(r["value"] for r in rows)


def restricted(fact: DataFrame, policy: DataFrame, role: str, column: str, most: int = LITERAL_VALUES) -> DataFrame:
    """The rows of ``fact`` that ``role`` may see by ``column``; a NULL there is nobody's.

    The role's values are read first. A short list becomes a filter on literals,
    which reaches the scan: row groups without an allowed value are not read. A
    longer one stays a semi join with the policy.
    """
    values = allowed_values(policy, role, most)
    if values is not None:
        return fact.where(F.col(column).isin(values)) if values else fact.where(F.lit(False))
    own = policy.where(F.col("role") == role).select(F.col("value").alias("_allowed"))
    return fact.join(own, fact[column].cast("string") == F.col("_allowed"), "left_semi")


def visible_by_role(fact: DataFrame, policy: DataFrame, column: str) -> DataFrame:
    """``fact`` once for each role that may see a row, with the role: for reports over all roles at once.

    A row is repeated for its roles only; the policy's rows are made distinct, so
    no row is seen twice by one.
    """
    rules = policy.where("role IS NOT NULL AND value IS NOT NULL").select("role", F.col("value").alias("_value")).distinct()
    return fact.join(rules, fact[column].cast("string") == F.col("_value")).drop("_value")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(role: str) -> str:
    name = "".join(c if c.isalnum() and c.isascii() else "_" for c in role.lower())
    if not name.strip("_"):
        raise PolicyError(f"role {role!r} has no letters to name a view by")
    return name


def publish_restricted_views(
    spark: SparkSession,
    policy: DataFrame,
    source: str,
    salt_table: str,
    database: str,
    view: str = "semantic_order_metrics",
    column: str = "customer_state",
    columns: Sequence[str] = SEMANTIC_ORDER_COLUMNS,
    identities: Sequence[str] = IDENTITIES,
) -> dict[str, str]:
    """A persistent view ``{database}.{view}_{role}`` over table ``source`` for each role of ``policy``; role -> name.

    A view filters by its role's values and shows ``identities`` hashed with the
    one row of ``salt_table`` (column ``salt``), which only the views' owner
    needs to read; the salt is not in a view's text. Views are replaced; a view
    of a role that has left the policy is made to show nothing. Roles whose
    names give the same view name are refused. The policy's values become
    literals, so views are published anew when it changes.
    """
    if spark.table(salt_table).where("salt IS NOT NULL AND salt <> ''").limit(2).count() != 1:
        raise PolicyError(f"{salt_table} must have one row with a salt")
    rows = policy.where("role IS NOT NULL").groupBy("role").agg(F.sort_array(F.collect_set("value")).alias("values")).collect()
    names = {r["role"]: f"{database}.{view}_{_name(r['role'])}" for r in rows}
    if len(set(names.values())) < len(names):
        raise PolicyError(f"roles share a view name: {sorted(names)}")
    known = {f"{database}.{t.name}" for t in spark.catalog.listTables(database) if t.name.startswith(f"{view}_") and t.tableType == "VIEW"}
    salt = f"(SELECT max(salt) FROM {salt_table})"
    shown = [
        f"CASE WHEN {c} IS NOT NULL THEN sha2(concat(cast(length({salt}) AS string), ':', {salt}, cast({c} AS string)), 256) END AS {c}"
        if c in identities else c for c in columns
    ]
    of = {names[r["role"]]: r["values"] for r in rows}
    for name in sorted(known | set(of)):
        values = of.get(name)
        where = f"{column} IN ({', '.join(map(_quoted, values))})" if values else "false"
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(shown)} FROM {source} WHERE {where}")
    return names
