"""URL filter: a broadcast trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import ship


@dataclass(frozen=True)
class UrlRule:
    """``allow`` or ``block`` a host with its subdomains, below a path (which begins with ``/``)."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


class Trie:
    """Host labels from the right, then path segments; each node's rules by path.

    The walk goes down the host labels of a url; at each node that ends a rule's
    host it goes down the path segments. The longest rule that fits wins: the
    deeper host first, then the deeper path. A rule's last path segment may be
    the beginning of the url's (``/en`` fits ``/english``), as a path that starts
    with the rule's does.
    """

    def __init__(self, rules: Iterable[UrlRule]):
        self.root: dict = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.setdefault(label, {})
            paths = node.setdefault("", {})  # no label is empty in a rule's host
            *whole, rest = rule.path.split("/")
            for segment in whole:
                paths = paths.setdefault(segment, {})
            old = paths.setdefault(None, {}).get(rest)
            if old is None or rule.verdict == "block":  # the same entry twice: block wins
                paths[None][rest] = rule

    def find(self, host: str, path: str) -> UrlRule | None:
        best, node = None, self.root
        if not host:
            return None
        for label in reversed(host.split(".")):
            node = node.get(label) if label else None
            if node is None:
                break
            if "" in node:
                best = self._path(node[""], path) or best
        return best

    @staticmethod
    def _path(paths: dict, path: str) -> UrlRule | None:
        best = None
        for segment in path.split("/"):
            ends = paths.get(None, {})
            fits = [rest for rest in ends if segment.startswith(rest)]
            if fits:
                best = ends[max(fits, key=len)]
            paths = paths.get(segment)
            if paths is None:
                break
        return best


def judge(
    pages: DataFrame,
    rules: Iterable[UrlRule],
    default: str = "allow",
    broadcast_rules: int = 500_000,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row of ``pages(page_id, url)``.

    A rule fits its host and all subdomains where the url's path starts with
    the rule's path; the longest one wins. Without one, ``rule`` is null and the
    verdict is ``default``. Null urls and urls without ``://`` have an empty host
    and path and fit no rule. Repeated rows and null ids are carried through;
    other columns are ignored.

    The trie is broadcast up to ``broadcast_rules`` rules; a longer list is
    joined instead (every host suffix with every path prefix of a rule's
    length), so nothing large is sent to each machine.
    """
    spark = pages.sparkSession
    rules = list(rules)
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if len(rules) > broadcast_rules:
        return _joined(parsed, rules, default)
    ship(spark)
    trie = spark.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def walk(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [trie.value.find(h, p) for h, p in zip(host, path)]
        return pd.DataFrame({
            "rule": [None if r is None else r.name for r in found],
            "verdict": [default if r is None else r.verdict for r in found],
        })

    judged = parsed.withColumn("judged", walk("host", "path"))
    return judged.select("page_id", "host", "path", F.col("judged.rule").alias("rule"), F.col("judged.verdict").alias("verdict"))


def _joined(parsed: DataFrame, rules: list[UrlRule], default: str) -> DataFrame:
    """The same result by equi joins of the distinct (host, path) with the rules."""
    spark = parsed.sparkSession
    lengths = F.array(*[F.lit(n) for n in sorted({len(r.path) for r in rules})])
    table = spark.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in rules], "r_host string, r_path string, r_name string, r_verdict string")
    table = table.groupBy("r_host", "r_path", "r_name").agg(F.max("r_verdict").alias("r_verdict"))
    urls = parsed.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    tried = (
        urls.withColumn("suffix", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, 10_000), "."))))
        .withColumn("n", F.explode(lengths))
        .where(F.col("n") <= F.length("path"))
        .withColumn("prefix", F.expr("substring(path, 1, n)"))
    )
    fit = tried.join(table, (F.col("suffix") == F.col("r_host")) & (F.col("prefix") == F.col("r_path")))
    longest = F.struct(F.length("r_host"), F.length("r_path"))
    best = fit.groupBy("host", "path").agg(F.max_by(F.struct("r_name", "r_verdict"), longest).alias("best"))
    return parsed.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.r_name").alias("rule"), F.coalesce("best.r_verdict", F.lit(default)).alias("verdict")
    )
