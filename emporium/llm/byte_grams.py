"""Byte n-grams of labelled texts: counted in Spark, held as context trees."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import HashIndex, cut, ship, steps

_U = np.uint64
_PAD = b"\n"


def keys_of(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``order`` bytes that end at each byte of each text (lower-cased UTF-8), packed, the last byte lowest.

    Texts are led in by line feeds. Returns the keys of all texts in a row and
    where each text's begin.
    """
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    lead = _PAD * (order - 1)
    data = np.frombuffer(b"".join(lead + r for r in raw) + b"\0", dtype=np.uint8)[:-1]
    size = np.array([len(r) for r in raw], dtype=np.int64)
    begin = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(size, out=begin[1:])
    key = np.zeros(max(len(data) - order + 1, 0), dtype=np.uint64)
    for k in range(order):
        key = (key << _U(8)) | data[k : k + len(key)]
    at = np.repeat(np.arange(len(raw)) * (order - 1), size) + np.arange(begin[-1])
    return key[at], begin


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, dtype=np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """``(label, gram, n)``: how often each ``order`` bytes occur in all texts of each label of ``docs(label, text)``.

    Each task counts its own rows (memory and output are bounded by the
    distinct n-grams it sees), so the shuffle carries counts, not texts.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels: dict[str, int] = {}
        keys, counts = [], []
        held = 0
        for batch in batches:
            for pdf in steps(batch):
                key, begin = keys_of(list(pdf["text"]), order)
                code = np.array([labels.setdefault(x, len(labels)) for x in pdf["label"]], dtype=np.uint64)
                key |= np.repeat(code, np.diff(begin)) << _U(8 * order)
                k, c = np.unique(key, return_counts=True)
                keys.append(k)
                counts.append(c)
                held += len(k)
                if held > 4_000_000:
                    k, c = _merged(keys, counts)
                    keys, counts, held = [k], [c], len(k) // 2
        if keys:
            k, c = _merged(keys, counts)
            names = np.array(list(labels), dtype=object)
            for a in range(0, len(k), 500_000):
                part = k[a : a + 500_000]
                yield pd.DataFrame({
                    "label": names[(part >> _U(8 * order)).astype(np.int64)],
                    "gram": (part & _U((1 << 8 * order) - 1)).astype(np.int64),
                    "n": c[a : a + 500_000],
                })

    counted = docs.select("label", "text").mapInPandas(run, "label string, gram long, n long")
    return counted.groupBy("label", "gram").agg(F.sum("n").alias("n"))


def collect_grams(counted: DataFrame, max_cells: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labels, sorted n-grams and a count for each label, of a model that fits into one shard; else this raises."""
    grams = Grams(counted, 0, max_cells)
    if grams.shards > 1:
        raise ValueError(f"more than {max_cells} counts")
    return grams.labels, *grams.collect(0)


_SPREAD = 40503  # an odd factor that scatters the two bytes a shard is chosen by


def _shard(context, shards: int):
    """The shard of the two bytes before a byte, of numbers or a column of them."""
    return (context * _SPREAD) % 65536 % shards


class Grams:
    """All counts of a model, stored, and dealt to as many shards as it takes to hold about ``max_cells`` counts in each.

    The shard of a byte follows from the two bytes before it. So a shard has all
    n-grams of three bytes and more that end in its bytes, with exact counts, and
    a text's score is the sum of what its bytes score in their shards. The n-grams
    of one and two bytes, 65,792 at most, are in every shard. The driver and each
    machine hold one shard at a time; nothing is left out, whatever the corpus.
    """

    def __init__(self, counted: DataFrame, order: int, max_cells: int):
        self.counted, self.order = cut(counted), order
        self.labels = sorted(r["label"] for r in self.counted.select("label").distinct().collect())
        cells = self.counted.select("gram").distinct().count() * len(self.labels)
        self.shards = 1 if 0 < order < 3 else max(1, -(-cells // max_cells))
        self.low: tuple[np.ndarray, ...] | None = None
        if self.shards > 1:
            self.low = self._pairs()

    def _wide(self) -> list[Column]:
        return [F.coalesce(F.sum(F.when(F.col("label") == x, F.col("n"))), F.lit(0)).alias(f"n{k}") for k, x in enumerate(self.labels)]

    def _arrays(self, found: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(found["gram"].to_numpy())
        counts = np.empty((len(found), len(self.labels)))
        for k in range(len(self.labels)):
            counts[:, k] = found[f"n{k}"].to_numpy()[order]
        return found["gram"].to_numpy()[order].astype(np.uint64), counts

    def collect(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """The longest n-grams of a shard, sorted, and their counts by label."""
        rows = self.counted
        if self.shards > 1:
            context = F.shiftright("gram", 8).bitwiseAND(0xFFFF)
            rows = rows.where(_shard(context, self.shards) == shard)
        return self._arrays(rows.groupBy("gram").agg(*self._wide()).toPandas())

    def _pairs(self) -> tuple[np.ndarray, ...]:
        """All n-grams of two bytes: keys, counts by label, and how many n-grams of three bytes end in each."""
        threes = self.counted.groupBy("label", F.col("gram").bitwiseAND(0xFFFFFF).alias("three")).agg(F.sum("n").alias("n"))
        pairs = threes.withColumn("gram", F.col("three").bitwiseAND(0xFFFF))
        found = pairs.groupBy("gram").agg(*self._wide(), F.count_distinct("three").alias("distinct")).toPandas()
        order = np.argsort(found["gram"].to_numpy())
        return *self._arrays(found), found["distinct"].to_numpy()[order].astype(np.float64)

    def tree(self, shard: int) -> list[Level]:
        keys, counts = self.collect(shard)
        return levels(keys, counts, self.order, self.low)


def _sums(lookup: Lookup, texts: list[str], order: int, shard: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of its bytes' value rows, as far as they are the shard's, and its bytes."""
    key, begin = keys_of(texts, order)
    n = np.diff(begin)
    sums = np.zeros((len(texts), len(lookup.floor)))
    if shards == 1:
        full = n > 0
        if full.any():
            sums[full] = np.add.reduceat(lookup.rows(key), begin[:-1][full], axis=0, dtype=np.float64)
        return sums, n
    own = _shard((key >> _U(8)) & _U(0xFFFF), _U(shards)) == shard
    rows, owner = lookup.rows(key[own]), np.repeat(np.arange(len(texts)), n)[own]
    for k in range(rows.shape[1]):
        sums[:, k] = np.bincount(owner, weights=rows[:, k], minlength=len(texts))
    return sums, n


def scored(
    rows: DataFrame,
    grams: Grams,
    lookup_of: Callable[[list[Level]], Lookup],
    finish: Callable[[pd.DataFrame, np.ndarray, np.ndarray], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """``finish`` of batches of ``rows`` (with a column ``text``), their texts' sums of value rows and their bytes.

    A model of one shard is broadcast and the texts are read once. With more
    shards every one is broadcast in turn and adds its part: sums by text (by
    its SHA-256) are stored, added, and joined to the rows.
    """
    context, order, shards = rows.sparkSession.sparkContext, grams.order, grams.shards
    if shards == 1:
        model = context.broadcast(lookup_of(grams.tree(0)))

        def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for pdf in steps(batch):
                    yield finish(pdf, *_sums(model.value, list(pdf["text"]), order, 0, 1))

        return rows.mapInPandas(whole, schema)

    keyed = rows.withColumn("text_key", F.sha2(F.coalesce("text", F.lit("")), 256))
    parts = []
    for shard in range(shards):
        model = context.broadcast(lookup_of(grams.tree(shard)))

        def part(batches: Iterator[pd.DataFrame], model=model, shard=shard) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for pdf in steps(batch):
                    sums, n = _sums(model.value, list(pdf["text"]), order, shard, shards)
                    yield pd.DataFrame({"text_key": pdf["text_key"], "sums": list(sums), "n": n})

        found = keyed.select("text_key", "text").mapInPandas(part, "text_key string, sums array<double>, n long")
        parts.append(cut(found.groupBy("text_key").agg(F.first("sums").alias("sums"), F.first("n").alias("n"))))
        model.unpersist()
    width = len(grams.labels)
    added = reduce(DataFrame.unionByName, parts).groupBy("text_key").agg(
        F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(width)]).alias("text_sums"), F.first("n").alias("text_bytes")
    )

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pdf in steps(batch):
                sums = np.array([[x if x is not None else 0.0 for x in row] for row in pdf["text_sums"]]).reshape(len(pdf), -1)
                yield finish(pdf, sums, pdf["text_bytes"].to_numpy())

    return keyed.join(added, "text_key").mapInPandas(joined, schema)


def held_out() -> Column:
    """True for rows whose crc32(doc_id as text) mod 4 is 2: nothing is learned from them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


class Level:
    """All n-grams of one length and the contexts (all but the last byte) they follow."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, distinct: np.ndarray, length: int):
        self.keys, self.counts, self.length = keys, counts, length
        self.contexts, first, self.context_of = np.unique(keys >> _U(8), return_index=True, return_inverse=True)
        self.total = np.add.reduceat(counts, first, axis=0)
        self.types = np.add.reduceat((counts > 0).astype(np.float64), first, axis=0)
        #: In how many longer n-grams' contexts each n-gram occurs, over all labels, and the same by context.
        self.distinct = distinct
        self.distinct_total = np.add.reduceat(distinct, first)
        self.distinct_types = np.add.reduceat((distinct > 0).astype(np.float64), first)


    def below(self, shorter: Level) -> np.ndarray:
        """Each n-gram's row, without its first byte, in the next shorter level."""
        return np.searchsorted(shorter.keys, self.keys & _U((1 << 8 * shorter.length) - 1))


def levels(keys: np.ndarray, counts: np.ndarray, order: int, pairs: tuple[np.ndarray, ...] | None = None) -> list[Level]:
    """Context levels of length 1 to ``order``; the shorter ones follow from the longest n-grams' suffixes.

    Where ``keys`` are a shard's, the n-grams of two bytes are given (keys,
    counts, how many longer ones end in each), as other shards have their share of them.
    """
    out = [Level(keys, counts, np.ones(len(keys)), order)]
    for length in range(order - 1, 0, -1):
        if length == 2 and pairs is not None:
            keys, counts, seen = pairs
        else:
            short = keys & _U((1 << 8 * length) - 1)
            order_ = np.argsort(short, kind="stable")
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(short)), dtype=bool), np.diff(short[order_]) > 0)))
            seen = np.diff(np.append(first, len(short))).astype(np.float64)
            keys, counts = short[order_][first], np.add.reduceat(counts[order_], first, axis=0)
        out.append(Level(keys, counts, seen, length))
    return out[::-1]


class Lookup:
    """A value row for the longest known n-gram that ends at each byte.

    ``values[k]`` holds a row for each n-gram of level k; where a byte's n-gram
    is unknown, ``misses[k]`` adds a row for its context, if that is known, and
    the next shorter n-gram is tried; ``floor`` ends the chain.
    """

    def __init__(self, tree: list[Level], values: list[np.ndarray], misses: list[np.ndarray], floor: np.ndarray):
        self.values = [v.astype(np.float32, copy=False) for v in values]
        self.misses = [m.astype(np.float32, copy=False) for m in misses]
        self.floor = floor.astype(np.float32)
        self.grams = [HashIndex(level.keys) for level in tree]
        self.contexts = [HashIndex(level.contexts) for level in tree]

    def rows(self, key: np.ndarray) -> np.ndarray:
        out = np.zeros((len(key), len(self.floor)), dtype=np.float32)
        left = np.arange(len(key))
        for k in range(len(self.grams) - 1, -1, -1):
            now = key[left] & _U((1 << 8 * (k + 1)) - 1)
            row = self.grams[k].find(now)
            known = row >= 0
            if len(left) == len(key) and known.all():
                return self.values[k][row]
            out[left[known]] += self.values[k][row[known]]
            left, now = left[~known], now[~known]
            context = self.contexts[k].find(now >> _U(8))
            here = context >= 0
            out[left[here]] += self.misses[k][context[here]]
            if not len(left):
                return out
        out[left] += self.floor
        return out
