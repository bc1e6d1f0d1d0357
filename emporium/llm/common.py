"""Shared helpers: lineage cuts, vectorised word hashing, an int hash index."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_U = np.uint64
#: Characters one vectorised step works on; a longer single text is a step of its own.
STEP_CHARS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (tests, a notebook on one machine) a scratch
    folder is made.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if path is None and current is not None:
        return current
    if path is None:
        path = tempfile.mkdtemp(prefix="emporium-shared-")
    if current is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(tempfile.mkdtemp(prefix="emporium-code-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def cut(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder: later reads neither recompute it nor need its executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def steps(pdf: pd.DataFrame, column: str = "text", chars: int = STEP_CHARS) -> Iterator[pd.DataFrame]:
    """Slices of about ``chars`` characters; a null text becomes empty."""
    pdf = pdf.reset_index(drop=True)
    pdf[column] = pdf[column].fillna("").astype(object)
    sizes = pdf[column].str.len().to_numpy(dtype=np.int64)
    if not len(sizes):
        return
    which = (np.cumsum(sizes) - sizes) // chars
    bounds = np.flatnonzero(np.diff(which)) + 1
    for a, b in zip([0, *bounds], [*bounds, len(sizes)]):
        yield pdf.iloc[a:b]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal in, equal out, all bits spread."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: is it part of a word (letter, digit or underscore); its random value."""
    if not _TABLES:
        n = 0x110000
        word = np.zeros(n, dtype=bool)
        word[:] = np.fromiter((chr(i).isalnum() for i in range(n)), dtype=bool, count=n)
        word[ord("_")] = True
        _TABLES["word"] = word
        _TABLES["value"] = mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
    return _TABLES["word"], _TABLES["value"]


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0xD6E8FEB86659FD93
_POWERS: dict[int, np.ndarray] = {}


def _kept_powers(base: int, n: int) -> np.ndarray:
    """``powers``, kept for a step's length; more only while a longer text needs them."""
    if base not in _POWERS:
        _POWERS[base] = powers(base, STEP_CHARS)
    return _POWERS[base][:n] if n <= STEP_CHARS else powers(base, n)


def words(texts: list[str], spans: bool = False):
    """Hashes of the words of all texts, in order, and where each text's words begin.

    A word is a run of letters, digits and underscores, compared in lower case.
    Returns ``(hash, first)``: ``hash[first[i]:first[i + 1]]`` are text ``i``'s
    words. With ``spans`` also each word's start and end offset (code points of
    the text; the text is then compared by lower-casing single characters).
    """
    is_word, value = _tables()
    low = [t.lower() for t in texts]
    if spans:
        low = [a if len(a) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t) for a, t in zip(low, texts)]
    code = np.frombuffer(("\0".join(low) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.intp)
    mask = is_word[code]
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    begin = np.zeros(len(low) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in low], out=begin[1:])
    first = np.searchsorted(start, begin)
    if not len(start):
        empty = np.zeros(0, dtype=np.uint64)
        return (empty, first, start, end) if spans else (empty, first)
    length = end - start
    # A word's polynomial is a stretch of the whole line's, taken back to the power 0.
    total = np.cumsum(value[code] * _kept_powers(_BASE, len(code)))
    h = total[end - 1] - np.where(start > 0, total[start - 1], _U(0))
    h *= _kept_powers(pow(_BASE, -1, 2**64), len(code))[start]
    h = mix(h + length.astype(np.uint64))
    if not spans:
        return h, first
    origin = np.repeat(begin[:-1], np.diff(first))
    return h, first, start - origin, end - origin


def shingles(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, in order, and where each text's runs begin."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    begin = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(count, out=begin[1:])
    at = np.repeat(first[:-1] - begin[:-1], count) + np.arange(begin[-1])
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        out = out * _U(0xD6E8FEB86659FD93) + h[at + k]
    return mix(out), begin


class HashIndex:
    """Row numbers of distinct uint64 keys; looking up an array is a few gathers.

    Keys are placed in rounds of direct-address tables; those that collide go
    to the next round's table.
    """

    def __init__(self, keys: np.ndarray):
        self.keys = np.ascontiguousarray(keys, dtype=np.uint64)
        self.rounds: list[tuple[int, int, np.ndarray]] = []
        left = np.arange(len(self.keys), dtype=np.int32)
        seed = 0x9E3779B97F4A7C15
        while len(left):
            bits = max(4, int(np.ceil(np.log2(len(left) * 4))))
            seed = (seed * 0xD1342543DE82EF95 + 1) % 2**64 | 1
            table = np.full(1 << bits, -1, dtype=np.int32)
            slot = self._slot(self.keys[left], seed, bits)
            table[slot] = left
            left = left[table[slot] != left]
            self.rounds.append((seed, bits, table))

    @staticmethod
    def _slot(keys: np.ndarray, seed: int, bits: int) -> np.ndarray:
        x = keys ^ (keys >> _U(32))
        return ((x * _U(seed)) >> _U(64 - bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it is not there."""
        out = np.full(len(keys), -1, dtype=np.int32)
        if not self.rounds:
            return out
        left = None
        for seed, bits, table in self.rounds:
            now = keys if left is None else keys[left]
            got = table[self._slot(now, seed, bits)]
            hit = (got >= 0) & (self.keys[np.maximum(got, 0)] == now)
            if left is None:
                out[hit] = got[hit]
                left = np.flatnonzero(~hit & (got >= 0))
            else:
                out[left[hit]] = got[hit]
                left = left[~hit & (got >= 0)]
            if not len(left):
                break
        return out
