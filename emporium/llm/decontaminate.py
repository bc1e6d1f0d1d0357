"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import HashIndex, mix, shingles, ship, steps, words

SCHEMA = "doc_id long, item_id long, n_item long, n_shared long, containment double"


def _sets(texts: list[str], size: int) -> list[np.ndarray]:
    s, begin = shingles(*words(texts), size)
    return [np.unique(s[a:b]) for a, b in zip(begin[:-1], begin[1:])]


@dataclass
class Partition:
    """Items of ``low`` to ``2 * low - 1`` shingles and an index over their bottom-k MinHash sketches."""

    low: int
    items: np.ndarray  # row in Searched.sets of each sketch value
    starts: np.ndarray  # where each distinct value's items begin
    index: HashIndex


class Searched:
    """One bounded block of test items, ready to be probed."""

    def __init__(self, ids: list, sets: list[np.ndarray], threshold: float):
        self.ids, self.sets, self.threshold = ids, sets, threshold
        self.partitions: list[Partition] = []
        sizes = np.array([len(s) for s in sets])
        low = 1
        while len(sizes) and low <= sizes.max():
            rows = np.flatnonzero((sizes >= low) & (sizes < 2 * low))
            if len(rows):
                # A text that holds the threshold's share of an item misses fewer of its
                # shingles than this, so it holds one of the item's k least at any size here.
                high = 2 * low - 1
                k = high - int(np.ceil(threshold * high - 1e-9)) + 1
                sketches = [s[np.argsort(mix(s))[:k]] for s in (sets[r] for r in rows)]
                value = np.concatenate(sketches)
                item = np.repeat(rows, [len(s) for s in sketches])
                order = np.argsort(value, kind="stable")
                keys, starts = np.unique(value[order], return_index=True)
                self.partitions.append(Partition(low, item[order], np.append(starts, len(order)), HashIndex(keys)))
            low *= 2

    def matches(self, texts: list[str], size: int) -> Iterator[tuple[int, int, int]]:
        """(row of the text, row of the item, shared shingles) at or over the threshold."""
        s, begin = shingles(*words(texts), size)
        count = np.diff(begin)
        owner = np.repeat(np.arange(len(texts)), count)
        for p in self.partitions:
            fits = count >= np.ceil(self.threshold * p.low - 1e-9)  # shorter texts cannot hold an item of this size
            found = p.index.find(s)
            hit = np.flatnonzero((found >= 0) & fits[owner])
            if not len(hit):
                continue
            n = (p.starts[1:] - p.starts[:-1])[found[hit]]
            at = np.repeat(p.starts[found[hit]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pairs = np.unique(np.stack([np.repeat(owner[hit], n), p.items[at]], axis=1), axis=0)
            doc, own = -1, None
            for d, i in pairs:
                if d != doc:
                    doc, own = d, np.unique(s[begin[d] : begin[d + 1]])
                where = np.searchsorted(own, self.sets[i])
                shared = int((own[np.minimum(where, len(own) - 1)] == self.sets[i]).sum())
                if shared >= self.threshold * len(self.sets[i]) - 1e-9:
                    yield int(d), int(i), shared


def contamination(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    shingle: int = 5,
    block_words: int = 2_000_000,
) -> DataFrame:
    """Test items inside documents: ``(doc_id, item_id, n_item, n_shared, containment)``.

    A row says that ``docs(doc_id, text)`` holds ``containment`` >= ``threshold``
    of the distinct five-word shingles of ``items(item_id, text)``, anywhere in
    its whole text. Items are partitioned by size; each partition has bottom-k
    MinHash sketches with its own k, long enough that a document at the
    threshold always holds a sketch value (no link is lost), and skips documents
    too short for it. Candidates are verified by exact shingle containment.

    The items are a stated query set against all documents: they are searched
    in blocks of about ``block_words`` words, so what is sent to the machines is
    bounded whatever their number; documents are never shuffled.

    Null and empty texts, and items of fewer than five words, have no shingle
    and match nothing. A repeated item or document row yields its rows again;
    null ids are carried through. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    items = items.select("item_id", "text").where("text is not null")
    total = items.select(F.sum(F.length("text") / 4).alias("n")).first()["n"] or 0
    blocks = max(1, int(np.ceil(total / block_words)))
    out = None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        sets = _sets([r["text"] for r in rows], shingle)
        kept = [i for i, s in enumerate(sets) if len(s)]
        block = spark.sparkContext.broadcast(Searched([rows[i]["item_id"] for i in kept], [sets[i] for i in kept], threshold))
        found = docs.select("doc_id", "text").mapInPandas(_probe(block, shingle), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def _probe(block, shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searched: Searched = block.value
        for batch in batches:
            for pdf in steps(batch):
                ids = pdf["doc_id"].to_numpy(dtype=object, na_value=None)
                rows = [
                    (ids[d], searched.ids[i], len(searched.sets[i]), shared, shared / len(searched.sets[i]))
                    for d, i, shared in searched.matches(list(pdf["text"]), shingle)
                ]
                if rows:
                    out = pd.DataFrame(rows, columns=["doc_id", "item_id", "n_item", "n_shared", "containment"])
                    yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

    return run
