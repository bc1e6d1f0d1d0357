"""N-gram Jaccard join of a table with itself by chosen paths.

Documents are sets of five-word shingles. A set is embedded as its MinHash
values; a *path* is a list of (coordinate, value) pairs two sets share. Every
run splits the sets along randomly chosen coordinates: a bucket small enough is
compared by brute force, a larger one is split again, and the runs are repeated
until a pair at the threshold meets with the target probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import cut, mix, shingles, ship, steps, words
from emporium.llm.components import components

COORDINATES = 64  # MinHash values of a set
SPLITS = 1.25  # coordinates a bucket is split on, in the mean (1 / threshold)
DENSE = 0.7  # a bucket with this share of its parent's sets is not split again
_U = np.uint64


def runs_needed(threshold: float, target_recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold has shared a bucket of ``depth`` with the target probability.

    Each split takes one coordinate and, a quarter of the time, a second one;
    the chance that no common path survives follows the branching process.
    """
    lost = 0.0
    for _ in range(depth):
        step = 1 - threshold + threshold * lost
        lost = step * (1 - (SPLITS - 1) + (SPLITS - 1) * step)
    return max(1, math.ceil(math.log(1 - target_recall) / math.log(lost)))


def shingle_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted shingles of each text; a text of fewer words is one shingle of them all."""
    h, first = words(texts)
    s, begin = shingles(h, first, size)
    n_words = np.diff(first)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    owner = np.repeat(np.arange(len(texts)), np.diff(begin))
    if len(short):
        whole = np.array([mix(np.array([np.bitwise_xor.reduce(mix(h[first[i] : first[i + 1]] + mix(np.arange(7, 7 + n_words[i], dtype=np.uint64))))], dtype=np.uint64))[0] for i in short], dtype=np.uint64)
        s, owner = np.concatenate([s, whole]), np.concatenate([owner, short])
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    if len(s):
        new = np.concatenate(([True], (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])))
        s, owner = s[new], owner[new]
    return s, np.searchsorted(owner, np.arange(len(texts) + 1))


def fingerprints(s: np.ndarray, begin: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each set; None for the empty one."""
    full = np.flatnonzero(np.diff(begin))
    out: list[bytes | None] = [None] * (len(begin) - 1)
    if len(full):
        at = begin[full]
        two = np.stack([mix(np.add.reduceat(mix(s + _U(k)), at) + np.diff(begin)[full].astype(np.uint64)) for k in (0x5BF0, 0xA3C1)], axis=1)
        for i, row in zip(full, np.ascontiguousarray(two.astype(">u8"))):
            out[i] = row.tobytes()
    return out


def minhash(s: np.ndarray, begin: np.ndarray, n: int = COORDINATES) -> np.ndarray:
    """``n`` 32-bit MinHash values of each non-empty set, one row for each."""
    at = begin[:-1][np.diff(begin) > 0]
    out = np.empty((len(at), n), dtype=np.uint32)
    rng = np.random.default_rng(8)
    mul = rng.integers(0, 2**63, n, dtype=np.uint64) * _U(2) + _U(1)
    add = rng.integers(0, 2**63, n, dtype=np.uint64)
    for k in range(n):
        out[:, k] = np.minimum.reduceat(((s * mul[k] + add[k]) >> _U(32)).astype(np.uint32), at) if len(at) else 0
    return out


def sketch(signature: np.ndarray) -> np.ndarray:
    """Eight bits of each MinHash value."""
    return (signature & 255).astype(np.uint8)


def _extend(path: np.ndarray, signature: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Children of each row's path: (row, path). Sets that share a path choose alike."""
    draw = mix(path + _U(seed))
    n = signature.shape[1]
    one = (draw % _U(n)).astype(np.int64)
    two = ((draw >> _U(16)) % _U(n)).astype(np.int64)
    more = np.flatnonzero(((draw >> _U(40)) % _U(1000) < _U(round((SPLITS - 1) * 1000))) & (one != two))
    row = np.concatenate([np.arange(len(path)), more])
    pick = np.concatenate([one, two[more]])
    value = signature[row, pick].astype(np.uint64)
    return row, mix(path[row] * _U(0x9E3779B97F4A7C15) + mix(value + (pick.astype(np.uint64) << _U(32))))


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint32).reshape(len(column), COORDINATES)


def _embed(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pdf in steps(batch):
                s, begin = shingle_sets(list(pdf["text"]), size)
                names = fingerprints(s, begin)
                sig = iter(minhash(s, begin))
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].to_numpy(),
                    "fp": names,
                    "n": np.diff(begin),
                    "sig": [None if x is None else next(sig).tobytes() for x in names],
                })

    return run


def _first_paths(runs: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            sig, fp = _signatures(pdf["sig"]), pdf["fp"].to_numpy()
            for r in range(runs):
                row, path = _extend(mix(np.full(len(pdf), r + 1, dtype=np.uint64)), sig, r)
                yield pd.DataFrame({"path": path.view(np.int64), "fp": fp[row]})

    return run


def _next_paths(level: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                row, path = _extend(pdf["path"].to_numpy().view(np.uint64), _signatures(pdf["sig"]), 1000 + level)
                parent = pdf["parent_size"].to_numpy()[row]
                yield pd.DataFrame({"path": path.view(np.int64), "parent_size": parent, "fp": pdf["fp"].to_numpy()[row]})

    return run


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least linked index of each of ``n`` rows."""
    root = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _near_pairs(packed: np.ndarray, begin: np.ndarray, floor: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs inside each bucket (rows ``begin[k]`` to ``begin[k + 1]``) that agree in ``floor`` places."""
    sizes = np.diff(begin)

    def agree(i, j):
        return (packed[i] == packed[j]).sum(axis=-1, dtype=np.int16)

    for n in np.unique(sizes[(sizes > 1) & (sizes <= 64)]):
        x, y = np.triu_indices(n, 1)
        first = begin[:-1][sizes == n]
        group = max(1, 100_000 // len(x))  # pairs compared at a time
        for k in range(0, len(first), group):
            i = (first[k : k + group, None] + x).ravel()
            j = (first[k : k + group, None] + y).ravel()
            near = agree(i, j) >= floor
            yield i[near], j[near]
    for k in np.flatnonzero(sizes > 64):
        for i in range(begin[k], begin[k + 1] - 1):
            j = np.flatnonzero(agree(i, slice(i + 1, begin[k + 1])) >= floor) + i + 1
            yield np.full(len(j), i), j


def _brute_force(keys: list[str], floor: int):
    """Star edges between a bucket's sets whose sketches agree in ``floor`` places; rows come sorted by bucket."""

    def edges(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy()
        packed = np.frombuffer(b"".join(pdf["sketch"]), dtype=np.uint8).reshape(len(pdf), -1)
        key = pdf[keys].to_numpy()
        begin = np.concatenate([np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))), [len(pdf)]])
        root = _roots(len(fp), _near_pairs(packed, begin, floor))
        hung = np.flatnonzero(root != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[hung], "b": fp[root[hung]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            if not len(pdf):
                continue
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            tail = (held[keys] == held[keys].iloc[-1]).all(axis=1).to_numpy()  # the last bucket may go on
            if not tail.all():
                yield edges(held[~tail])
                held = held[tail].reset_index(drop=True)
        if held is not None:
            yield edges(held)

    return run


def _links(threshold: float):
    """Exact links inside one block, or between two blocks, of a candidate family."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, left, right = key
        sets = [np.frombuffer(x, dtype=np.uint64) for x in pdf["hashes"]]
        sizes = np.array([len(x) for x in sets], dtype=np.int64)
        side, fp, copies = pdf["block"].to_numpy(), pdf["fp"].to_numpy(), pdf["copies"].to_numpy()
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        shared = np.bincount(ids, minlength=len(values)) > 1  # others are in no intersection
        place = np.cumsum(shared) - 1
        owner = np.repeat(np.arange(len(sets)), sizes)
        keep = shared[ids]
        column, owner = place[ids[keep]], owner[keep]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        one = np.flatnonzero(side == left)
        two = one if left == right else np.flatnonzero(side == right)
        common = np.zeros((len(one), len(two)), dtype=np.float32)
        row = np.full(len(sets), -1)
        row[one] = np.arange(len(one))
        col = np.full(len(sets), -1)
        col[two] = np.arange(len(two))
        n_shared = int(shared.sum())
        width = max(1, min(n_shared, max(64, 8_000_000 // max(1, len(sets)))))
        for start in range(0, n_shared, width):
            a, b = np.searchsorted(column, [start, start + width])
            x = np.zeros((len(one), width), dtype=np.float32)
            y = x if left == right else np.zeros((len(two), width), dtype=np.float32)
            o, c = owner[a:b], column[a:b] - start
            m = row[o] >= 0
            x[row[o[m]], c[m]] = 1
            if left != right:
                m = col[o] >= 0
                y[col[o[m]], c[m]] = 1
            common += x @ y.T
        close = common >= threshold * (sizes[one][:, None] + sizes[two][None, :] - common) - 1e-3
        if left == right:
            np.fill_diagonal(close, False)
        links = np.zeros(len(sets), dtype=np.int64)
        links[one] += close @ copies[two]
        if left != right:
            links[two] += copies[one] @ close
        root = _roots(len(sets), ((np.full(int(r.sum()), one[k]), two[r]) for k, r in enumerate(close)))
        return pd.DataFrame({"fp": fp, "links": links, "root": fp[root]})

    return run


def _hashes(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pdf in steps(batch):
                s, begin = shingle_sets(list(pdf["text"]), size)
                yield pd.DataFrame({"fp": fingerprints(s, begin), "hashes": [s[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])]})

    return run


def jaccard_join(
    docs: DataFrame,
    threshold: float = 0.8,
    shingle: int = 5,
    target_recall: float = 0.9999,
    bucket: int = 2048,
    max_depth: int = 8,
    block: int = 1024,
    block_shingles: int = 4_000_000,
    broadcast_ids: int = 1_000_000,
) -> DataFrame:
    """Similarity classes of ``docs(doc_id, text)``: ``(doc_id, class_id, n_links)``, one row for each row.

    ``n_links`` counts the other rows whose shingle sets have a Jaccard
    similarity of ``threshold`` or more; ``class_id`` is the least doc_id that
    can be reached over such links (exact copies have equal sets and count).
    Every link is counted from exact intersections; the chosen paths only
    decide which sets are compared, and sets in one candidate family are all
    compared with each other.

    1. Rows with equal sets are collapsed into one node (128-bit name).
    2. Every run assigns nodes to buckets along a path of shared MinHash
       values. Buckets over ``bucket`` nodes are split again; one that a split
       leaves nearly whole (near copies in thousands), or that is still larger
       after ``max_depth`` splits, is compared in pairs of blocks, so no task
       holds an unbounded group.
    3. A bucket links nodes whose sketches agree well below the threshold and
       yields a star of edges, never pairs. Their components are families.
    4. Each family's sets are read again from the texts and intersected
       exactly, a large family in pairs of blocks; links become counts and
       stars at once, and a last component search gives the classes.

    Null and empty texts (no word) are in no link: class_id is their own
    doc_id, n_links 0. A text of one to four words is one shingle. Rows with a
    null doc_id link like others; a class of such rows only has a null
    class_id. Repeated rows count as copies. Other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = cut(docs.select("doc_id", "text").mapInPandas(_embed(shingle), "doc_id long, fp binary, n long, sig binary"))
    full = rows.where("fp is not null")
    nodes = cut(full.groupBy("fp").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.max("n").alias("n"), F.max("sig").alias("sig")))

    edges = cut(_candidates(nodes, threshold, target_recall, bucket, max_depth, block))
    family = components(edges)
    members = cut(family.join(nodes.select("fp", "copies", "least", "n"), family["node"] == nodes["fp"]).select("fp", "root", "copies", "least", "n"))
    sized = members.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / block, F.sum("n") / block_shingles)).cast("int").alias("blocks")
    )
    members = members.join(sized, "root").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))

    wanted = members.select(F.col("least").alias("id")).distinct()
    known = members.select("fp", "root", "copies", "blocks", "block")
    if members.limit(broadcast_ids + 1).count() <= broadcast_ids:
        wanted, known = F.broadcast(wanted), F.broadcast(known)
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = texts.mapInPandas(_hashes(shingle), "fp binary, hashes binary")
    held = sets.join(known, "fp")
    paired = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "fp", "block", "copies", "hashes"
    ).dropDuplicates(["root", "left", "right", "fp"])
    found = cut(paired.groupBy("root", "left", "right").applyInPandas(_links(threshold), "fp binary, links long, root binary"))

    classes = components(found.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("fp").agg(F.sum("links").alias("links"))
    # Only nodes that were compared have a class of more than one node.
    linked = cut(
        counted.join(classes.select(F.col("node").alias("fp"), F.col("root").alias("class")), "fp", "left")
        .join(members.select("fp", "copies", "least"), "fp")
        .select("fp", "least", F.coalesce("class", "fp").alias("class"), (F.col("copies") - 1 + F.col("links")).alias("links"))
    )
    named = linked.groupBy("class").agg(F.min("least").alias("class_id"))
    compared = linked.join(named, "class").select("fp", "class_id", "links", F.lit(True).alias("compared"))
    final = nodes.select("fp", "copies", "least").join(compared, "fp", "left").select(
        "fp",
        F.when(F.col("compared"), F.col("class_id")).otherwise(F.col("least")).alias("class_id"),
        F.when(F.col("compared"), F.col("links")).otherwise(F.col("copies") - 1).alias("links"),
    )
    return rows.select("doc_id", "fp").join(final, "fp", "left").select(
        "doc_id",
        F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
    )


def _candidates(nodes: DataFrame, threshold: float, target_recall: float, bucket: int, max_depth: int, block: int) -> DataFrame:
    """Star edges ``(a, b)`` between nodes that met in a bucket and whose sketches are near."""
    # The share of equal bytes of a pair at the threshold, less 4.5 standard deviations.
    equal = threshold + (1 - threshold) / 256
    floor = int(COORDINATES * equal - 4.5 * math.sqrt(COORDINATES * equal * (1 - equal)))
    runs = runs_needed(threshold, target_recall, min(4, max_depth))
    pack = F.pandas_udf(lambda s: pd.Series([x.tobytes() for x in sketch(_signatures(s))]), "binary")
    sketches = nodes.select("fp", pack("sig").alias("sketch"))
    paths = nodes.select("fp", "sig").mapInPandas(_first_paths(runs), "path long, fp binary")
    paths = paths.withColumn("parent_size", F.lit(2**62))
    edges = None
    for depth in range(1, max_depth + 1):
        # Counted and joined over one shuffle. A run's buckets are its own, so no
        # bucket has more than a run's share of the rows.
        dealt = paths.repartition("path")
        sizes = dealt.groupBy("path").agg(F.count("*").alias("size"), F.max("parent_size").alias("parent_size")).where("size > 1")
        # A bucket that the last split left nearly whole is dense: splitting again would only copy it.
        whole = F.lit(depth == max_depth) | (F.col("size") >= DENSE * F.col("parent_size"))
        sizes = sizes.select("path", "size", ((F.col("size") > bucket) & ~whole).alias("again"))
        met = cut(dealt.select("path", "fp").join(sizes, "path"))
        blocks = F.when(F.col("size") <= bucket, 1).otherwise(F.ceil(F.col("size") / block)).cast("int")
        sided = met.where("not again").withColumn("own", F.pmod(F.xxhash64("fp"), blocks).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), blocks - 1))
        )
        keys = ["path", "left", "right"]
        groups = sided.select("path", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "fp").join(sketches, "fp")
        sorted_groups = groups.repartition(*keys).sortWithinPartitions(*keys)
        new = sorted_groups.mapInPandas(_brute_force(keys, floor), "a binary, b binary").distinct()
        edges = new if edges is None else edges.unionByName(new)
        large = met.where("again").select("path", F.col("size").alias("parent_size"), "fp")
        if depth == max_depth or large.isEmpty():
            break
        paths = large.join(nodes.select("fp", "sig"), "fp").mapInPandas(_next_paths(depth), "path long, parent_size long, fp binary")
    return edges
