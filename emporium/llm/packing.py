"""Best-fit packing of tokenised documents with a swap-based local search."""

from __future__ import annotations

import heapq
import itertools
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import ship, steps

END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class _Store:
    """Strings and the ids each stands for, in one growing array."""

    def __init__(self):
        self.row: dict = {}
        self.start, self.length = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)
        self.ids, self.used = np.zeros(1 << 14, dtype=np.uint32), 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), dtype=a.dtype)])

    def add(self, names: list, flat: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.row), len(names)
        self.start, self.length = self._room(self.start, n + m), self._room(self.length, n + m)
        self.ids = self._room(self.ids, self.used + len(flat))
        self.start[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.length[n : n + m] = sizes
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.row.update(zip(names, range(n, n + m)))

    def flat(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows in a row, and where each one's end."""
        length = self.length[rows]
        end = np.cumsum(length)
        return self.ids[np.repeat(self.start[rows] - end + length, length) + np.arange(end[-1] if len(end) else 0)], end


class Encoder:
    """Ids of whole texts; blank-delimited chunks are encoded once and kept.

    The tokenizer never joins characters across a blank or line feed, so a
    text's ids are its chunks' ids in a row. A chunk of plain letters and
    punctuation is put together from its lower-case word and its marks, which
    are encoded apart; any other chunk is encoded as it is. ``keep`` bounds the
    strings that are kept, hence memory only: what is dropped is encoded again.
    """

    #: A small table of the most frequent chunks stays in the processor's cache.
    OFTEN = 30_000
    #: Letters that are one code point in any normal form and lower-case to one, then ASCII marks but the apostrophe.
    SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, path: str, keep: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.keep = keep
        self._clear()

    def _clear(self) -> None:
        self.store, self.often = _Store(), {}
        self.store.add(["", None], np.array([END_ID], dtype=np.uint32), np.array([0, 1]))  # None: the end of a text

    def _learn(self, words: set[str], others: set[str]) -> None:
        """Encode strings that are not known yet; ``words`` are letters alone."""
        plain = list(words.difference(self.store.row))
        if plain:  # one word each: all in one text, told apart by the ids that end a word
            flat = np.array(self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            end = np.flatnonzero(self.ends_word[flat]) + 1
            self.store.add(plain, flat, np.diff(end, prepend=0))
        other = list(others.difference(self.store.row))
        if other:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
            sizes = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
            self.store.add(other, np.fromiter(itertools.chain.from_iterable(got), dtype=np.uint32, count=int(sizes.sum())), sizes)

    def _add(self, chunks: list[str]) -> None:
        simple, words, whole, joined, pairs = self.SIMPLE.fullmatch, set(), set(), [], []
        for chunk in chunks:
            found = simple(chunk)
            if found is None or "<|" in chunk:
                whole.add(chunk)
                continue
            word, marks = found.groups()
            low = word.lower()
            words.add(low)
            if low != chunk:
                joined.append(chunk)
                pairs += (low, marks)
        self._learn(words, whole.union(pairs[1::2]))
        rows = np.fromiter(map(self.store.row.__getitem__, pairs), dtype=np.int64, count=len(pairs))
        flat, end = self.store.flat(rows)
        self.store.add(joined, flat, np.diff(end[1::2], prepend=0))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text's followed by the end id, and where each text begins."""
        if len(self.store.row) > self.keep:
            self._clear()
        parts = []
        for t in texts:
            parts.append(t.replace("\n", " ").split(" "))
            parts[-1].append(None)
        chunks = list(itertools.chain.from_iterable(parts))
        known = self.store.row
        rows = np.fromiter(map(self.often.get, chunks, itertools.repeat(-1)), dtype=np.int64, count=len(chunks))
        seldom = np.flatnonzero(rows < 0)
        rows[seldom] = np.fromiter(map(known.get, map(chunks.__getitem__, seldom.tolist()), itertools.repeat(-1)), dtype=np.int64, count=len(seldom))
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            names = list(map(chunks.__getitem__, missing.tolist()))
            self._add(list(dict.fromkeys(names)))
            rows[missing] = list(map(known.__getitem__, names))
        if not self.often:
            row, at, times = np.unique(rows, return_index=True, return_counts=True)
            top = np.argsort(-times, kind="stable")[: self.OFTEN]
            self.often = {chunks[i]: int(r) for i, r in zip(at[top].tolist(), row[top].tolist())}
        flat, end = self.store.flat(rows)
        last = np.cumsum([len(p) for p in parts]) - 1
        return flat, np.concatenate([[0], end[last]]) if len(parts) else np.zeros(1, dtype=np.int64)


_ENCODERS: dict[str, Encoder] = {}


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        salt = 0
        for batch in batches:
            for pdf in steps(batch):
                flat, begin = _ENCODERS[path].encode(list(pdf["text"]))
                count = -(-np.diff(begin) // capacity)
                row = np.repeat(np.arange(len(pdf)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(np.diff(begin)[row] - start, capacity)
                flat = flat.astype("<u4", copy=False)
                at = begin[row] + start
                crc = [zlib.crc32(flat[a : a + n]) for a, n in zip(at, length)]
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].astype("Int64").to_numpy()[row], "piece": piece.astype(np.int32), "start": start,
                    "length": length, "ids_crc32": np.array(crc, dtype=np.int64), "salt": salt + np.arange(len(row)),
                })
                salt += len(row)

    return run


def pack_lengths(lengths: np.ndarray, capacity: int, effort: int = 2_000_000) -> np.ndarray:
    """The bin of each item, 0, 1, ...; every length is 1 to ``capacity``.

    Best fit in decreasing order, then local search: the items of the emptiest
    bin are moved into other underfull bins, or exchanged one for one, one for
    two or two for one, whenever that increases the sum of squared fills, until
    the bin is empty. It ends when the bins' number is the least possible
    (total over capacity), when no exchange helps, or when ``effort`` bins have
    been looked at.
    """
    bins = np.full(len(lengths), -1, dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, n = 0, 0
    room: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = by_room[left].pop()
            if not by_room[left]:
                mask &= ~(1 << left)
        else:
            left, b = capacity, n
            n += 1
            room.append(capacity)
        bins[i] = b
        left -= size
        room[b] = left
        if left:
            by_room[left].append(b)
            mask |= 1 << left
    least = -(-int(lengths.sum()) // capacity) if len(lengths) else 0
    if n > least:
        _local_search(lengths, bins, room, least, capacity, effort)
    _, dense = np.unique(bins, return_inverse=True)
    return dense


def _local_search(lengths, bins, room, least, capacity, effort) -> None:
    n = len(room)
    underfull = [b for b in range(n) if room[b] > 0]
    items: dict[int, list[tuple[int, int]]] = {b: [] for b in underfull}
    members = np.flatnonzero(np.isin(bins, underfull))
    under, wide = np.array(underfull, dtype=np.int64), 4 * capacity
    for i in members:
        insort(items[int(bins[i])], (int(lengths[i]), int(i)))
    live, left = n, effort
    heap = [(capacity - room[b], b) for b in underfull]
    heapq.heapify(heap)

    def put(i: int, size: int, source: int, target: int) -> None:
        items[source].remove((size, i))
        insort(items[target], (size, i))
        room[source] += size
        room[target] -= size
        bins[i] = target

    def exchange(b: int, size: int, i: int, t: int) -> tuple:
        """The best exchange of item ``i`` of ``b`` with bin ``t``: (t, items that go, items that come)."""
        r, own = room[t], items[t]
        if r >= size:
            return t, [(i, size)], []
        k = bisect_left(own, (size - r, -1))  # one for one: the least that leaves enough room
        gain, what = (size - own[k][0], (t, [(i, size)], [own[k]])) if k < len(own) and own[k][0] < size else (0, None)
        if gain < r:
            for two in _two(own, size - r, size):  # one for two
                if size - two[0][0] - two[1][0] > gain:
                    gain, what = size - two[0][0] - two[1][0], (t, [(i, size)], two)
        if gain < r:
            for size2, i2 in items[b]:  # two for one
                if i2 == i:
                    continue
                k = bisect_left(own, (size + size2 - r, -1))
                if k < len(own) and gain < size + size2 - own[k][0]:
                    gain, what = size + size2 - own[k][0], (t, [(i, size), (i2, size2)], [own[k]])
        return what

    def lighten(b: int) -> bool:
        """One exchange that moves fill from ``b`` to a bin at least as full afterwards."""
        nonlocal left
        # All targets' items in a row, by target and size: what every target could gain is found at once.
        which = np.searchsorted(under, bins[members])
        order = np.lexsort((members, lengths[members], which))
        which, own = which[order], lengths[members][order]
        key, ends = which * wide + own, np.searchsorted(which, np.arange(1, len(under) + 1))
        rooms = np.fromiter((room[t] for t in underfull), dtype=np.int64, count=len(underfull))
        target = np.flatnonzero((rooms > 0) & (np.diff(ends, prepend=0) > 0) & (under != b))
        r = rooms[target]
        if not len(target):
            return False
        mine = np.flatnonzero(np.isin(which, target))
        owner, end = which[mine], ends[which[mine]]

        def closest(low: np.ndarray) -> np.ndarray:
            """Of each target the least item of ``low`` or more."""
            at = np.searchsorted(key, target * wide + np.maximum(low, 0))
            return np.where(at < ends[target], own[np.minimum(at, len(own) - 1)], wide)

        for size, i in reversed(items[b]):
            if left <= 0:
                return False
            left -= len(underfull)
            least_one = closest(size - r)
            gain = np.zeros(len(under), dtype=np.int64)
            partner = np.maximum(mine + 1, np.searchsorted(key, owner * wide + np.maximum(size - rooms[owner] - own[mine], 0)))
            two = own[mine] + np.where(partner < end, own[np.minimum(partner, len(own) - 1)], wide)
            np.maximum.at(gain, owner, size - two)
            gain = np.maximum(gain[target], np.maximum(size - least_one, 0))
            for size2, i2 in items[b]:
                if i2 != i:
                    gain = np.maximum(gain, size + size2 - closest(size + size2 - r))
            gain = np.where(r >= size, size, gain)
            good = np.flatnonzero((gain > 0) & (gain > r - room[b]))
            if len(good):
                best = good[np.lexsort((target[good], r[good], -gain[good]))[0]]
                to, out, back = exchange(b, size, i, int(under[target[best]]))
                for i, s in out:
                    put(i, s, b, to)
                for s, i in back:
                    put(i, s, to, b)
                return True
        return False

    while live > least and heap and left > 0:
        fill, b = heapq.heappop(heap)
        if not items[b] or fill != capacity - room[b]:
            continue
        while items[b] and lighten(b):
            pass
        if not items[b]:
            live -= 1
            heap = [(capacity - room[t], t) for t in underfull if items[t] and room[t]]
            heapq.heapify(heap)


def _two(own: list[tuple[int, int]], low: int, high: int) -> Iterator[list[tuple[int, int]]]:
    """For each item, the least partner with which it has ``low`` or more and under ``high`` together."""
    for k, (size, i) in enumerate(own):
        j = max(k + 1, bisect_left(own, (low - size, -1)))
        if j < len(own) and low <= size + own[j][0] < high:
            yield [(size, i), own[j]]


def _pack(capacity: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "salt"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        length = pdf["length"].to_numpy(dtype=np.int64)
        which = pack_lengths(length, capacity)
        order = np.argsort(which, kind="stable")
        sizes, group = length[order], which[order]
        before = np.cumsum(sizes) - sizes
        first = np.searchsorted(group, np.arange(group.max() + 1 if len(group) else 0))
        offset = np.empty(len(pdf), dtype=np.int64)
        offset[order] = before - before[first][group]
        return pdf.drop(columns=["salt", "shard"]).assign(sequence_id=which + (int(key[0]) << 32), offset=offset)

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096) -> DataFrame:
    """``docs(doc_id, text)`` as pieces of at most ``capacity`` ids, each text ended by id 1; see :func:`pack`."""
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(_pieces(tokenizer_path, capacity), PIECES)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, shard_docs: int = 65_536) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``. Only texts longer than a sequence are cut, into full
    pieces and a rest. Pieces are dealt evenly, by a salted hash, to shards of
    about ``shard_docs`` documents, whose number grows with the table; each is
    packed by itself (see :func:`pack_lengths`), which costs at most the last
    bin of each shard. The shuffle carries lengths, never texts or ids.

    A null or empty text is the end id alone. Repeated rows are packed again,
    null ids are carried through, an empty table gives no rows, and other
    columns are ignored. Lengths are counted in whole texts of any size.
    """
    shards = max(1, -(-docs.count() // shard_docs))
    pieces = token_pieces(docs, tokenizer_path, capacity)
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "salt", "ids_crc32"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(_pack(capacity), PACKED)
