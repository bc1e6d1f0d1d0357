import hashlib
import random
import string
import zlib

import pytest
from pyspark.sql import functions as F

from emporium.llm.manifest import Block, manifest, node_versions


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree_of(nodes, width):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H(low[i : i + width]) for i in range(0, len(low), width)])
    return levels


def way(levels, place, width):
    out = []
    for low in levels[:-1]:
        first = place // width * width
        out.append((low[first:place], low[place + 1 : first + width]))
        place //= width
    return out


def brute_force(rows, width=8):
    """rows: (doc_id, source, lang, n_chars, text) -> the contract's columns, whole trees in memory."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    of = {}
    for lang in langs:
        mine = [(r, leaf_of(r)) for r in rows if r[2] == lang]
        of[lang] = sorted(mine, key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {lang: tree_of([h for _, h in of[lang]], width) for lang in langs}
    top = tree_of([trees[lang][-1][0] for lang in langs], width)
    out = []
    for k, lang in enumerate(langs):
        for place, (r, h) in enumerate(of[lang]):
            path = way(trees[lang], place, width) + way(top, k, width)
            node = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = None if r[4] is None else r[4].translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
                node = leaf_of((*r[:4], text))
            for left, right in path:
                node = H([*left, node, *right])
            proof = H(x for left, right in path for x in (*left, *right))
            out.append((r[0], h, trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def query(docs, **kwargs):
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return manifest(docs, {"text": lowered}, where, **kwargs)


def same(spark, rows, width=8, height=3):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumn("place", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("tree", F.lit(None).cast("string"))
    got = query(docs, width=width, height=height).select(*COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_force(rows, width)))
    return docs


def rows_of(n, langs, seed=1):
    rnd = random.Random(seed)
    texts = ["Ab", "", None, "lower", "ÄÖ Z", "x:1-", "L" * 5000]
    return [(i * 3 if i % 41 else None, rnd.choice(["s", None, ""]), rnd.choice(langs), rnd.choice([None, i]), rnd.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (9, ["en"]), (600, ["en", "en", "en", None, "=", "-", ""]), (700, [f"l{i}" for i in range(30)])])
def test_brute_force(spark, n, langs):
    same(spark, rows_of(n, langs))


@pytest.mark.parametrize("n", [63, 64, 65, 511, 513])
def test_blocks_of_a_few_nodes(spark, n):
    # small blocks, so that versions go on over several rows of nodes
    same(spark, [(i, "s", "en", i, "Text" * (i % 5)) for i in range(n)], width=2, height=2)


def test_ties_repeated_rows_and_big_ids(spark):
    rows = [(2**60 + 1, "s", "en", 1, "A"), (2**60 + 1, "s", "en", 1, "A"), (2**60 + 1, "t", "en", 1, "B"), (None, "s", "en", 1, "C"), (2**60, None, None, None, None)]
    same(spark, rows)


def test_a_version_shares_all_but_its_ancestors(spark):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(100)]
    versions = query(same(spark, rows), height=1)
    tampered = [r for r in versions.collect() if r.version_leaf]
    nodes = node_versions(versions).collect()
    # a leaf, three nodes of its tree up to the subroot, which is the root as well
    assert len(nodes) == 4 * len(tampered) and {r.level for r in nodes} == {0, 1, 2, 3}
    for r in tampered:
        own = {x.level: x for x in nodes if x.doc_id == r.doc_id}
        assert [own[k]["index"] for k in range(4)] == [r.place, r.place // 8, r.place // 64, 0]
        assert own[3].digest == r.folded_root != r.root and not r.verified


def test_unchanged_text_and_empty_tables(spark):
    rows = [(i, "s", "en", i, "no capitals") for i in range(30)]
    docs = same(spark, rows)
    assert query(docs).where("not verified").count() == 0
    assert query(docs.limit(0)).count() == 0


def test_an_only_block_ends_at_one_node():
    assert len(Block.over(["a"], 0, 8, 3).levels) == 1
    assert len(Block.over(["a"], 1, 8, 3).levels) == 4
    assert len(Block.over(["a"] * 512, 0, 8, 3).levels) == 4
