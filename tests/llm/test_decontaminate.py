import random
import re

import pytest

from emporium.llm.decontaminate import contamination


def brute_force(docs, items, threshold):
    def shingle(t):
        w = re.findall(r"\w+", (t or "").lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = [(i, shingle(t)) for i, t in items]
    out = []
    for d, t in docs:
        own = shingle(t)
        for i, s in sets:
            if s and len(s & own) >= threshold * len(s) - 1e-9:
                out.append((d, i, len(s), len(s & own)))
    return sorted(out, key=repr)


def fixture():
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 6, 9, 20, 59, 130])))) for i in range(60)]
    items += [(60, items[5][1]), (61, ""), (62, None), (63, "too few words"), (None, "an item that has no number of its own here")]
    docs = []
    for d in range(120):
        w = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 4, 30, 400]))]
        if d % 2:
            part = (rnd.choice(items)[1] or "").split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                if part:
                    part[rnd.randrange(len(part))] = "changed"
            at = rnd.randrange(len(w) + 1)
            w[at:at] = part
        docs.append((d, " ".join(w).upper() if d % 3 else ", ".join(w)))
    return docs + [(7, None), (7, docs[1][1]), (None, docs[1][1])], items


@pytest.mark.parametrize("block_words", [2_000_000, 400])
def test_matches_are_brute_force(spark, block_words):
    docs, items = fixture()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, containment string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(d, i, block_words=block_words).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got), key=repr) == brute_force(docs, items, 0.8)
    assert all(r.containment == r.n_shared / r.n_item for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contamination(docs, items.limit(0)).count() == 0
    assert contamination(docs.limit(0), items).count() == 0
    assert contamination(docs, items).count() == 1
