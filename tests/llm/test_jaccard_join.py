import itertools
import random

import pytest

from emporium.llm.components import components
from emporium.llm.jaccard_join import jaccard_join, runs_needed, shingle_sets

SCHEMA = "doc_id long, text string, class_id string, n_links string"


def corpus(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []

    def add(ws):
        rows.append((len(rows), " ".join(ws)))

    passage = [rnd.choice(vocabulary) for _ in range(40)]
    for _ in range(6):  # families of near copies, from light to heavy edits
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(60, 200))]
        for edits in (0, 0, 1, 1, 2, 3, 4, 6, 9):
            copy = list(base)
            for _ in range(edits):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            add(copy)
    for _ in range(40):  # texts that share a passage only
        add([rnd.choice(vocabulary) for _ in range(60)] + passage)
    rows += [(900, "one two"), (901, "one two"), (902, "One, two!"), (903, "two one"), (904, ""), (905, ""), (906, None), (907, None)]
    rows += [(908, rows[0][1]), (908, rows[0][1]), (None, rows[0][1]), (None, "alone and without a name or a number"), (909, "," * 50)]
    return rows


def brute_force(rows, threshold=0.8):
    s, begin = shingle_sets([t or "" for _, t in rows], 5)
    sets = [set(s[a:b].tolist()) for a, b in zip(begin, begin[1:])]
    links = [0] * len(rows)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, least.get(find(i)), links[i]) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("options", [{}, {"bucket": 4, "block": 3, "max_depth": 3, "broadcast_ids": 0}, {"block": 5, "block_shingles": 500}])
def test_links_and_classes_are_brute_force(spark, options):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in jaccard_join(docs, **options).collect()), key=repr)
    assert got == brute_force(rows)


def test_empty_table(spark):
    out = jaccard_join(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["doc_id", "class_id", "n_links"] and out.count() == 0


def test_more_runs_for_more_recall():
    assert runs_needed(0.8, 0.9999, 4) > runs_needed(0.8, 0.99, 4) > runs_needed(0.95, 0.99, 4)


def test_components_of_paths_and_stars(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 7), (301, 300)]
    rnd.shuffle(edges)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
