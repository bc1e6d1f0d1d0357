import hashlib
import random
import re
from fractions import Fraction

import pytest

from emporium.llm.mixing import mixture, n_words, taken, targets


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Share, cap and share again what is over, in exact fractions."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: Fraction(0) for s in names}
    left, open_ = Fraction(sum(sizes.values())), set(names)
    while left and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = Fraction(0)
        for s in [s for s in open_ if target[s] > most * sizes[s]]:
            left += target[s] - most * sizes[s]
            target[s] = Fraction(most * sizes[s])
            open_.remove(s)
    return target, weight


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_brute_force(spark, seed):
    rnd = random.Random(seed)
    names = [None, "", "Z", "a", "ä", "源", "😀", "b c"] + [f"s{i}" for i in range(20)]
    sizes = {s: rnd.choice([0, 1, 10, rnd.randint(1, 10**6), 10**13]) for s in rnd.sample(names, rnd.randint(1, len(names)))}
    rows = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    expected, weight = brute_targets(sizes)
    assert {r.source: r.weight for r in rows} == weight
    for r in rows:
        assert r.target == pytest.approx(float(expected[r.source]), rel=1e-12)
        assert 0 <= r.rate <= 3 and (r.source_size or not r.rate)


def docs_of(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        source = rnd.choice(["hot"] * 5 + ["a", "b", "c", None])
        rows.append((i if i % 50 else None, " ".join(["w"] * (rnd.randint(1, 40) if i % 97 else 300)), source, i))
    rows += [(9000, None, "a", 1), (9001, "", "a", 1), (9002, " \t\n", "b", 1), (9003, None, "empty", 1)]
    rows += rows[:3]  # repeated rows
    return spark.createDataFrame(rows, "doc_id long, text string, source string, rate int"), rows


def test_rows_copies_and_sums(spark):
    docs, rows = docs_of(spark)
    got = taken(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target, _ = brute_targets(sizes)
    sums = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.taken == r.size * r.copies and r.taken <= 3 * r.size
        assert r.copies in (int(r.rate), int(r.rate) + 1) and (r.copies == r.rate or r.rate != int(r.rate))
        sums[r.source] = sums.get(r.source, 0) + r.taken
    assert sum(r.size for r in got) == sum(sizes.values())
    for s, t in target.items():
        assert sums[s] == pytest.approx(float(t), rel=0.03)
    assert sorted(map(repr, taken(docs.repartition(5)).collect())) == sorted(map(repr, got))


def test_each_copy_is_the_stated_draw(spark):
    docs, rows = docs_of(spark)
    got = {(r.doc_id, r.source, r.size): r for r in taken(docs, turns=1).collect() if r.doc_id is not None}
    for i, t, s, _ in rows:
        if i is None:
            continue
        h = hashlib.md5((t or "").encode()).hexdigest()
        drawn = int(hashlib.md5(f"mix|{i}|{s if s is not None else '-'}|{h}".encode()).hexdigest()[:13], 16) / 2**52
        r = got[i, s, len((t or "").split())]
        assert r.copies == int(r.rate) + (drawn < r.rate - int(r.rate))


def test_mixture_holds_each_row_as_often(spark):
    docs, _ = docs_of(spark)
    want = {}
    for r in taken(docs).collect():
        want[r.doc_id, r.source, r.size] = r.copies
    out = mixture(docs)
    assert out.columns == [*docs.columns, "copy"]
    got = {}
    for r in out.withColumn("size", n_words(out["text"])).collect():
        got.setdefault((r.doc_id, r.source, r.size), []).append(r.copy)
    for key, n in want.items():
        if key[0] is not None and key[0] > 2:  # the first rows are repeated
            assert sorted(got.get(key, [])) == list(range(1, n + 1))
    with pytest.raises(ValueError):
        mixture(docs.withColumnRenamed("rate", "copy"))


def test_words_and_empty_tables(spark):
    texts = ["", " ", "a", " a ", "a\x0bb", "\n\na\r\nb ", " ", "w w", "x" * 100_000, "y " * 100_000, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(n_words(df["text"])).collect()] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    docs, _ = docs_of(spark)
    assert taken(docs.limit(0)).count() == 0 and mixture(docs.limit(0)).count() == 0
    nothing = taken(docs.where("text is null")).collect()
    assert {(r.size, r.target, r.taken) for r in nothing} == {(0, 0.0, 0)}
