import math
import random
import zlib

import numpy as np
import pytest

from emporium.llm.byte_grams import Grams, _sums, collect_grams, count_grams, keys_of, levels
from emporium.llm.language_id import code_lengths, identify
from emporium.llm.toxicity import log_ratios, score

SCHEMA = "doc_id long, text string, lang string, score string"


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def syllables(rnd, parts, n, extra=(), rate=0.0):
    return " ".join(rnd.choice(extra) if rnd.random() < rate else "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def counts_of(labelled, order):
    """n-gram counts by label and the contexts' lengths, counted one byte at a time."""
    out = {}
    for label, text in labelled:
        data = b"\n" * (order - 1) + text.lower().encode()
        for i in range(order - 1, len(data)):
            for k in range(1, order + 1):
                gram = data[i - k + 1 : i + 1]
                out[label, gram] = out.get((label, gram), 0) + 1
    return out


def tree_of(spark, labelled, order):
    counted = count_grams(spark.createDataFrame(labelled, "label string, text string").repartition(3), order)
    labels, keys, counts = collect_grams(counted, 1_000_000)
    return labels, levels(keys, counts, order)


LABELLED = [("a", "the cat sat on the mat"), ("b", "le chat est là"), ("a", "Then the dog"), ("b", "la tête é"), ("a", "")]
PROBES = ["the hat", "là-bas", "zzz", "Chat", "é", "t"]


def test_code_lengths_are_those_of_a_byte_at_a_time(spark):
    order = 4
    labels, tree = tree_of(spark, LABELLED, order)
    counts = counts_of(LABELLED, order)
    kinds = {}
    for (label, gram), c in counts.items():
        kinds.setdefault((label, gram[:-1]), []).append(c)

    def bits(label, text):
        data, total = b"\n" * (order - 1) + text.lower().encode(), 0.0
        for i in range(order - 1, len(data)):
            for k in range(order, -1, -1):
                if k == 0:
                    total += 8
                    break
                gram = data[i - k + 1 : i + 1]
                own = kinds.get((label, gram[:-1]))
                if own is None:
                    continue
                n, t = sum(own), len(own)
                if (label, gram) in counts:
                    total += math.log2((n + t) / counts[label, gram])
                    break
                total += math.log2((n + t) / t)
        return total

    lookup = code_lengths(tree)
    for text in PROBES:
        key, _ = keys_of([text], order)
        got = lookup.rows(key).sum(axis=0)
        assert got == pytest.approx([bits(x, text) for x in labels], rel=1e-5)


def test_kneser_ney_probabilities_sum_to_one(spark):
    order, discount = 3, 0.75
    _, tree = tree_of(spark, LABELLED, order)
    counts = counts_of(LABELLED, order)
    grams = {g for _, g in counts}

    def shared(gram):
        if not gram:
            return 1 / 256
        if len(gram) == order:
            weight = lambda g: 1.0
        else:
            weight = lambda g: float(sum(h[1:] == g for h in grams if len(h) == len(g) + 1))
        same = [g for g in grams if len(g) == len(gram) and g[:-1] == gram[:-1]]
        if not same:
            return shared(gram[1:])
        total = sum(map(weight, same))
        mine = weight(gram) if gram in grams else 0.0
        return (max(mine - discount, 0) + discount * len(same) * shared(gram[1:])) / total

    def own(label, gram):
        if not gram:
            return 1 / 256
        same = [g for x, g in counts if x == label and len(g) == len(gram) and g[:-1] == gram[:-1]]
        if not same:
            return own(label, gram[1:])
        n = sum(counts[label, g] for g in same)
        low = shared(gram[1:]) if len(gram) <= 2 else own(label, gram[1:])
        return max(counts.get((label, gram), 0) - discount, 0) / n + discount * len(same) / n * low

    assert sum(own("a", b"th" + bytes([c])) for c in range(256)) == pytest.approx(1)
    lookup = log_ratios(tree, discount)
    for text in ("the ", "cha", "mat"):
        key, _ = keys_of([text], order)
        data = b"\n" * (order - 1) + text.encode()
        expected = [math.log(own("b", data[i : i + order]) / own("a", data[i : i + order])) for i in range(len(text))]
        known = [data[i : i + order] in grams for i in range(len(text))]
        got = lookup.rows(key)[:, 0]
        assert got[known] == pytest.approx(np.array(expected)[known], rel=1e-4, abs=1e-4)


def test_languages_are_told_apart(spark):
    rnd = random.Random(1)
    parts = {"xx": ["ka", "lo", "mi"], "yy": ["ter", "sch", "lo"], "zz": ["ña", "ció", "mi"]}
    rows = [(i, syllables(rnd, parts[x], rnd.randint(3, 60)), x, "s") for i, x in enumerate(["xx", "yy", "zz"] * 60)]
    odd = [(900, None, "xx", ""), (901, "", "yy", ""), (902, "12 345 !?", "yy", ""), (None, rows[0][1], "yy", ""), (903, rows[1][1], None, ""), (903, rows[1][1], None, ""), (904, "ka" * 50_000, None, None)]
    got = identify(spark.createDataFrame(rows + odd, SCHEMA).repartition(4)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows + odd)
    assert all(by[i].held_out == held(i) for i, *_ in rows)
    tested = [(by[i].lang_pred, x) for i, _, x, _ in rows if held(i)]
    assert len(tested) > 20 and np.mean([a == b for a, b in tested]) > 0.95
    assert {by[i].lang_pred for i in (900, 901, 902)} == {"und"} and by[None].lang_pred == "xx" and not by[None].held_out
    assert by[904].lang_pred == "xx" and all(0 <= r.score <= 1 for r in got)


def test_a_held_out_label_is_never_learned(spark):
    rnd = random.Random(2)
    rows = [(i, syllables(rnd, ["ka", "lo"], 30), "never" if held(i) else "xx", "") for i in range(60)]
    got = identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.lang_pred for r in got} == {"xx"}
    none = identify(spark.createDataFrame(rows, SCHEMA).where("lang = 'never'")).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert identify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_toxic_documents_are_told_apart(spark):
    rnd = random.Random(3)
    bad = ["grumblewort", "snarkfiend", "blightling"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        rows.append((i, syllables(rnd, ["an", "the", "ing", "er", "on"], rnd.randint(20, 200), bad, 0.03 if toxic else 0.0), "en", ""))
        if toxic and not any(b in rows[-1][1] for b in bad):
            rows[-1] = (i, rows[-1][1] + " " + bad[0], "en", "")
        if i % 3 or held(i):
            labels.append((i, int(toxic), 1 if toxic else 0))
    labels += [(5, 1, 1), (None, 1, 1), (7, 1, None)]
    odd = [(2000, None, "en", ""), (2001, "", "en", ""), (None, rows[0][1], None, ""), (2002, "an the " * 20_000, "en", ""), (2002, "an the " * 20_000, "en", "")]
    docs = spark.createDataFrame(rows + odd, SCHEMA).repartition(4)
    got = score(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows + odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    tested = [(by[i].predicted, int(i % 5 == 0)) for i in range(900) if held(i)]
    assert np.mean([a == b for a, b in tested]) > 0.95
    assert by[2000].score == by[2001].score and by[2002].predicted == 0
    unlabelled = score(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert unlabelled.select("score").distinct().count() == 1
    assert score(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


@pytest.mark.parametrize("lookup_of", [code_lengths, log_ratios])
def test_shards_add_up_to_the_whole_model(spark, lookup_of):
    rnd = random.Random(5)
    labelled = [(x, syllables(rnd, ["ka", "lo", "é😀", "ter "], 40)) for x in "ab" * 8]
    counted = count_grams(spark.createDataFrame(labelled, "label string, text string").repartition(3), 5)
    whole, dealt = Grams(counted, 5, 10**6), Grams(counted, 5, 150)
    assert whole.shards == 1 and dealt.shards >= 4
    assert sum(len(dealt.collect(k)[0]) for k in range(dealt.shards)) == len(whole.collect(0)[0])
    texts = [t for _, t in labelled[:4]] + ["", "zzz", "kalo terx\n", "é"]
    want, n = _sums(lookup_of(whole.tree(0)), texts, 5, 0, 1)
    got = sum(_sums(lookup_of(dealt.tree(k)), texts, 5, k, dealt.shards)[0] for k in range(dealt.shards))
    assert got == pytest.approx(want, rel=1e-4, abs=1e-3)
    with pytest.raises(ValueError):
        collect_grams(counted, 150)


def test_sharded_results_are_those_of_one_shard(spark):
    rnd = random.Random(6)
    parts = {"xx": ["ka", "lo", "mi"], "yy": ["ter", "sch", "lo"]}
    rows = [(i, syllables(rnd, parts[x], rnd.randint(1, 30)), x, "s") for i, x in enumerate(["xx", "yy"] * 40)]
    rows += [(900, None, "xx", ""), (901, "", "yy", ""), (902, "12 !", "yy", ""), (None, rows[0][1], "yy", ""), (903, rows[1][1], None, ""), (903, rows[1][1], None, "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    whole, dealt = (sorted(identify(docs, max_cells=m).collect(), key=repr) for m in (10**6, 120))
    assert [r[:3] for r in whole] == [r[:3] for r in dealt] and len(dealt) == len(rows)
    assert [r.score for r in dealt] == pytest.approx([r.score for r in whole], abs=1e-3)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(80)], "doc_id long, quality int, toxic int")
    whole, dealt = ({(r.doc_id, r.held_out, round(r.score, 3)) for r in score(docs, labels, max_cells=m).collect()} for m in (10**6, 120))
    assert {r[:2] for r in whole} == {r[:2] for r in dealt}
    a, b = (dict(((d, h), s) for d, h, s in x) for x in (whole, dealt))
    assert all(abs(a[k] - b[k]) < 0.01 for k in a)
