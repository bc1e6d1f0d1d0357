import random
import re
import tempfile
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from emporium.llm.filter_audit import COMBINE_ROWS, audit, label_bits, masked

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails_of(text, doc_id, least):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 50:
        out.add("A")
    if 100 * len(set(words)) < 65 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
        out.add("C")
    if re.search("[#$%&*|]", text):
        out.add("D")
    if doc_id is not None and doc_id > least[text]:
        out.add("E")
    return out


def brute_force(rows, labels):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, source in rows:
        parts.setdefault(source or "", []).append((fails_of(text or "", i, least), i in good, i in toxic))
    out = []
    for part, docs in parts.items():
        steps = {}
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                removed = [d for d in docs if f in d[0] and not d[0] & before]
                steps["".join(order), k + 1] = [
                    sum(not d[0] & (before | {f}) for d in docs), len(removed), sum(f in d[0] and bool(d[0] & before) for d in docs),
                    sum(d[0] == {f} for d in docs), sum(d[1] for d in removed), sum(d[2] for d in removed),
                ]
        shapley = {}
        for (order, k), v in steps.items():
            shapley[order[k - 1]] = shapley.get(order[k - 1], 0) + v[1]
        out += [(part, order, k, *v, shapley[order[k - 1]]) for (order, k), v in steps.items()]
    return out


def text_of(rnd):
    words = [rnd.choice(["alpha", "Beta", "gamma#", "D", f"w{rnd.randint(0, 500)}"]) for _ in range(rnd.choice([0, 3, 49, 50, 80]))]
    return rnd.choice([" ", "\n", " \t"]).join(words)


def rows_of(n, seed=3):
    rnd = random.Random(seed)
    texts = [text_of(rnd) for _ in range(n // 4)] + [None, "", " ", "É" * 30, "plain " * 20_000]
    rows = [(rnd.choice([rnd.randint(-500, 500), rnd.randint(0, 2**62), None]), rnd.choice(texts), rnd.choice(["a", "b", "", None])) for _ in range(n)]
    rows += [(rnd.randint(-10_000, 10_000), "one text " * 30, "a") for _ in range(n // 3)]  # a third of all rows
    return rows + rows[:20]


LABELS = [(i, i % 2, i % 3 // 2) for i in range(-400, 400)] + [(7, 1, 1), (7, 0, 0), (None, 1, 1), (8, None, None)]


def table_of(spark, rows, files):
    """A Parquet table whose files hold the rows in the given order."""
    path = f"{tempfile.mkdtemp(prefix='emporium-audit-')}/documents.parquet"
    size = -(-len(rows) // files)
    for k in range(0, max(len(rows), 1), size or 1):
        df = spark.createDataFrame([(*r, "x", 1) for r in rows[k : k + size]], "doc_id long, text string, source string, digest string, mask int")
        df.coalesce(1).write.mode("append").parquet(path)
    return path


def labels_of(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("order", ["as made", "rising", "falling"])
def test_brute_force(spark, order):
    rows = rows_of(240)
    if order != "as made":  # falling ids: each micro-batch takes back what the last one counted
        rows = sorted(rows, key=lambda r: r[0] or 0, reverse=order == "falling")
    got = audit(spark, table_of(spark, rows, 4), labels_of(spark), micro_batches=4, texts_in_bucket=20)
    assert got.columns == list(COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(rows, LABELS))


def test_more_files_are_added_to_the_same_state(spark, tmp_dir):
    rows = sorted(rows_of(90), key=lambda r: r[0] or 0, reverse=True)
    path = table_of(spark, rows[:60], 1)
    first = audit(spark, path, labels_of(spark), folder=tmp_dir).collect()
    assert sorted(map(tuple, first)) == sorted(brute_force(rows[:60], LABELS))
    spark.createDataFrame([(*r, "x", 1) for r in rows[60:]], spark.read.parquet(path).schema).coalesce(1).write.mode("append").parquet(path)
    both = audit(spark, path, labels_of(spark), folder=tmp_dir, texts_in_bucket=1)
    assert sorted(map(tuple, both.collect())) == sorted(brute_force(rows, LABELS))
    again = audit(spark, path, labels_of(spark), folder=tmp_dir)  # nothing new
    assert sorted(map(tuple, again.collect())) == sorted(brute_force(rows, LABELS))


def test_equal_texts_meet_before_the_shuffle(spark):
    from emporium.llm.filter_audit import _ROWS, combine

    docs = spark.range(50_000).selectExpr("id AS doc_id", "'same' AS text", "'p' AS source").coalesce(1)
    rows = masked(docs, label_bits(labels_of(spark)), 10).mapInPandas(combine(10), _ROWS).collect()
    assert 50_000 < COMBINE_ROWS and len(rows) < 10
    assert sum(r.n for r in rows) == 50_000 and sum(r.n for r in rows if r.digest) == 1


def test_empty_table_and_labels(spark):
    path = table_of(spark, [], 1)
    assert audit(spark, path, labels_of(spark)).count() == 0
    rows = [(1, "x", "a"), (2, "x", "a")]
    got = audit(spark, table_of(spark, rows, 1), labels_of(spark).limit(0))
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(rows, []))
    assert got.where(F.col("good_lost") + F.col("toxic_lost") > 0).count() == 0
