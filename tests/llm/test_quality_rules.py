import random
import re

from pyspark.sql import functions as F

from emporium.llm.quality_rules import RULES, Rule, assess, keep, ordered, rejected


def brute_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def texts():
    rnd = random.Random(5)
    bits = ["a ", "b ", "\n", "c\t", "# ", "é😀 ", "\x0b", "\r\n"]
    out = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 80))) for _ in range(800)]
    out += [" ".join(rnd.choice("ab") for _ in range(rnd.randint(6, 40))) for _ in range(800)]
    return out + [None, "", "a " * 20_000, "\n" * 1000, "x" * 50_000, out[0], out[0], "STOP!! " * 3 + "word " * 9]


def test_metrics_are_brute_force(spark):
    some = texts()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(some)], "doc_id long, text string, kept int").repartition(4)
    got = {r.doc_id: r for r in assess(docs).collect()}
    for i, t in enumerate(some):
        n_words, *rest = brute_force(t)
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == (n_words, *rest)
        assert got[i].base_failed == (n_words < 20 or 100 * rest[3] > 30 * n_words)
        assert not (got[i].kept and got[i].base_failed)


def test_the_order_never_changes_the_verdict(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    text = F.coalesce("text", F.lit(""))
    out = docs.select("doc_id", rejected(text, RULES).alias("a"), rejected(text, RULES[::-1]).alias("b"))
    assert out.where("a <> b").count() == 0
    kept = {r.doc_id for r in keep(docs, sample_rows=50).collect()}
    assert kept == {r.doc_id for r in out.where("not a").collect()}
    assert kept == {r.doc_id for r in assess(docs).where("kept").collect()}


def test_rules_that_reject_more_for_their_cost_come_first(spark):
    docs = spark.createDataFrame([(i, "word " * 30) for i in range(400)], "doc_id long, text string")
    never = Rule("never", lambda t: F.length(t) < 0)
    always = Rule("always", lambda t: F.length(t) > 0)
    assert [r.name for r in ordered(docs, (never, always))] == ["always", "never"]


def test_rejected_columns_stay_and_empty_tables(spark):
    good = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(None, good, "x"), (1, None, "y"), (1, good, None)], "doc_id long, text string, n_words string")
    assert sorted(map(repr, keep(docs).collect())) == sorted(map(repr, docs.where("text is not null").collect()))
    assert keep(docs.limit(0)).count() == 0 and assess(docs.limit(0)).count() == 0
