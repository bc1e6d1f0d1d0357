import random
import re

from pyspark.sql import functions as F

from emporium.llm.pii import BASE, joined, masked, personal_data, spans_of

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_force(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def found(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(4)
    rows = personal_data(docs).select("doc_id", joined(F.col("spans"), BASE).alias("base"), joined(F.col("spans")).alias("every"), "spans").collect()
    return {r.doc_id: r for r in rows}


def test_base_spans_are_the_contracts(spark):
    rnd = random.Random(3)
    bits = list("ab.@-+ 01259()_\n") + ["😀", "é", "4111 1111 1111 1111", "a@b.com_x@y.org", "255.0.0.1", "0000255.1.1.1", "1.2.3.4.5.6.7.8", "+1 (988) 555-2485", "@x.y", ".."]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += [None, "", "1" * 60_000, "a" * 100_000 + "@", "a.b@c" + ".d" * 20_000, "1.1.1.1 " * 2000, texts[3], texts[3]]
    got = found(spark, texts)
    assert [got[i].base for i in range(len(texts))] == [brute_force(t) for t in texts]


def test_checksums_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00.",  # mod 97 holds
        "IBAN DE88 3704 0044 0532 0130 00.",  # and here not
        "xGB82WEST12345698765432",  # not alone
        "my social security number is 078-05-1120",
        "part 078-05-1120",  # no word nearby
        "ssn 000-05-1120, ssn 078-05-11205",  # no such number; not alone
        "call +1 (988) 555-2485 or not: +1 (988) 555-2485",
    ]
    got = found(spark, texts)
    assert got[0].every == "iban:5:32"
    assert got[1].every == got[2].every == got[4].every == got[5].every == ""
    assert got[3].every == "ssn:29:40"
    assert [s.score for s in got[6].spans] == [1.0, 0.7]  # the context ends at the span before


def test_masks_cover_all_spans(spark):
    texts = ["mail a@b.org, 10.0.0.1 and 4111 1111 1111 1111!", "nothing", None, "", "😀 a@b.org😀 a@b.org"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(docs.select("doc_id", masked(F.col("text"), spans_of(F.col("text")))).collect())
    assert [got[i] for i in range(len(texts))] == ["mail <email>, <ip> and <card>!", "nothing", None, "", "😀 <email>😀 <email>"]


def test_empty_table(spark):
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.org")], "doc_id long, text string")
    plan = personal_data(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_neighbours_do_not_hide_a_span(spark):
    texts = [
        "DE89 3704 0044 0532 0130 00 BIC COBADEFF",
        "GB82WEST12345698765432 Please",
        "GB82 WEST 1234 5698 7654 32 DE89 3704 0044 0532 0130 00 17",
        "AB12 3456 7890 123 DE89370400440532013000",  # no such country before it
        "SSN: 123-45-6789, 078-05-1120",
        "DE89 3704 0044 0532 0130 001",  # too long
    ]
    got = found(spark, texts)
    assert got[0].every == "iban:0:27"
    assert got[1].every == "iban:0:22"
    assert got[2].every == "iban:0:27,iban:28:55"
    assert got[3].every == "iban:19:41"
    assert got[4].every == "ssn:5:16,ssn:18:29"
    assert got[5].every == ""
