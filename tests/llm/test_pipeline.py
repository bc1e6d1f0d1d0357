import random

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture()
def folder(spark, tmp_dir):
    rnd = random.Random(7)
    vocabulary = [f"word{i}" for i in range(2000)]

    def prose(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    item = prose(30)
    clean = [prose(rnd.randint(40, 200)) for _ in range(30)]
    near = clean[3].split()
    near[5] = "edited"
    rows = dict(enumerate(clean)) | {
        100: "too short", 101: "same words again " * 40, 102: None, 103: "",  # the rules reject these
        110: clean[2], 111: " ".join(near) if len(near) > 60 else clean[3],  # copies
        120: prose(60) + " " + item,  # holds a benchmark item
        130: prose(50) + " write to someone@example.org or 10.1.2.3 now",
    }
    docs = [(i, t, "en", "s", 0) for i, t in rows.items()]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    return tmp_dir


def test_every_stage_decides(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean = set(range(30))
    assert kept[0] == clean | {110, 111, 120, 130}
    assert kept[1] == clean | {120, 130}
    assert kept[2] == kept[3] == kept[4] == clean | {130}
    masked = spark.read.parquet(f"{folder}/3-personal_data").where("doc_id = 130").first()
    assert masked.text.endswith("write to <email> or <ip> now") and masked.n_chars == len(masked.text)
    tokens = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/3-personal_data").collect()}
    packed = docs.toPandas().groupby("doc_id")["length"].sum().to_dict()
    assert packed == {d: len(tokens.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts.items()}


def test_run_is_the_stages_in_a_row(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in out.select("doc_id").collect()} == set(range(30)) | {130}


def test_nulls_and_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    nulls = docs.limit(0).unionByName(spark.createDataFrame([(None, None, None, None, None)] * 2, COLUMNS))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
        assert stage(spark, nulls, folder).count() in (0, 2)


def test_a_table_of_the_given_data(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and out.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


def test_rows_are_decided_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    first, second, third, item = texts[0], texts[1], texts[4], texts[120]
    rows = [
        (7, first, "a"), (7, second, "b"),  # one id, two texts
        (None, first, "c"), (None, third, "d"), (None, third, "e"),  # no id: a copy of another row, and repeats
        (8, second, "f"), (9, item, "g"), (9, texts[5], "h"), (None, item + " more", "i"), (8, None, "j"), (8, None, "k"),
    ]
    some = spark.createDataFrame([(i, t, "en", s, 0, 1) for i, t, s in rows], COLUMNS + ", row_key int")

    def kept(df):
        assert df.columns == some.columns
        return {r.source for r in df.collect()}

    unique = kept(corpus_pipeline.near_duplicates(spark, some, folder))
    assert unique - {"d", "e"} == {"a", "b", "g", "h", "j", "k"} and len(unique & {"d", "e"}) == 1
    assert kept(corpus_pipeline.decontaminated(spark, some, folder)) == set("abcdefhjk")
