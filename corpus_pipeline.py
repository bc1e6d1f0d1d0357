"""The corpus pipeline: stages over ``documents``, each stored as Parquet and read again by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import shared_dir
from emporium.llm.decontaminate import contamination
from emporium.llm.jaccard_join import jaccard_join
from emporium.llm.packing import pack
from emporium.llm.pii import masked, spans_of
from emporium.llm.quality_rules import keep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule of the cascade rejects go."""
    return keep(docs)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of its own for each row, by id and text, and the key's name.

    An id may be missing, or be on several texts; rows that agree in both are repeats.
    """
    key = "row_key"
    while any(c.startswith(key) for c in docs.columns):  # further names are made from it
        key += "_"
    return docs.withColumn(key, F.xxhash64("doc_id", "text")), key


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each similarity class stays: the one with the least doc_id, rows without one last.

    Decided row by row: a row without a doc_id is in a class like any other,
    and rows that share an id with different texts are different documents. Rows
    that repeat both id and text are one document, and one of them stays. A text
    without a word is in no class and stays, repeated or not. Other columns are
    carried through; an empty table stays empty.
    """
    keyed, key = _keyed(docs)
    joined = jaccard_join(keyed.select(F.col(key).alias("doc_id"), "text")).where("n_links > 0")
    linked = joined.select(F.col("doc_id").alias("linked_key"), "class_id").distinct()
    ids = keyed.select(F.col(key).alias("named_key"), "doc_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "linked_key"))
    stays = linked.join(ids, linked["linked_key"] == ids["named_key"]).groupBy("class_id").agg(first["linked_key"].alias("kept_key"))
    linked_key, one = f"{key}_linked", f"{key}_stays"
    decided = linked.join(stays, "class_id").select(F.col("linked_key").alias(linked_key), (F.col("linked_key") == F.col("kept_key")).alias(one))
    found = keyed.join(decided, F.col(key) == F.col(linked_key), "left").where(F.col(one).isNull() | F.col(one))
    # Of a class's rows only repeats are left; every row of no class is told apart.
    apart = F.when(F.col(one).isNull(), F.monotonically_increasing_id()).otherwise(-1)
    return found.withColumn(one, apart).dropDuplicates([key, one]).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % or more of a benchmark item's five-word shingles go.

    Decided row by row: a row without a doc_id goes like any other, and one
    that only shares its id with a contaminated text stays.
    """
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    keyed, key = _keyed(docs)
    found = contamination(keyed.select(F.col(key).alias("doc_id"), "text"), items)
    hit = found.select(F.col("doc_id").alias(f"{key}_hit")).distinct()
    return keyed.join(hit, F.col(key) == F.col(f"{key}_hit"), "left_anti").select(*docs.columns)


def personal_data_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data in ``text`` becomes its kind in angle brackets; ``n_chars`` follows.

    The spans are those of :func:`emporium.llm.pii.personal_data`; one projection, all rows stay.
    """
    found = docs.withColumn("text", masked(F.col("text"), spans_of(F.col("text"))))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row per piece of a document."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), 4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("personal_data", personal_data_masked),
    ("best_fit_packing", packed),
]

#: Packing and MinHash search are not expressible in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the stages' results go to the session's shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
