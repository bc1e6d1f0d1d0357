"""Registered queries of this subpackage and, where SQL can state them, their DuckDB oracles."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm import oracles
from emporium.llm.common import shared_dir
from emporium.llm.decontaminate import contamination
from emporium.llm.filter_audit import audit as audit_filters
from emporium.llm.fixity import audit, read_archive, record_id, warc_record, write_archive
from emporium.llm.jaccard_join import jaccard_join
from emporium.llm.language_id import identify
from emporium.llm.manifest import manifest
from emporium.llm.mixing import taken
from emporium.llm.packing import pack
from emporium.llm.passages import repeated_passages
from emporium.llm.pii import BASE, joined, n_spans, personal_data
from emporium.llm.quality_rules import assess
from emporium.llm.toxicity import score
from emporium.llm.url_filter import UrlRule, judge

#: The rules that op9 judges by.
URL_RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)
TOKENIZER = "word_bpe_49k.json"
SEQUENCE_TOKENS = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), SEQUENCE_TOKENS)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and a digest of the base spans, and all spans, of every document."""
    found = personal_data(_table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    counts = [n_spans(spans, kind).alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(spans, BASE), 256).alias("base_sha256"), joined(spans).alias("spans"))


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``pages`` as a WARC archive and as a second copy with damage, and locate the damage.

    In the copy, pages whose url's MD5 begins with 00 or 0a have their html's
    first character replaced, and those where it begins with 01f are left out.
    """
    pages = _table(spark, sf_dir, "pages")
    name, sum_ = record_id(F.col("page_id"), F.col("url")), F.md5("url")
    damaged = F.when(sum_.rlike("^0[0a]"), F.concat(F.lit("~"), F.substring("html", 2, 2**31 - 1))).otherwise(F.col("html"))
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages.select(warc_record(name, F.col("url"), F.col("html")).alias("record")), f"{folder}/first")
    copy = pages.where(~F.coalesce(F.startswith(sum_, F.lit("01f")), F.lit(False)))
    write_archive(copy.select(warc_record(name, F.col("url"), damaged).alias("record")), f"{folder}/second")
    return audit(read_archive(spark, f"{folder}/first"), read_archive(spark, f"{folder}/second"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, and versions of it in which a document's text has lost its capitals (A-Z)."""
    docs = _table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    versions = manifest(docs, {"text": lowered}, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    return versions.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(spark, f"{sf_dir.rstrip('/')}/documents.parquet", _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_personal_data": op4_personal_data,
        "op5_warc_fixity": op5_warc_fixity,
        "op6_benchmark_decontamination": op6_benchmark_decontamination,
        "op7_quality_rules": op7_quality_rules,
        "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
        "op9_url_filter": op9_url_filter,
        "op10_language_id": op10_language_id,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_mixing": op12_mixing,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.statements(URL_RULES)
