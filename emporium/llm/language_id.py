"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.byte_grams import Grams, Level, Lookup, count_grams, held_out, scored
from emporium.llm.common import ship

UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")


def code_lengths(tree: list[Level]) -> Lookup:
    """Exact code lengths in bits of every byte under each label's frozen context tree.

    A byte seen after its context c times costs log2((n + t) / c), where n
    bytes of t kinds followed the context; an unseen byte first costs an escape,
    log2((n + t) / t), and is then coded after the context without its first
    byte. A context a label never had costs it nothing. After the empty context
    a byte costs 8 bits.
    """
    values, escapes = [], []
    for k, level in enumerate(tree):
        n, t = level.total, level.types
        escape = np.where(n > 0, np.log2(np.maximum(n + t, 1) / np.maximum(t, 1)), 0.0)
        shorter = 8.0 if k == 0 else values[-1][level.below(tree[k - 1])]
        c, at = level.counts, level.context_of
        bits = np.where(c > 0, np.log2(np.maximum(n + t, 1)[at] / np.maximum(c, 1)), escape[at] + shorter)
        values.append(bits.astype(np.float32))
        escapes.append(escape.astype(np.float32))
    return Lookup(tree, values, escapes, np.full(tree[0].counts.shape[1], 8.0))


def train(docs: DataFrame, context: int = 4, max_cells: int = 4_000_000) -> Grams:
    """All counts of the languages of ``docs(doc_id, text, lang)``, from every whole text that is not held out.

    ``max_cells`` says how many counts the driver and each machine hold at a
    time: a larger model is used in shards (:class:`Grams`), never cut.
    """
    rows = docs.where(~held_out()).where("doc_id is not null and lang is not null and text is not null")
    return Grams(count_grams(rows.select(F.col("lang").alias("label"), "text"), context + 1), context + 1, max_cells)


def identify(docs: DataFrame, context: int = 4, max_cells: int = 4_000_000) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``docs(doc_id, text, lang)``.

    The language whose variable-order byte context tree codes the whole text in
    the fewest bits; ``score`` is its share of the probability under equal
    priors (0 to 1). Texts that are null or have no letter are ``und`` with score
    0, and so are all if no language could be learned. ``lang`` is only read
    from rows that are not held out, to learn; ties go to the first language in
    alphabetical order. Rows with a null doc_id are predicted but not learned
    from. Repeated rows are judged alike; other columns are ignored; an empty
    table gives no rows. A very long text is coded whole, in a step of its own.
    """
    ship(docs.sparkSession)
    grams = train(docs, context, max_cells)
    languages = grams.labels
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    if not languages:
        return rows.select("doc_id", "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))

    def finish(pdf: pd.DataFrame, bits: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        named = np.array([_LETTER.search(t) is not None for t in pdf["text"]], dtype=bool)
        best, score = np.full(len(pdf), UNDETERMINED, dtype=object), np.zeros(len(pdf))
        bits = bits[named]
        best[named] = np.array(languages, dtype=object)[bits.argmin(axis=1)]
        score[named] = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
        return pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "held_out": pdf["held_out"], "lang_pred": best, "score": score})

    return scored(rows, grams, code_lengths, finish, "doc_id long, held_out boolean, lang_pred string, score double")
