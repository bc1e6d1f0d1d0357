"""Toxicity by two class-conditional Kneser-Ney models over bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.byte_grams import Grams, Level, Lookup, count_grams, held_out, scored
from emporium.llm.common import ship

CLASSES = ("ordinary", "toxic")
THRESHOLD = 0.3
#: Intercept and weights where the labelled rows cannot fit them.
DEFAULT_WEIGHTS = (-4.0, 0.0, 4.0)


def log_ratios(tree: list[Level], discount: float = 0.75, shared_length: int = 2) -> Lookup:
    """log P(byte | context, toxic) - log P(byte | context, ordinary) of every n-gram.

    Each class has absolutely discounted counts, interpolated with the next
    shorter context. From n-grams of ``shared_length`` bytes downwards both
    classes back off to one distribution: the Kneser-Ney continuation counts
    (after how many different contexts a byte occurs) of both together, so rare
    expressions that neither class has seen often do not tell them apart.
    """
    values, misses = [], []
    own = shared = None
    for k, level in enumerate(tree):
        at, n = level.context_of, level.total[level.context_of]
        if k == 0:
            low_shared = np.full(len(level.keys), 1 / 256)
            low_own = np.full((len(level.keys), 2), 1 / 256)
        else:
            below = level.below(tree[k - 1])
            low_shared, low_own = shared[below], own[below]
        base = np.repeat(low_shared[:, None], 2, axis=1) if level.length <= shared_length else low_own
        seen = np.maximum(n, 1)
        own = np.where(n > 0, np.maximum(level.counts - discount, 0) / seen + discount * level.types[at] / seen * base, low_own)
        shared = (np.maximum(level.distinct - discount, 0) + discount * level.distinct_types[at] * low_shared) / level.distinct_total[at]
        left = np.where(level.total > 0, discount * level.types / np.maximum(level.total, 1), 1.0)
        values.append((np.log(own[:, 1:]) - np.log(own[:, :1])).astype(np.float32))
        misses.append((np.log(left[:, 1:]) - np.log(left[:, :1])).astype(np.float32))
    return Lookup(tree, values, misses, np.zeros(1))


def features(ratio: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Intercept and the log-likelihood ratio normalised by length and by its square root."""
    n = np.maximum(n, 1)
    return np.stack([np.ones(len(n)), np.arcsinh(20 * ratio / n), np.arcsinh(ratio / np.sqrt(n))], axis=1)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Logistic regression by Newton steps; the default weights if a class is missing."""
    if len(set(y.tolist())) < 2:
        return np.array(DEFAULT_WEIGHTS)
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, x.T @ (p - y) + ridge * w)
    return w


_RATIOS = "doc_id long, {extra}, ratio double, n long"


def _ratios(rows: DataFrame, grams: Grams, extra: str) -> DataFrame:
    """Log-likelihood ratio and length in bytes of each text of ``rows(doc_id, <extra>, text)``; 0 without two classes."""
    name = extra.split()[0]
    if grams.labels != list(CLASSES):
        return rows.select("doc_id", name, F.lit(0.0).alias("ratio"), F.lit(0).cast("long").alias("n"))

    def finish(pdf: pd.DataFrame, sums: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), name: pdf[name], "ratio": sums[:, 0], "n": n})

    return scored(rows, grams, log_ratios, finish, _RATIOS.format(extra=extra))


def train(docs: DataFrame, labels: DataFrame, order: int = 5, max_cells: int = 4_000_000, fit_rows: int = 50_000, broadcast_labels: int = 2_000_000) -> tuple[Grams, np.ndarray]:
    """The two models' counts and the weights of the score.

    Learns from rows of ``labels(doc_id, toxic)`` whose document is not held
    out. Four fifths (by a hash of doc_id) are counted, whole and all of them;
    ``max_cells`` says how many counts are held at a time (:class:`Grams`). The
    score's three weights are fitted on the remaining fifth, on at most
    ``fit_rows`` of its rows.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    if known.limit(broadcast_labels + 1).count() <= broadcast_labels:
        known = F.broadcast(known)
    rows = docs.select("doc_id", "text").where(~held_out()).where("text is not null").join(known, F.col("doc_id") == F.col("label_id"))
    fitted = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    label = F.when(F.col("toxic") == 1, CLASSES[1]).otherwise(CLASSES[0])
    grams = Grams(count_grams(rows.where(~fitted).select(label.alias("label"), "text"), order), order, max_cells)
    held = _ratios(rows.where(fitted).select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text"), grams, "toxic int")
    pdf = held.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).toPandas()
    weights = fit(features(pdf["ratio"].to_numpy(), pdf["n"].to_numpy()), (pdf["toxic"] == 1).to_numpy(dtype=float))
    return grams, weights


def score(docs: DataFrame, labels: DataFrame, order: int = 5, threshold: float = THRESHOLD, max_cells: int = 4_000_000) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs(doc_id, text)``.

    A whole text's log-likelihood under the toxic model less that under the
    ordinary one, normalised by its length, goes through a logistic curve to a
    ``score`` from 0 to 1; ``predicted`` is 1 from ``threshold`` on. Only the
    text enters a score. A null or empty text has a ratio of zero, so its score
    is what the weights give to no evidence. Without labelled rows of both
    classes every text is scored like that. Rows with a null doc_id are scored
    and never learned from; of repeated labels of a document the largest counts.
    Other columns are ignored; an empty table gives no rows. A very long text is
    scored whole, in a step of its own.
    """
    ship(docs.sparkSession)
    grams, weights = train(docs, labels, order, max_cells)
    found = _ratios(docs.select("doc_id", held_out().alias("held_out"), "text"), grams, "held_out boolean")
    n = F.greatest(F.col("n"), F.lit(1))
    z = F.lit(float(weights[0])) + float(weights[1]) * F.asinh(20 * F.col("ratio") / n) + float(weights[2]) * F.asinh(F.col("ratio") / F.sqrt(n))
    judged = found.select("doc_id", "held_out", (1 / (1 + F.exp(-z))).alias("score"))
    return judged.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
