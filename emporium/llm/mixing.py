"""Mix sources to target weights: per-source repetition rates, whole copies and one hash-seeded draw a document."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.operators.numbering import number_within
from emporium.session import stored

#: A table of targets up to this many rows (some 10 MB) is broadcast; a larger one is joined as the planner sees fit.
BROADCAST_ROWS = 100_000
_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """How many words ``text`` has, null none: every word and the blanks around it become one character."""
    one = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]*" + _WORD + r"[\x20\x09-\x0D]*", "w")
    # A text of blanks alone is left as it is.
    return F.when(one.startswith("w"), F.length(one)).otherwise(0).cast("long")


def draw(seed: str, *identity: Column) -> Column:
    """A number in [0, 1) that depends on ``seed`` and the values of ``identity`` only: 52 bits of their MD5."""
    values = [F.coalesce(c.cast("string"), F.lit("-")) for c in identity]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *values)), 1, 13), 16, 10)
    return bits.cast("double") / F.lit(float(2**52))


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """``doc_id, source, size, draw`` of every row; rows that agree in doc_id, source and text draw alike."""
    text = F.col("text")
    return docs.select(
        "doc_id", "source", n_words(text).alias("size"),
        draw(seed, F.col("doc_id"), F.col("source"), F.md5(F.coalesce(text, F.lit("")))).alias("draw"),
    )


def targets(sources: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``source, source_size, weight, target, rate`` from one row ``source, source_size`` for each source.

    Sources take ``weights`` in turn, by code point, null last, and share the sum
    of all sizes by weight. A target stops at ``most`` times its source's size;
    what is over goes to the others by weight, until none is above. That is one
    level, words for each unit of weight, that rises as sources reach their
    limit: a round finds the sources above the level and sets it anew from the
    rest. Only the level, two whole numbers, reaches the driver; products are
    exact decimals. A source without words has target and rate zero.
    """
    placed = number_within(
        sources.select("source", "source_size", F.col("source").isNull().alias("_last"), F.lit(0).alias("_all")),
        "_all", ["_last", "source"], "place",
    )
    turn = F.array(*[F.lit(int(w)) for w in weights])
    weighed = stored(
        placed.select("source", "source_size", F.get(turn, ((F.col("place") - 1) % len(weights)).cast("int")).cast("long").alias("weight")),
        "weights",
    )

    def exact(value) -> Column:
        return (value if isinstance(value, Column) else F.lit(Decimal(value))).cast("decimal(19,0)")

    limit = most * F.col("source_size")
    total = weighed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words = rest = total["words"] or 0
    share, full = total["weight"] or 1, 0
    while True:
        above = exact(limit) * exact(share) < exact(F.col("weight")) * exact(rest)
        now = weighed.agg(
            F.count_if(above).alias("full"),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if now["full"] == full:
            break
        full, rest, share = now["full"], words - now["held"], now["weight"]
    level = (exact(F.col("weight")) * exact(rest)).cast("double") / F.lit(float(share))
    target = F.when(above, limit.cast("double")).otherwise(level)
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    return weighed.withColumn("target", target).withColumn("rate", rate)


def copies(rate: Column, drawn: Column, turn: Column) -> Column:
    """``floor(rate)``, and one more where the draw, moved on by ``turn`` around the unit interval, is under the fraction."""
    moved = drawn + turn
    return (F.floor(rate) + F.when(moved - F.floor(moved) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _with_targets(rows: DataFrame, plan: DataFrame, source: Column) -> DataFrame:
    """``rows`` with the columns of their source's target as ``_mix``; the table is broadcast if it is proven small."""
    side = plan.select(F.col("source").alias("_mix_source"), F.struct(*[c for c in plan.columns if c != "source"]).alias("_mix"))
    if plan.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    return rows.join(side, source.eqNullSafe(F.col("_mix_source"))).drop("_mix_source")


def _turned(rows: DataFrame, plan: DataFrame, turns: int) -> DataFrame:
    """``plan`` with ``turn``: of ``turns`` seeds for each source, the one whose words come nearest to the target.

    A few long documents can carry a source's draws far from the mean. Every
    turn of the draws by a multiple of ``1 / turns`` is a seed of its own, under
    which each document's copy still has its probability; all are summed in one pass.
    """
    tried = [F.lit(k / turns) for k in range(turns)]
    planned = _with_targets(rows, plan.select("source", "target", "rate"), F.col("source"))
    sums = planned.groupBy("source").agg(
        F.first("_mix.target").alias("target"),
        *[F.sum(F.col("size") * copies(F.col("_mix.rate"), F.col("draw"), turn)).alias(f"t{k}") for k, turn in enumerate(tried)],
    )
    away = [F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("away"), turn.alias("turn")) for k, turn in enumerate(tried)]
    best = sums.select(F.col("source").alias("_of"), F.array_min(F.array(*away))["turn"].alias("turn"))
    return stored(plan.join(best, F.col("source").eqNullSafe(F.col("_of"))).drop("_of"), "rates")


def _planned(docs: DataFrame, weights: Sequence[int], most: int, seed: str, turns: int) -> tuple[DataFrame, DataFrame]:
    rows = stored(sized(docs, seed), "sized")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    return rows, _turned(rows, plan, turns)


def taken(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix", turns: int = 16) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, weight, rate, turn, copies`` of every row of ``docs``.

    Needs ``doc_id, source, text``; other columns, whatever their names, are not
    read. ``taken`` is the document's words times its copies. A null source is a
    source of its own, the last. Of ``turns`` seeds each source has the one that
    comes nearest to its target. A null or empty text has size 0 and the copies
    of its source's rate. Equal rows (doc_id, source and text) draw alike, rows
    that share an id alone do not; a null doc_id is drawn for by its text. An
    empty table gives no rows. Long texts are counted whole. Texts are read
    once; the counts are stored in the shared folder, so a lost executor costs
    its own tasks only. SQL functions throughout: sums are combined before they
    are shuffled, so a source with most of the rows is no hot key.
    """
    rows, plan = _planned(docs, weights, most, seed, turns)
    out = _with_targets(rows, plan, F.col("source")).withColumn("copies", copies(F.col("_mix.rate"), F.col("draw"), F.col("_mix.turn")))
    return out.select(
        "doc_id", "size", "_mix.source_size", "_mix.target", (F.col("size") * F.col("copies")).alias("taken"),
        "source", "_mix.weight", "_mix.rate", "_mix.turn", "copies",
    )


def mixture(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix", turns: int = 16, copy: str = "copy") -> DataFrame:
    """The mixed table: all columns of ``docs``, each row as often as its draw says, numbered by ``copy`` from 1.

    The copies are those of :func:`taken`. Texts are read a second time, and
    repeated where they lie: no text is shuffled.
    """
    if {copy, "_mix", "_mix_source"} & set(docs.columns):
        raise ValueError(f"{copy}, _mix and _mix_source must not be columns of the documents")
    _, plan = _planned(docs, weights, most, seed, turns)
    drawn = draw(seed, docs["doc_id"], docs["source"], F.md5(F.coalesce(docs["text"], F.lit(""))))
    out = _with_targets(docs, plan, docs["source"]).withColumn("_mix", copies(F.col("_mix.rate"), drawn, F.col("_mix.turn")))
    return out.where("_mix > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("_mix").cast("int")))).drop("_mix")
