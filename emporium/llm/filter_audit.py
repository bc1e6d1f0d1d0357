"""What filters take from each other, in every order: a stream that retracts what smaller ids make untrue."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from emporium.llm.common import ship
from emporium.session import shared_dir, stored

FILTERS = "ABCDE"
#: A row's mask: one bit for each filter that it fails, then one for each label that it has.
_FAILS = {name: 1 << i for i, name in enumerate(FILTERS)}
_COPY = _FAILS["E"]
_GOOD, _TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
_ALL = _GOOD - 1
#: Rows of a task that are combined at a time, before anything is shuffled.
COMBINE_ROWS = 200_000
#: Salts for the join of rows without an id, which match no label.
_SALTS = 1024

_ROWS = "bucket int, digest binary, doc_id long, part string, mask int, n long"
_DELTAS = "part string, mask int, n long"


def own_mask(text: Column) -> Column:
    """The bits of the filters that look at one text alone: A to D."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    # Of words only the two counts are used; the list is made once.
    counts = F.get(F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"))), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return F.get(F.transform(F.array(counts), lambda c: sum(
        (F.when(fails, _FAILS[name]).otherwise(0) for name, fails in {
            "A": c["n"] < 50,
            "B": 100 * c["distinct"] < 65 * c["n"],
            "C": 100 * capitals > 5 * F.length(text),
            "D": text.rlike("[#$%&*|]"),
        }.items()), F.lit(0),
    )), F.lit(0))


def label_bits(labels: DataFrame) -> DataFrame:
    """``label_id, salt, bits``, one row for each labelled id; an id with several rows has the labels of any of them."""
    of = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id"))
    found = of.agg(F.max(F.when(F.col("quality") == 1, _GOOD).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, _TOXIC).otherwise(0)).alias("toxic"))
    return found.select("label_id", F.lit(0).alias("salt"), (F.col("good") + F.col("toxic")).alias("bits"))


def masked(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """``bucket, digest, doc_id, part, mask, n`` of every row: its text's digest and bucket, and its mask without E.

    A row without an id is compared with none: it has no digest, and id 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        own_mask(text).alias("own"), F.sha2(text.cast("binary"), 256).alias("sha"),
    )
    # Rows without an id match no label: a salt keeps them from meeting in one task.
    rows = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod(F.hash("sha"), F.lit(_SALTS))).otherwise(0))
    side = labels.withColumnRenamed("salt", "label_salt")
    joined = rows.join(side, (F.col("doc_id") == F.col("label_id")) & (F.col("salt") == F.col("label_salt")), "left")
    bucket = F.pmod(F.conv(F.substring("sha", 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")
    return joined.select(
        bucket.alias("bucket"), F.when(F.col("doc_id").isNotNull(), F.unhex(F.substring("sha", 1, 32))).alias("digest"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), "part",
        (F.col("own") + F.coalesce(F.col("bits"), F.lit(0))).cast("int").alias("mask"), F.lit(1).cast("long").alias("n"),
    )


def _decided(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(rows with their text's smallest id, the rows above it): ``rows`` has digest, doc_id, part, mask and n."""
    least = rows.groupby("digest", sort=False)["doc_id"].transform("min")
    first = (rows["doc_id"] == least).to_numpy()
    return rows[first], rows[~first]


def _summed(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    out = rows.groupby(keys, sort=False, as_index=False)["n"].sum()
    return out[out["n"] != 0]


def _combined(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Rows of one task with equal texts as one row each; the others are decided and only counted."""
    without = rows["digest"].isna()
    first, above = _decided(rows[~without])
    first = _summed(first, ["bucket", "digest", "doc_id", "part", "mask"])
    counts = _summed(pd.concat([above.assign(mask=above["mask"] | _COPY), rows[without]])[["part", "mask", "n"]], ["part", "mask"])
    # A decided count needs no text: it goes to any bucket.
    spread = pd.util.hash_pandas_object(counts[["part", "mask"]], index=False) % np.uint64(buckets)
    counts = counts.assign(bucket=spread.astype("int64"), digest=None, doc_id=0)
    return pd.concat([first, counts])[["bucket", "digest", "doc_id", "part", "mask", "n"]]


def combine(buckets: int):
    """For ``mapInPandas``: at most one row for each text of ``COMBINE_ROWS`` rows, and a few counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= COMBINE_ROWS:
                yield _combined(pd.concat(held), buckets)
                held = []
        if sum(map(len, held)):
            yield _combined(pd.concat(held), buckets)

    return run


_STATE = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])


def _pack(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _STATE) as out:
        out.write_table(pa.Table.from_pandas(rows[_STATE.names], schema=_STATE, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpack(state: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(state).read_all().to_pandas()


def retract(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """New rows of a bucket of texts against what is known of them: changes of the counters by part and mask.

    The state holds, for every text of the bucket, its smallest id so far and
    the rows that have it, which are counted as no copies. A smaller id takes
    that back: those rows are counted out and counted in again as copies, for
    good, and the smaller id's rows take their place.
    """
    new = pd.concat(list(batches))
    counted = new[new["digest"].isna()]
    new = new[new["digest"].notna()]
    old = _unpack(state.get[0]) if state.exists else new.iloc[:0]
    columns = ["digest", "doc_id", "part", "mask", "n"]
    first, above = _decided(pd.concat([old[columns], new[columns]], ignore_index=True))
    first = _summed(first, columns[:-1])
    if len(new):
        state.update((_pack(first),))
    changes = [counted, first, above.assign(mask=above["mask"] | _COPY), old.assign(n=-old["n"])]
    yield _summed(pd.concat([c[["part", "mask", "n"]] for c in changes]), ["part", "mask"])


def counters(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """The stream of counter changes ``part, mask, n`` from a stream of documents."""
    rows = masked(docs, labels, buckets).mapInPandas(combine(buckets), _ROWS)
    return rows.groupBy("bucket").applyInPandasWithState(retract, _DELTAS, "texts binary", "append", GroupStateTimeout.NoTimeout)


def reports(counts: DataFrame) -> DataFrame:
    """The audit's rows from the summed counters ``part, mask, n``.

    A part has at most 32 cells (filters failed, rows, those with each label),
    which are one array; each of an order's steps sums over that array.
    """
    good, toxic = F.col("mask").bitwiseAND(_GOOD) > 0, F.col("mask").bitwiseAND(_TOXIC) > 0
    cells = counts.groupBy("part", F.col("mask").bitwiseAND(_ALL).alias("fails")).agg(
        F.sum("n").alias("n"), F.sum(F.when(good, F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(toxic, F.col("n")).otherwise(0)).alias("toxic")
    )
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    steps = [
        (
            "".join(order), k, _FAILS[name], sum(_FAILS[f] for f in order[: k - 1])
        )
        for order in permutations(FILTERS) for k, name in enumerate(order, start=1)
    ]
    literal = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("filter_order", "step", "bit", "before"), s)]) for s in steps])
    rows = parts.select("part", "cells", F.explode(literal).alias("s")).select("part", "cells", "s.*")

    def total(where, value: str = "n") -> Column:
        kept = F.filter("cells", where)
        return F.aggregate(kept, F.lit(0).cast("long"), lambda acc, c: acc + c[value])

    bit, before = F.col("bit"), F.col("before")
    fails = lambda c, bits: c["fails"].bitwiseAND(bits) != 0
    removed = lambda c: fails(c, bit) & ~fails(c, before)
    orders = len(steps) // len(FILTERS)
    # A filter takes a row in as many orders as have it first among those the row fails.
    shapley = F.aggregate(
        F.filter("cells", lambda c: fails(c, bit)), F.lit(0).cast("long"),
        lambda acc, c: acc + c["n"] * F.floor(F.lit(orders) / F.bit_count(c["fails"])).cast("long"),
    )
    return rows.select(
        "part", "filter_order", "step",
        total(lambda c: ~fails(c, before) & ~fails(c, bit)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda c: fails(c, bit) & fails(c, before)).alias("redundant"),
        total(lambda c: c["fails"] == bit).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def stream_of(spark: SparkSession, path: str, micro_batches: int) -> DataFrame:
    """The files of a Parquet table as a stream of about ``micro_batches`` micro-batches."""
    path, table = path.rstrip("/"), spark.read.parquet(path)
    files = max(1, -(-len(table.inputFiles()) // micro_batches))
    # As a pattern, so that the table may be one file as well as a folder.
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(f"{path[:-1]}[{path[-1]}]")


def audit(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = 4, texts_in_bucket: int = 1000, folder: str | None = None) -> DataFrame:
    """For every part and every order of the filters: what each step keeps, removes and would have removed.

    Reads the Parquet table ``path`` (``doc_id, text, source``) as a stream of
    available files, in ``micro_batches``, against ``labels`` (``doc_id, quality,
    toxic``). Each row's filters are SQL functions; equal texts of a task become
    one row with their smallest id before the shuffle, so a text with most of
    the rows is one row a task. State is keyed by the texts' digests (128 bits
    of SHA-256), kept in buckets of about ``texts_in_bucket`` texts, whose number
    follows the table's rows. Whatever arrives later with a smaller id retracts
    the mask counted before. Only counter changes leave the stream. Its
    checkpoint and its output are under ``folder`` (default: a new one in the
    shared folder): a call with the same folder, after a failure or with more
    files, goes on where the last one ended.

    Result: ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``, 600 rows a part. A null text is the empty
    text, a null source the part ''. A row without an id has no smaller one and
    is none: it never fails E nor makes another row fail it, and has no labels.
    Rows that repeat an id with the same text don't make each other fail. An
    empty table has no parts. Other columns, whatever their names, are not read;
    texts are taken whole.
    """
    ship(spark)
    folder = folder or f"{shared_dir(spark)}/audit-{uuid.uuid4().hex}"
    known = stored(label_bits(labels), "labels")
    # Footers alone tell the rows. The number stays with the state, so a folder used again keeps it.
    buckets = _bucket_count(spark, folder, max(1, spark.read.parquet(path).count() // texts_in_bucket))
    docs = stream_of(spark, path, micro_batches)
    query = (
        counters(docs, known, buckets).writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/changes").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    changes = spark.read.schema(_DELTAS).parquet(f"{folder}/changes")
    return reports(changes.groupBy("part", "mask").agg(F.sum("n").alias("n")).where("n <> 0"))


def _bucket_count(spark: SparkSession, folder: str, wanted: int) -> int:
    """The number of buckets that ``folder``'s state was made with; ``wanted`` where there is none."""
    path = f"{folder}/buckets"
    spark.createDataFrame([(wanted,)], "buckets long").coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.parquet(path).first()[0]
