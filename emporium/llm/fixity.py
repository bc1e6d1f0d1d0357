"""WARC archives and a Merkle audit of their replicas."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emporium.llm.common import cut, ship

_END = "\r\n\r\n"
RECORDS = "file string, record_id string, uri string, offset long, length long, digest string"


def warc_record(record_id: Column, uri: Column, payload: Column, date: str = "2024-01-01T00:00:00Z") -> Column:
    """One WARC resource record, without the two line ends that close it. Nulls become empty."""
    body = F.coalesce(payload, F.lit(""))
    target = F.regexp_replace(F.coalesce(uri, F.lit("")), r"[\r\n]", " ")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <"), record_id,
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), target,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body,
    )


def record_id(*identity: Column) -> Column:
    """A name-based identifier of the row's identity columns; null and empty differ."""
    name = F.md5(F.to_json(F.struct(*identity), {"ignoreNullFields": "false"}))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(name, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"))


def write_archive(records: DataFrame, path: str, file_records: int = 10_000) -> None:
    """``records(record string)`` as gzipped WARC files in the rows' order: one or more for each partition.

    A file has ``file_records`` records at most, so that one can be read whole,
    and damage to its stream reaches no further than its end.
    """
    out = records.select("record").write.option("lineSep", _END).option("compression", "gzip")
    out.option("maxRecordsPerFile", file_records).text(path)


_MAGIC = b"\x1f\x8b\x08"
_STEP = 1024  # bytes of a compressed stream that are decoded at a time


def _gzip_head(content: bytes, at: int) -> int:
    """Where the deflate stream of the gzip member at ``at`` begins; -1 if that is no member's head."""
    if content[at : at + 3] != _MAGIC or len(content) < at + 10 or content[at + 3] & 0xE0:
        return -1
    flags, at = content[at + 3], at + 10
    if flags & 4:
        at += 2 + int.from_bytes(content[at : at + 2], "little")
    for flag in (8, 16):  # name, comment
        if flags & flag:
            at = content.find(b"\0", at) + 1
            if not at:
                return -1
    return at + 2 if flags & 2 else at


def _member(content: bytes, at: int) -> tuple[bytes, int]:
    """What can be decoded of the deflate stream at ``at``, and where its member ends (-1: it does not end well).

    The member's checksum is not looked at: what differs is told by the
    records' own digests, and a wrong byte need not cost the records beside it.
    """
    stream, out = zlib.decompressobj(-15), []
    while at < len(content):
        piece = content[at : at + _STEP]
        try:
            out.append(stream.decompress(piece))
        except zlib.error:
            return b"".join(out), -1
        at += len(piece)
        if stream.eof:
            return b"".join(out), at - len(stream.unused_data) + 8
    return b"".join(out), -1


def _segments(content: bytes) -> Iterator[tuple[bytes, bool]]:
    """The parts of a stored file: decoded bytes, or (False) the bytes of a stretch that cannot be decoded.

    A file that does not begin as gzip is taken as it is. After a member that
    breaks off, reading goes on at the next member's head, if there is one.
    """
    if content[:2] != _MAGIC[:2]:
        yield content, True
        return
    at = 0
    while at < len(content):
        start = _gzip_head(content, at)
        data, end = _member(content, start) if start >= 0 else (b"", -1)
        if data:
            yield data, True
        if end < 0:
            following = content.find(_MAGIC, at + 1)
            while following >= 0 and (_gzip_head(content, following) < 0 or not _member(content[: following + 4 * _STEP], _gzip_head(content, following))[0]):
                following = content.find(_MAGIC, following + 1)
            end = following if following >= 0 else len(content)
            yield content[at:end], False
        at = end


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for name, content in zip(batch["file"], batch["content"]):
            rows, before = [], 0
            for data, readable in _segments(bytes(content)):
                if readable:
                    rows += [(name, *r[:2], before + r[2], *r[3:]) for r in _records(data)]
                else:
                    rows.append((name, None, None, before, len(data), hashlib.sha256(data).hexdigest()))
                before += len(data)
            yield pd.DataFrame(rows, columns=["file", "record_id", "uri", "offset", "length", "digest"])


def _records(data: bytes) -> Iterator[tuple]:
    """``record_id, uri, offset, length, digest`` of all that ``data`` holds."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        fields = _header(data[at:head]) if head >= 0 else {}
        size = fields.get("content-length", "")
        end = head + 4 + int(size) + 4 if size.isascii() and size.isdigit() and len(size) < 16 else -1
        if end < 0 or end > len(data) or data[end - 4 : end] != b"\r\n\r\n":
            # Not a record: what follows up to the next record's head is one damaged stretch.
            following = data.find(b"\r\n\r\nWARC/", at)
            end = following + 4 if following >= 0 else len(data)
        yield fields.get("warc-record-id", "").strip("<>") or None, fields.get("warc-target-uri"), at, end - at, hashlib.sha256(data[at:end]).hexdigest()
        at = end


def _header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return {}
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``file, record_id, uri, offset, length, digest`` (SHA-256) of every record of the WARC files in ``path``.

    ``file`` is the part number of the file name (with the file's own number, if
    a part has several), else the name. Offsets are in the uncompressed stream.
    Damage is located, never an error: a stretch that is no record, or that
    cannot be decompressed (then with the offset at which it begins and its
    stored length), is one record without an id, and what can be read before
    and, in files of several gzip members, after it is read. A file of no bytes
    has no records. Files are read whole, one at a time.
    """
    ship(spark)
    name = F.element_at(F.split("path", "/"), -1)
    number, nth = F.regexp_extract(name, r"^part-(\d+)", 1), F.regexp_extract(name, r"-c(\d+)\.", 1)
    part = F.when(nth.rlike("[1-9]"), F.concat_ws("-", number, nth)).otherwise(number)
    files = spark.read.format("binaryFile").load(path).select(F.when(part != "", part).otherwise(name).alias("file"), "content")
    return files.mapInPandas(_parsed, RECORDS)


def tree(records: DataFrame, span: int, fanout: int, depth: int) -> DataFrame:
    """Merkle nodes ``(file, level, node, digest)`` of ``records(file, offset, length, digest)``.

    A node of level 0 hashes the records that begin in its ``span`` bytes of the
    file, in order; a node of a higher level hashes ``fanout`` nodes below it.
    Groups hold at most a span's records or ``fanout`` nodes.
    """
    entry = F.concat_ws(":", "offset", "length", "digest")
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", entry.alias("entry")))), lambda r: r["entry"]), ",")
    level = records.groupBy("file", F.floor(F.col("offset") / span).alias("node")).agg(F.sha2(ordered, 256).alias("digest"))
    level = level.select("file", F.lit(0).alias("level"), "node", "digest")
    out = level
    for k in range(1, depth + 1):
        children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda r: F.concat_ws(":", r["node"], r["digest"])), ",")
        level = level.groupBy("file", F.floor(F.col("node") / fanout).alias("node")).agg(F.sha2(children, 256).alias("digest"))
        level = level.select("file", F.lit(k).alias("level"), "node", "digest")
        out = out.unionByName(level)
    return out


def audit(first: DataFrame, second: DataFrame, span: int = 65_536, fanout: int = 16) -> DataFrame:
    """Where two replicas' records differ: ``file, record_id, uri, status, offset, length, digest, other_digest``.

    Both are ``(file, record_id, uri, offset, length, digest)``. Each file's
    records are hashed into a tree over ordered offset ranges. Roots are
    compared first, then only the children of nodes that differ, down to ranges
    of ``span`` bytes, and only these ranges' records are compared: ``corrupt``
    (another digest), ``missing`` or ``extra`` (in one replica only; offset and
    length are those of the replica that has it). A record that is whole but at
    another offset, because something before it is lost, is not a difference.

    Records without an id (damaged stretches) are compared by their place, and
    so are records with the same id, in order. Files that only one replica has
    are missing or extra as a whole. Empty replicas give no rows.
    """
    a, b = cut(first), cut(second)
    end = a.unionByName(b).agg(F.max(F.col("offset")).alias("end")).first()["end"] or 0
    depth, width = 0, span
    while width <= end:
        width, depth = width * fanout, depth + 1
    ta, tb = cut(tree(a, span, fanout, depth)), cut(tree(b, span, fanout, depth))
    differing = None
    for level in range(depth, -1, -1):
        one, two = (t.where(F.col("level") == level).select("file", "node", "digest") for t in (ta, tb))
        if differing is not None:
            parents = differing.withColumnRenamed("node", "parent")
            one, two = (t.withColumn("parent", F.floor(F.col("node") / fanout)).join(parents, ["file", "parent"], "left_semi").drop("parent") for t in (one, two))
        two = two.withColumnRenamed("digest", "other")
        differing = one.join(two, ["file", "node"], "full").where(~F.col("digest").eqNullSafe(F.col("other"))).select("file", "node")
    differing = cut(differing)

    def located(records: DataFrame) -> DataFrame:
        near = records.withColumn("node", F.floor(F.col("offset") / span)).join(differing, ["file", "node"], "left_semi")
        place = F.when(F.col("record_id").isNull(), F.col("offset").cast("string")).otherwise(F.lit(""))
        keyed = near.withColumn("key", F.concat_ws("@", F.coalesce("record_id", F.lit("")), place))
        return keyed.withColumn("nth", F.row_number().over(W.partitionBy("file", "key").orderBy("offset")))

    one, two = located(a), located(b)
    two = two.select("file", "key", "nth", *[F.col(c).alias(f"other_{c}") for c in ("record_id", "uri", "offset", "length", "digest")])
    joined = one.join(two, ["file", "key", "nth"], "full")
    status = F.when(F.col("digest").isNull(), "extra").when(F.col("other_digest").isNull(), "missing").otherwise("corrupt")
    return joined.where(~F.col("digest").eqNullSafe(F.col("other_digest"))).select(
        "file", *[F.coalesce(c, f"other_{c}").alias(c) for c in ("record_id", "uri")], status.alias("status"),
        *[F.coalesce(c, f"other_{c}").alias(c) for c in ("offset", "length")], "digest", "other_digest",
    )
