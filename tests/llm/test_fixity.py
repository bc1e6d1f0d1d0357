import glob
import gzip
import hashlib
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from emporium.llm.fixity import _parsed, _segments, audit, read_archive, record_id, tree, warc_record, write_archive


def archive(spark, rows, path, parts=3):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    named = df.select(warc_record(record_id(F.col("page_id"), F.col("url")), F.col("url"), F.col("html")).alias("record"))
    write_archive(named if parts == 1 else named.repartitionByRange(parts, F.col("record")).sortWithinPartitions("record"), path)
    return read_archive(spark, path)


ROWS = [(i, f"http://a.org/{i}", f"<p>{'é' * (i % 50)}\r\n\r\nWARC {i}</p>") for i in range(300)]
ODD = [(None, None, None), (1000, "", ""), (1001, "http://b.org/\nx", "😀" * 5000), (1002, "http://c.org", None)]


def test_round_trip(spark, tmp_dir):
    got = archive(spark, ROWS + ODD, f"{tmp_dir}/a").toPandas()
    assert len(got) == len(ROWS + ODD) and got["record_id"].notna().all()
    for _, g in got.groupby("file"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *(g["offset"] + g["length"]).tolist()[:-1]]


def test_equal_replicas_have_no_difference(spark, tmp_dir):
    a = archive(spark, ROWS, f"{tmp_dir}/a", 1)
    assert audit(a, archive(spark, ROWS, f"{tmp_dir}/b", 1)).count() == 0
    assert audit(a.limit(0), a.limit(0)).count() == 0


@pytest.mark.parametrize("span,fanout", [(65_536, 16), (300, 2), (1, 4)])
def test_damage_is_located(spark, tmp_dir, span, fanout):
    copy = [(i, u, "~" + h[1:] if i in (3, 250) else h) for i, u, h in ROWS if i not in (100, 101)]
    copy.insert(200, (9999, "http://extra.org", "new"))
    a, b = archive(spark, ROWS, f"{tmp_dir}/a", 1), archive(spark, copy, f"{tmp_dir}/b", 1)
    got = {(r.uri, r.status) for r in audit(a, b, span, fanout).collect()}
    assert got == {
        ("http://a.org/3", "corrupt"), ("http://a.org/250", "corrupt"), ("http://a.org/100", "missing"),
        ("http://a.org/101", "missing"), ("http://extra.org", "extra"),
    }


def test_damaged_heads_and_lost_files(spark, tmp_dir):
    a = archive(spark, ROWS[:30], f"{tmp_dir}/a", 1)
    write_archive(spark.createDataFrame([("WARC/1.1\r\nno head at all",), ("WARC/1.1\r\nContent-Length: 5\r\n\r\nhello",)], "record string").coalesce(1), f"{tmp_dir}/b")
    rows = read_archive(spark, f"{tmp_dir}/b").collect()
    assert sum(r.length for r in rows) > 0 and {r.record_id for r in rows} == {None}
    other = a.withColumn("file", F.lit("lost"))
    assert {r.status for r in audit(other, a).collect()} == {"missing", "extra"}


def test_a_tree_has_one_root_for_each_file(spark, tmp_dir):
    nodes = tree(archive(spark, ROWS, f"{tmp_dir}/a"), 1000, 4, 6)
    tops = nodes.where("level = 6").groupBy("file").count().collect()
    assert tops and all(r["count"] == 1 for r in tops)


def test_records_are_brute_force(spark, tmp_dir):
    got = archive(spark, ROWS, f"{tmp_dir}/a").collect()
    want = {}
    for f in glob.glob(f"{tmp_dir}/a/part-*.gz"):
        whole, at = gzip.open(f).read(), 0
        for record in whole.split(b"\r\n\r\nWARC/"):
            record = (record if not at else b"WARC/" + record) + (b"" if record.endswith(b"\r\n\r\n") else b"\r\n\r\n")
            want[os.path.basename(f)[5:10], at] = (len(record), hashlib.sha256(record).hexdigest())
            at += len(record)
        assert at == len(whole)
    assert {(r.file, r.offset): (r.length, r.digest) for r in got} == want


def stored(path, change):
    """Change the bytes of the one stored file of an archive; its local checksum file goes."""
    (name,) = glob.glob(f"{path}/part-*.gz")
    with open(name, "rb") as f:
        data = change(bytearray(f.read()))
    for crc in glob.glob(f"{path}/.part-*.crc"):
        os.remove(crc)
    with open(name, "wb") as f:
        f.write(data)


def flipped(places):
    def change(data):
        for p in places:
            data[int(p * (len(data) - 1))] ^= 0x41
        return data

    return change


@pytest.mark.parametrize("change", [flipped([0.5]), flipped([0.02, 0.9]), flipped([0.0]), flipped([1.0]), lambda d: d[: len(d) // 3], lambda d: d[:9], lambda d: d + b"junk", lambda d: b""])
def test_damage_to_the_stored_file_is_located(spark, tmp_dir, change):
    a = archive(spark, ROWS, f"{tmp_dir}/a", 1)
    archive(spark, ROWS, f"{tmp_dir}/b", 1)
    stored(f"{tmp_dir}/b", change)
    b = read_archive(spark, f"{tmp_dir}/b")
    left, right = ({r.record_id: r.digest for r in x.collect() if r.record_id} for x in (a, b))
    found = audit(a, b).collect()
    told = {r.record_id for r in found if r.status in ("corrupt", "missing")}
    assert {k for k, d in left.items() if right.get(k) != d} <= told
    assert not told & {k for k, d in left.items() if right.get(k) == d}


def test_members_after_a_damaged_one_are_read():
    rnd = random.Random(4)
    records = [f"WARC/1.1\r\nWARC-Record-ID: <{i}>\r\nContent-Length: 200\r\n\r\n{rnd.randbytes(100).hex()}\r\n\r\n".encode() for i in range(20)]
    members = [gzip.compress(r) for r in records]
    whole = b"".join(members)
    (part,) = _parsed([pd.DataFrame({"file": ["f"], "content": [whole]})])
    assert part["record_id"].tolist() == [str(i) for i in range(20)]
    for k in range(1, 19):
        bad = bytearray(members[k])
        bad[len(bad) // 2 :] = b"\xff" * (len(bad) - len(bad) // 2)
        stream = b"".join([*members[:k], bytes(bad), *members[k + 1 :]])
        (part,) = _parsed([pd.DataFrame({"file": ["f"], "content": [stream]})])
        whole_ones = set(part[part["digest"].isin([hashlib.sha256(r).hexdigest() for r in records])]["record_id"])
        assert whole_ones >= {str(i) for i in range(20) if i != k} and str(k) not in whole_ones
        assert part["record_id"].isna().any()
    rnd_bytes = [rnd.randbytes(rnd.randint(0, 3000)) for _ in range(200)]
    for junk in rnd_bytes + [b"\x1f\x8b" + x for x in rnd_bytes] + [b"\x1f\x8b\x08\x1c" + x for x in rnd_bytes]:
        assert sum(len(x) for x, ok in _segments(junk)) > 0 or not junk
        list(_parsed([pd.DataFrame({"file": ["f"], "content": [junk]})]))


def test_files_hold_a_bounded_number_of_records(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    named = df.select(warc_record(record_id(F.col("page_id"), F.col("url")), F.col("url"), F.col("html")).alias("record"))
    write_archive(named, f"{tmp_dir}/a", file_records=100)
    rows = read_archive(spark, f"{tmp_dir}/a")
    assert {r["file"]: r["count"] for r in rows.groupBy("file").count().collect()} == {"00000": 100, "00000-001": 100, "00000-002": 100}
    assert audit(rows, archive(spark, ROWS, f"{tmp_dir}/b", 1)).where("status = 'corrupt'").count() == 0
