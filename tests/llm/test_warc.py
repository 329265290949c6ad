from __future__ import annotations

import gzip
import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from basketlens.llm import warc
from basketlens.sources.landing import new_path
from tools.check_oracles import differences

SCHEMA = "page_id bigint, url string, html string, shard int, kind string"


def pages():
    long = "<p>" + "é" * 600
    rows = [(i, f"http://h/{i} x\r\nInjected: y", f"<p>{i}</p>" * (i % 90 + 1), 9, "z") for i in range(60)]
    rows += [(100 + i, "http://same", long, 9, "z") for i in range(7)]
    rows += [(200, None, None, 9, "z"), (201, "", "", 9, "z"), (202, "u", "short", 9, "z"), (203, "u", "short", 9, "z")]
    rows += [(None, "v", "w" * 1500, 9, "z")] * 3 + [(103, "http://same", long, 9, "z"), (None, "n", long, 9, "z")]
    return rows + [(-5, "u", "a\r\n\r\nWARC/1.1\r\n" * 90, 9, None)]


def test_equals_sql(given):
    df, con = given("pages", pages(), SCHEMA)
    assert differences(warc.warc_query(df), con, warc.WARC_SQL) == []


def test_round_trip_and_rolled_files(spark):
    whole = [p for p in pages() if p[0] is not None][:-2] + pages()[-1:]
    df = spark.createDataFrame(whole, SCHEMA)
    folder = new_path(spark, "archive")
    manifest = warc.write(df, folder, file_bytes=2000, shard_rows=20)
    files = manifest.orderBy("file").collect()
    assert len(files) > 5 and {f.shard for f in files} == {0, 1, 2, 3}
    for f in files:
        content = open(f.file, "rb").read()
        assert (len(content), hashlib.sha256(content).hexdigest()) == (f.bytes, f.sha256)
        assert gzip.decompress(content).count(b"WARC/1.1\r\nWARC-Type: ") == f.records
    found = {r.page_id: r for r in warc.read(manifest).collect()}
    for page_id, _, html, *_ in whole:
        r = found[page_id]
        source = found[r.refers_to] if r.record_type == "revisit" else r
        assert source.payload == (html or "").encode() and source.record_type == "response"
    # In order of ids, over the files in order.
    ids = [r.page_id for f in files for r in warc.read(manifest.where(manifest.file == f.file)).collect()]
    assert ids == sorted(ids)
    assert found[200].url is None and "\n" not in found[3].url


def test_bytes_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(pages(), SCHEMA)
    sums = [
        [r.sha256 for r in warc.write(df.repartition(n), new_path(spark, "archive"), shard_rows=20)
         .orderBy("shard", "number").collect()]
        for n in (1, 5)
    ]
    assert sums[0] == sums[1]


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "t" * 2000
    rows = [(1, "u", text), (1, "u", text), (None, "u", text), (None, "v", "w" * 1500), (None, "v", "w" * 1500)]
    df = spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)
    got = sorted(str((r.page_id, r.record_type, r.refers_to)) for r in warc.warc_query(df).collect())
    assert got == sorted(map(str, [
        (1, "response", None), (1, "revisit", 1), (None, "revisit", 1), (None, "response", None), (None, "revisit", None),
    ]))
    assert warc.warc_query(df.limit(0)).count() == 0


def test_files_of_lost_attempts_are_not_read_and_a_commit_can_be_repeated(spark):
    df = spark.createDataFrame(pages(), SCHEMA)
    folder = new_path(spark, "archive")
    first = warc.write(df, folder)
    files = sorted(first.collect())
    with open(f"{folder}/pages-00077-00000.warc.gz", "wb") as stray:
        stray.write(b"half a file")
    assert warc.read(first).count() == len(pages())
    # Names from before the commit lead to the same files.
    parts = spark.createDataFrame(
        [(f"{folder}/_temporary/gone/{os.path.basename(r.file)}", *r[1:]) for r in files], warc.MANIFEST
    )
    other = f"{folder}/again"
    os.makedirs(other)
    with pytest.raises(Exception, match="neither"):
        warc.commit(spark, parts, other)
    assert sorted(warc.commit(spark, parts, folder).collect()) == files


@pytest.mark.parametrize("change", [b"WARC-Block-Digest: sha1:AAAA", b"Content-Length: 1"])
def test_damaged_records_are_noticed(change):
    content = warc.record(1, "u", b"payload", None)
    name = change.split(b":")[0]
    start = content.rindex(name, 0, content.index(b"\r\n\r\n"))
    damaged = content[:start] + change + content[content.index(b"\r\n", start):]
    with pytest.raises(ValueError):
        warc.parsed(damaged)
    assert warc.parsed(content)["payload"] == b"payload"


def test_place_by_bisection(spark):
    edges = [3, 7, 8, 20, 100]
    df = spark.createDataFrame([(i,) for i in [None, *range(-2, 110)]], "key bigint")
    for n in range(6):
        got = df.select("key", warc._place(edges[:n], F.col("key")).alias("p")).collect()
        assert all(r.p == sum(e <= r.key for e in edges[:n]) if r.key is not None else r.p == 0 for r in got)


def test_many_ranges_take_time_by_their_logarithm(spark):
    edges = list(range(0, 400_000, 20))
    start = time.perf_counter()
    df = spark.range(400_000).select(warc._place(edges, F.col("id")).alias("p"), "id")
    assert df.where(F.col("p") != F.floor(F.col("id") / 20) + 1).count() == 0
    assert time.perf_counter() - start < 30


def test_shards_follow_the_bytes(spark):
    rows = [(i, "u", ("x" if i < 50 else "y" * 200_000) + str(i), 0, "") for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    manifest = warc.write(df, new_path(spark, "archive"), shard_rows=100)
    # 30 pages weigh 25 each, 50 weigh 1.
    assert manifest.count() == 8
    records = [r.records - 1 for r in manifest.orderBy("shard").collect()]
    assert sum(records) == 80 and max(records) <= 56 and max(records[1:]) <= 5


@pytest.mark.parametrize("path,kind,inner", [
    ("/a/b", "local", "/a/b"), ("file:/a/b", "local", "/a/b"), ("file:///a/b", "local", "/a/b"),
    ("dbfs:/x", "local", "/dbfs/x"), ("a/b:c", "local", "a/b:c"),
])
def test_paths(path, kind, inner):
    system, found = warc.opened(path)
    assert system.type_name == kind and found == inner


def test_other_schemes_are_an_error():
    with pytest.raises(Exception, match="[Uu]nrecognized|nknown"):
        warc.opened("odd://x/y")
