from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from basketlens.llm import packing
from basketlens.llm.lengths import encoded_length
from tests.llm.brute import packed

SCHEMA = "doc_id bigint, text string, bin string, capacity int, key string"


def placed(rows, capacities=packing.CAPACITIES):
    """Checks that pieces lie side by side in bins; gives the bins."""
    bins = defaultdict(list)
    for r in rows:
        if r.bin is not None:
            bins[r.bin].append(r)
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.place):
            assert r.place == at and r.length > 0
            at += r.length
        (capacity,) = {r.capacity for r in pieces}
        assert capacity == min(c for c in capacities if c >= at)
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_pack_equals_trying_every_bin(seed):
    draw = random.Random(seed)
    lengths = sorted((draw.choice([draw.randint(1, 4096), draw.randint(1, 600)]) for _ in range(400)), reverse=True)
    bins, starts, sizes = packing.pack(np.array(lengths, np.int64))
    got = defaultdict(list)
    for b, start, n in zip(bins, starts, lengths):
        assert start == sum(got[b])
        got[b].append(n)
    assert [(int(sizes[b]), got[b]) for b in sorted(got)] == packed(lengths)


def test_every_token_has_one_place(spark):
    draw = random.Random(3)
    texts = [" ".join(["w"] * draw.choice([3, 50, 700, 4096, 9001, 20_000])) for _ in range(60)]
    rows = [(i, t, "x", 1, "k") for i, t in enumerate(texts)]
    rows += [(90, None, "x", 1, "k"), (91, "", "x", 1, "k"), (None, "a b", "x", 1, "k"), (None, "a b", "x", 1, "k")]
    rows += [(5, texts[5], "x", 1, "k")] * 3
    got = packing.packing_query(spark.createDataFrame(rows, SCHEMA)).collect()
    placed(got)
    held = defaultdict(list)
    for r in got:
        held[r.doc_id].append((r.piece, r.start, r.length))
    for i, text in enumerate(texts):
        times = 4 if i == 5 else 1
        n = encoded_length(text)
        expected = [(p, p * 4096, min(4096, n - p * 4096)) for p in range(-(-n // 4096))]
        assert sorted(held[i]) == sorted(expected * times)
    assert held[90] == held[91] == [(0, 0, 0)]
    assert held[None] == [(0, 0, 2)] * 2


def test_shards_are_bounded_and_result_does_not_depend_on_partitions(spark):
    rows = [(i, " ".join(["w"] * (i % 90 + 1)), "", 0, "") for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "size(split(text, ' ')) AS n")
    results = [sorted(packing.best_fit(df.repartition(p), "n", shard_pieces=100).collect()) for p in (1, 4)]
    assert results[0] == results[1]
    assert len({r.bin.split("-")[0] for r in results[0]}) == 5
    placed(results[0])


def test_repeated_row_does_not_fill_one_shard(spark):
    df = spark.range(600).selectExpr("CAST(7 AS BIGINT) AS doc_id", "10 AS n")
    rows = packing.best_fit(df, "n", shard_pieces=100).collect()
    assert len(rows) == 600 and len({r.bin.split("-")[0] for r in rows}) == 6


def test_unspaced_text_is_cut(spark):
    rows = [(1, "中文没有空格" * 9000, "", 0, ""), (2, "x" * 50_000, "", 0, ""), (3, "a" + " " * 600_000 + "b", "", 0, "")]
    got = packing.packing_query(spark.createDataFrame(rows, SCHEMA)).collect()
    for doc, text, *_ in rows:
        lengths = [r.length for r in got if r.doc_id == doc]
        assert sum(lengths) == encoded_length(text) and max(lengths) == 4096


def test_no_bin_holds_more_than_its_length(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.packing_query(docs).collect()
    held, room = defaultdict(int), {}
    for r in rows:
        if r.bin is not None:
            held[r.bin] += r.length
            room[r.bin] = r.capacity
    assert all(held[b] <= room[b] for b in held)
    assert sum(held.values()) == sum(map(encoded_length, texts.values()))


def test_empty_table(spark):
    assert packing.packing_query(spark.createDataFrame([], SCHEMA)).count() == 0
