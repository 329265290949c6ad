from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from basketlens.llm import resampling
from tools.check_oracles import differences

DOCS = "doc_id bigint, text string, weight string, rank int, n_words int"
ITEMS = "item_id bigint, text string, bucket int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def plain(docs, items):
    s = Counter(bucket(f) for _, t in docs for f in grams(t)[1])
    t = Counter(bucket(f) for x in items for f in grams(x)[1])
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1.0) * (s.total() + 10_000.0) / ((s[b] + 1.0) * (t.total() + 10_000.0))))
        for b in range(10_000)
    }
    rows = []
    for doc, text in docs:
        words, features = grams(text)
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(words), len(features), weight, score))
    able = sorted(
        (r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3])
    )
    drawn = [(*r[:1], *r[2:], i + 1 if i < 25 * len(able) // 100 else None) for i, r in enumerate(able)]
    return sorted(drawn + [(*r[:1], *r[2:], None) for r in rows if r[1] < 20], key=repr)


def result(spark, docs, items):
    d = spark.createDataFrame([(*x, "w", 1, 2) for x in docs], DOCS).repartition(4)
    b = spark.createDataFrame([(1, x, 3) for x in items], ITEMS)
    rows = resampling.resampling_query(d, b).select("doc_id", "n_features", "weight", "score", "rank").collect()
    return sorted(map(tuple, rows), key=repr)


def corpus():
    english = [(i, " ".join(f"the word{j % 7} of A{i % 5}" for j in range(i % 9 + 4))) for i in range(60)]
    odd = [
        (100, None), (101, ""), (102, "?!-\x00 \x7f"), (103, "ÉTÉ été Straße naïve " * 8), (104, "a" * 3000),
        (None, "null id the word1 of " * 6), (None, "null id the word1 of " * 6), (105, "中文没有空格" * 50),
        (106, "MiXeD the CASE of " * 9), (107, "x1 2y-3z_" * 30),
    ]
    return english + odd + [english[50]] * 3 + [(50, "the same id, another text of " * 5)]


ITEMS_TEXTS = ["the word1 of target", "word2 of the Target; été", None, ""]


def test_equals_a_plain_computation(spark):
    assert result(spark, corpus(), ITEMS_TEXTS) == plain(corpus(), ITEMS_TEXTS)


def test_equals_sql(given):
    docs, con = given("documents", [(*x, "w", 1, 2) for x in corpus()], DOCS)
    con2 = given("benchmark", [(1, x, 3) for x in ITEMS_TEXTS], ITEMS)
    assert differences(resampling.resampling_query(docs, con2[0]), con, resampling.RESAMPLING_SQL) == []


def test_empty_tables(spark):
    assert result(spark, [], ITEMS_TEXTS) == []
    docs = corpus()[:30]
    assert result(spark, docs, []) == plain(docs, [])


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_runs_do_not_depend_on_pieces(order, piece):
    data = ("One two, three-four ÉÉ " + "five" * 30 + "  six ").encode() * 3
    words = WORD.findall(data.decode().lower().replace("é", "É"))
    want = Counter(
        zlib.crc32(" ".join(words[i : i + n]).encode()) for n in range(1, order + 1) for i in range(len(words) - n + 1)
    )
    assert Counter(v for _, values in resampling.runs(data, order, piece) for v in values) == want


def test_a_target_draws_its_like(spark):
    docs = [(i, ("alpha beta gamma " if i % 4 else "rare words here ") * 10) for i in range(200)]
    rows = result(spark, docs, ["rare words here " * 20])
    drawn = [r[0] for r in rows if r[4] is not None]
    assert len(drawn) == 50 and sum(d % 4 == 0 for d in drawn) > 40


def test_ranks_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(resampling, "RANGE_ROWS", 9)
    assert result(spark, corpus(), ITEMS_TEXTS) == plain(corpus(), ITEMS_TEXTS)


def test_a_long_text(spark):
    docs = [(1, "word " * 600_000 + "end"), (2, "-" * 3_000_000), (3, "z" * 3_000_000)]
    assert result(spark, docs, ["word end"]) == plain(docs, ["word end"])
