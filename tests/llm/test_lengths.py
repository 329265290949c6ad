from __future__ import annotations

from collections import defaultdict

import pytest

from basketlens.llm import lengths

SCHEMA = "doc_id bigint, text string, length int, n_docs string, span int"


@pytest.fixture(scope="module")
def texts():
    made = ["word " * (i % 40) + "é日本!! 123" * (i % 3) for i in range(200)]
    return [*made, None, "", "<|endoftext|>", "a b c " * 30_000, "x" * 5000]


def test_every_limit_and_quantile(spark, texts):
    df = spark.createDataFrame([(i, t, 1, "", 2) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    n = sorted(lengths.encoded_length(t) for t in texts)
    sums = lengths.suffix_sums(lengths.length_histogram(df)).cache()
    got = {r.length: tuple(r)[1:] for r in sums.collect()}
    assert got == {
        x: (n.count(x), sum(y >= x for y in n), sum(y for y in n if y >= x), sum(y <= x for y in n), sum(min(x, y) for y in n))
        for x in set(n)
    }
    limits = [0, 1, 7, 100, 4096, 10**7]
    assert [tuple(r) for r in lengths.at_limits(sums, limits).collect()] == [
        (x, sum(y >= x for y in n), sum(y for y in n if y >= x), sum(min(x, y) for y in n)) for x in limits
    ]
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    expected = {q: n[max(0, -int(-len(n) * q // 1) - 1)] for q in shares}
    assert {r.share: r.length for r in lengths.quantiles(sums, shares).collect()} == expected
    sums.unpersist()
    lines = defaultdict(dict)
    for r in lengths.lengths_query(df).collect():
        lines[r.kind][r.share if r.kind == "quantile" else r.length] = r
    assert {x: tuple(r)[1:6] for x, r in lines["length"].items()} == got
    assert {x: (r.docs_at_least, r.truncated_total) for x, r in lines["limit"].items()} == {
        x: (sum(y >= x for y in n), sum(min(x, y) for y in n)) for x in lengths.LIMITS
    }
    assert {q: r.length for q, r in lines["quantile"].items()} == {
        q: n[max(0, -int(-len(n) * q // 1) - 1)] for q in lengths.SHARES
    }


def test_special_strings_are_ordinary_text():
    assert lengths.encoded_length("<|endoftext|>") > 1
    assert lengths.encoded_length(None) == lengths.encoded_length("") == 0
    assert lengths.encoded_length("hello world") == 2


SPACES = [" ", "\n", "\t", "\u3000", "\u00a0", " \n", "\n ", "\x85\u2028"]


@pytest.mark.parametrize("before", ["", "word", "word,", "1"])
@pytest.mark.parametrize("after", ["", "word", "'s", "1", ",", "\x1c"])
def test_cut_runs_count_as_plain_encoding_does(monkeypatch, before, after):
    cut = lengths.re.compile(f"(?<![{lengths.SPACES}])[{lengths.SPACES}]{{5,}}")
    for space in SPACES:
        for n in (1, 4, 5, 6, 40, 2000):
            text = f"{before}{space * n}{after} and {space * 7}{after}"
            plain = len(lengths.encoder(lengths.RANKS).encode_ordinary(text))
            with monkeypatch.context() as m:
                m.setattr(lengths, "_RUNS", cut)
                assert lengths.encoded_length(text) == plain, (text, n)


@pytest.mark.parametrize("space", [" ", "\n", " \n"])
def test_runs_of_millions(space):
    for n in (10**6, 10**7 // len(space)):
        for text in (f"x{space * n}x", space * n, f"{space * n}x", f"x{space * n}"):
            assert lengths.encoded_length(text) >= n // 200
    # By its parts: what comes before, the run but its last space, and what comes after.
    one = lengths.encoded_length("x") + lengths.encoded_length(" " * 999_999) + lengths.encoded_length(" x")
    assert lengths.encoded_length("x" + " " * 10**6 + "x") == one


def test_a_text_with_a_long_run_in_a_query(spark):
    df = spark.createDataFrame([(1, "x" + " " * 10**6 + "x", 1, "", 1), (2, "x", 1, "", 1)], SCHEMA)
    assert lengths.lengths_query(df).where("kind = 'length'").count() == 2


def test_empty_table(spark):
    sums = lengths.suffix_sums(lengths.length_histogram(spark.createDataFrame([], SCHEMA)))
    assert sums.count() == 0
    assert [tuple(r) for r in lengths.at_limits(sums, [5]).collect()] == [(5, 0, 0, 0)]
    assert [tuple(r) for r in lengths.quantiles(sums, [0.5]).collect()] == [(0.5, None)]
    assert lengths.lengths_query(spark.createDataFrame([], SCHEMA)).where("kind = 'length'").count() == 0
