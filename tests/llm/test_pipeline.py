from __future__ import annotations

from collections import defaultdict

import pytest

import corpus_pipeline
from basketlens.llm import mixing, packing, quality
from basketlens.llm.lengths import encoded_length
from basketlens.llm.queries import ORACLES, QUERIES
from basketlens.sources.landing import land
from tests.llm.brute import jaccard_classes, mixed, packed, redacted
from tests.llm.test_packing import placed

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = land(stage(spark, docs, FOLDER), "stage")
        out.append((name, docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return out


def test_order_and_columns(stages):
    assert [s[0] for s in stages] == [
        "quality classifier", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "best-fit packing",
    ]
    for *_, before, after in stages[:-1]:
        assert before == after == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage(spark, stages):
    _, before, after, *_ = stages[0]
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    scores = quality.fit(docs, labels).score([r.text for r in before])
    assert sorted(after) == sorted(r for r, s in zip(before, scores) if s >= quality.THRESHOLD)
    assert 0 < len(after) < len(before)


def test_duplicates_stage(stages):
    _, before, after, *_ = stages[1]
    firsts = {c for c, _ in jaccard_classes([(r.doc_id, r.text) for r in before]).values()}
    assert sorted(after) == sorted(r for r in before if r.doc_id in firsts)
    assert len(after) < len(before)


def test_secrets_stage(stages):
    _, before, after, *_ = stages[2]
    expected = {r.doc_id: redacted(r.text) for r in before}
    assert {r.doc_id: r.text for r in after} == expected
    assert all(r.n_chars == len(r.text) for r in after)


def test_mixing_stage(stages):
    _, before, after, *_ = stages[3]
    rows = [(r.doc_id, f"domain{int(r.source[3:]) % 4}", r.lang, r.source, encoded_length(r.text)) for r in before]
    chosen = {d for d, _ in mixed(rows, epochs=corpus_pipeline.MIX_EPOCHS)}
    assert sorted(after) == sorted(r for r in before if r.doc_id in chosen)
    total, kept = (sum(encoded_length(r.text) for r in x) for x in (before, after))
    assert kept <= total * mixing.BUDGET_SHARE[0] // mixing.BUDGET_SHARE[1]


def test_packing_stage(stages):
    _, before, after, *_ = stages[4]
    bins = placed(after)
    tokens = defaultdict(int)
    for r in after:
        tokens[r.doc_id] += r.length
    assert tokens == {r.doc_id: encoded_length(r.text) for r in before}
    longest = packing.CAPACITIES[-1]
    rests = sorted((n % longest for n in tokens.values() if n % longest), reverse=True)
    own = sorted((p[0].capacity, sorted(r.length for r in p)) for b, p in bins.items() if not b.startswith("full"))
    assert own == sorted((c, sorted(x)) for c, x in packed(rests))


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(corpus_pipeline.run(spark, FOLDER).collect(), key=str) == sorted(stages[-1][2], key=str)


def test_stages_on_an_empty_table_and_on_odd_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(None, None, None, None, None), (10**6, None, "en", None, 0), (10**6 + 1, "", None, "src1", None),
           (10**6 + 2, "x " * 200_000, "zz", "elsewhere", 4), (0, "two texts of one id, both good.", "en", "src0", 5)]
    odd = spark.createDataFrame(odd, docs.schema)
    for rows in (docs.limit(0), docs.unionByName(odd).unionByName(docs.limit(5))):
        rows = rows.selectExpr("*", "'e' AS epoch", "1 AS score", "'s' AS secret_spans", "2 AS rep")
        for name, stage in corpus_pipeline.STAGES:
            after = land(stage(spark, rows, FOLDER), "stage")
            if name != "best-fit packing":
                assert after.dtypes == rows.dtypes
                assert after.count() <= rows.count()
                rows = after


def test_one_query_for_each_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLES) < set(QUERIES)
