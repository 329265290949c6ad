from __future__ import annotations

import math
import random

import numpy as np
import pytest

from basketlens.llm import topk
from tools.check_oracles import differences

SCHEMA = "vec_id bigint, embedding array<float>, label int, score int, id string"


def rows(n, seed=3):
    draw = random.Random(seed)
    return [(i, [draw.uniform(-1, 1) for _ in range(8)], 0, 1, "x") for i in range(n)]


def test_equals_sql_with_nulls_ties_and_other_lengths(given):
    table = rows(120)
    same = table[7][1]
    table += [(i, same, 1, 1, None) for i in range(200, 260)]  # ties
    table += [(300, None, 0, 1, "x"), (350, [], 0, 1, "x"), (None, same, 0, 1, "x")]
    table += [(400, [None, *same[1:]], 0, 1, "x"), (401, [float("nan"), *same[1:]], 0, 1, "x")]
    table += [(402, [float("inf"), *same[1:]], 0, 1, "x"), (450, same[:3], 0, 1, "x"), (451, same[:3], 0, 1, "x")]
    df, con = given("embeddings", table, SCHEMA)
    assert differences(topk.topk_query(df), con, topk.TOPK_SQL) == []


def test_small_tiles_and_tree_give_the_same(given):
    df, _ = given("embeddings", rows(150), SCHEMA)
    vectors = topk.quantised(df)
    queries = vectors.where("id % 10 = 0")
    one = topk.top_k(queries, vectors, 7).collect()
    assert sorted(one) == sorted(topk.top_k(queries, vectors, 7, tile=4).collect())
    assert {r.query_id for r in one} == set(range(0, 150, 10))


def test_empty_table_and_single_row(given):
    df, _ = given("embeddings", rows(1), SCHEMA)
    assert topk.topk_query(df).count() == 0
    assert topk.topk_query(df.limit(0)).count() == 0


def test_repeated_rows_are_candidates_each(given):
    table = rows(3)
    df, _ = given("embeddings", [*table, table[2], table[0]], SCHEMA)
    got = [(r["rank"], r.vec_id) for r in topk.topk_query(df).orderBy("rank").collect()]
    assert sorted(v for _, v in got) == [1, 2, 2] and [r for r, _ in got] == [1, 2, 3]


@pytest.mark.parametrize("size", [1.0, 2.0**10, 2.0**20])
def test_products_are_exact_at_any_size(spark, size):
    table = [(i, [random.Random(i * 9 + j).uniform(-size, size) for j in range(5)], 0, 1, "") for i in range(60)]
    df = spark.createDataFrame(table, SCHEMA)
    vectors = {r.id: [int(x) for x in r.v] for r in topk.quantised(df).collect()}
    assert len(vectors) == 60
    expected = set()
    for q in (0, 50):
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        expected |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)}
    assert {tuple(r) for r in topk.topk_query(df).collect()} == expected


@pytest.mark.parametrize("kind", ["float", "double"])
def test_large_components_stay_and_rank_exactly(spark, kind):
    draw = random.Random(8)
    sizes = [1.0, 1e7, 1e18, 1e30] if kind == "float" else [1.0, 1e7, 1e30, 1e200]
    table = [
        (i, [float(np.float32(draw.uniform(-1, 1) * draw.choice(sizes[:2 + i % 3]))) if kind == "float"
             else draw.uniform(-1, 1) * draw.choice(sizes[:2 + i % 3]) for _ in range(6)], 0, 1, "")
        for i in range(120)
    ]
    table += [(200 + i, table[3][1], 0, 1, "") for i in range(5)] + [(0, [1e7] * 6, 0, 1, "")]
    df = spark.createDataFrame(table, SCHEMA.replace("array<float>", f"array<{kind}>")).repartition(3)

    def whole(x):
        return math.floor(256 * x) if abs(256 * x) < 2**53 else int(256 * x)

    vectors = [(i, [whole(x) for x in v]) for i, v, *_ in table]
    expected = []
    for q, a in vectors:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in vectors if i != q)
            expected += [
                (q, rank, i, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, i) in enumerate(scored[:5], 1)
            ]
    got = [tuple(r) for r in topk.topk_query(df).collect()]
    assert sorted(got) == sorted(expected)
    small = [tuple(r) for r in topk.top_k(
        topk.quantised(df).where("id % 50 = 0"), topk.quantised(df), 5, tile=7).select("query_id", "rank", "id", "score").collect()]
    assert sorted(small) == sorted(expected)


def test_products_beyond_64_bits():
    a = np.array([[2.0**100, 1.0], [3.0, 4.0], [2.0**40, -5.0]])
    b = np.array([[1.0, 2.0], [2.0**100, 2.0**60]])
    want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.tolist()] for r in a.tolist()]
    assert topk._products(a, b).tolist() == want
    keys = [2**300, 2**299, 2**62 + 1, 2**62]
    assert [topk._beyond(k) for k in keys] == sorted(topk._beyond(k) for k in keys)
    assert [topk._beyond(-k) for k in keys[::-1]] == sorted(topk._beyond(-k) for k in keys)
    assert topk._beyond(5) == topk._beyond(1 - 2**62) == ""


def test_selection_where_scores_leave_no_room_for_places():
    scores = np.array([[2**61, -(2**61), 2**61, 5, 2**61]])
    (best,) = topk._best(scores, np.array([[True, False, False, False, False]]), 3)
    assert best.tolist() == [2, 4, 3]
