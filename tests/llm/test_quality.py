from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import quality

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, score int, quality string, k int"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    rows = quality.quality_query(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert (good >= quality.THRESHOLD).mean() > 0.98
    assert (bad < quality.THRESHOLD).mean() > 0.8
    for r in rows:
        assert zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.predicted == (r.score >= 0.3)


def made(n=80):
    texts = [("Good text, with words %d. " % i) * 5 if i % 3 else ("BAD!! ###%d " % i) * 9 for i in range(n)]
    return [(i, t, 1, "q", 0) for i, t in enumerate(texts)], [(i, int(i % 3 > 0), 0, "x") for i in range(n)]


def test_scores_equal_plain_votes(spark):
    rows, labels = made()
    docs = spark.createDataFrame(rows, SCHEMA)
    model = quality.fit(docs, spark.createDataFrame(labels, LABELS))
    learnt = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5]
    assert len(model.labels) == len(learnt)
    texts = [r[1] for r in rows] + ["", "x"]
    got = quality.score(docs, model).orderBy("doc_id").collect()
    assert got[0].quality == "q"
    latent = model.latent(texts)
    for z, s in zip(latent, model.score(texts)):
        cosines = [float(z @ v) for v in model.vectors]
        order = sorted(range(len(cosines)), key=lambda i: (-round(cosines[i] * 1e6), i))[: quality.NEIGHBOURS]
        weights = [max(cosines[i], 1e-6) ** quality.SHARPNESS for i in order]
        share = sum(w for w, i in zip(weights, order) if model.labels[i] == 1) / sum(weights)
        assert s == pytest.approx(share, abs=1e-5)
    assert [r.score for r in got] == pytest.approx(model.score(texts[:-2]).tolist())


def test_held_out_labels_ids_and_columns_do_not_matter(spark):
    rows, labels = made()
    other = [(i, (1 - q) if zlib.crc32(str(i).encode()) % 5 == 0 else q, t, x) for i, q, t, x in labels]
    docs = spark.createDataFrame(rows, SCHEMA)
    one, two = (
        quality.fit(docs, spark.createDataFrame(x, LABELS)).score([r[1] for r in rows]) for x in (labels, other)
    )
    assert (one == two).all()


def test_sample_is_bounded_and_does_not_depend_on_partitions(spark):
    rows, labels = made()
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    models = [quality.fit(docs.repartition(n), known.repartition(n), sample=20) for n in (1, 5)]
    assert len(models[0].labels) == 20
    assert (models[0].labels == models[1].labels).all()
    assert np.allclose(abs(models[0].vectors), abs(models[1].vectors), atol=1e-4)


def test_repeated_labels_take_one_place_in_the_sample(spark):
    rows, labels = made()
    docs = spark.createDataFrame(rows, SCHEMA)
    once, often = (
        quality.fit(docs, spark.createDataFrame(x, LABELS), sample=20)
        for x in (labels, labels * 2 + [x for x in labels if x[0] % 3 == 1] * 9)
    )
    assert len(often.labels) == 20
    assert (once.labels == often.labels).all()
    assert np.allclose(abs(once.vectors), abs(often.vectors), atol=1e-4)


def test_odd_rows_and_tables(spark):
    rows, labels = made()
    odd = [(500, None, 0, "", 0), (501, "", 0, "", 0), (None, "some text", 0, "", 0), (None, None, 0, "", 0), (3, rows[3][1], 0, "", 0)]
    odd.append((502, "long " * 200_000, 0, "", 0))
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    known = spark.createDataFrame(labels + [(1, None, 0, ""), (None, 1, 0, ""), (2, 7, 0, ""), (4, 0, 0, ""), (9999, 1, 0, "")], LABELS)
    got = quality.quality_query(docs, known).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    empty = {r.score for r in got if r.doc_id in (500, 501)}
    assert len(empty) == 1
    kept = quality.keep_good(docs, known)
    assert kept.columns == docs.columns
    bad = {i for i, q, *_ in labels if q == 0} - {4}
    assert not bad & {r.doc_id for r in kept.collect()}
    none = quality.quality_query(docs, known.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality.quality_query(docs.limit(0), known).count() == 0
    assert docs.select(quality.held_out().alias("h")).where(F.col("h").isNull()).count() == 0


def test_descriptions_equal_a_plain_computation():
    texts = ["The cat sat. The cat!", "a dog, 12 dogs", "", "cat cat CAT"]
    rows = quality.counted(texts)
    idf = quality.rarity(rows[:, quality._SHAPE:])
    for text, row, full in zip(texts, rows, quality.scale(rows.copy(), idf)):
        counts = {}
        for w in text.lower().split():
            b = zlib.crc32(w.encode()) % quality.TERMS
            counts[b] = counts.get(b, 0) + 1
        held = {b: sum(any(zlib.crc32(w.encode()) % quality.TERMS == b for w in t.lower().split()) for t in texts) for b in counts}
        words = {b: math.log1p(n) * math.log(5 / (1 + held[b])) for b, n in counts.items()}
        size = math.sqrt(sum(x * x for x in words.values())) or 1.0
        shape = row[: quality._SHAPE] / np.linalg.norm(row[: quality._SHAPE])
        whole = math.sqrt(1 + (quality.TERM_WEIGHT**2 if any(words.values()) else 0))
        assert np.allclose(full[: quality._SHAPE], shape / whole, atol=1e-5)
        for b, x in words.items():
            assert full[quality._SHAPE + b] == pytest.approx(x / size * quality.TERM_WEIGHT / whole, abs=1e-5)
        assert np.count_nonzero(full[quality._SHAPE:]) <= len(words)


def test_projection_holds_the_leading_singular_vectors(spark):
    rows, labels = made()
    docs = spark.createDataFrame(rows, SCHEMA)
    model = quality.fit(docs, spark.createDataFrame(labels, LABELS))
    learnt = [t for (i, t, *_) in rows if zlib.crc32(str(i).encode()) % 5]
    counts = quality.counted(learnt)
    assert np.allclose(model.idf, quality.rarity(counts[:, quality._SHAPE:]), atol=1e-6)
    x = quality.scale(counts, model.idf).astype(float)
    _, values, right = np.linalg.svd(x, full_matrices=False)
    # The same space, whatever the signs and the order of equal values.
    k = 4
    assert values[k - 1] > values[k] * 1.0001
    mine = model.projection[:, :k].astype(float)
    assert np.allclose(mine @ mine.T, right[:k].T @ right[:k], atol=1e-3)


def test_words_tell_texts_of_one_shape_apart(spark):
    rows, labels = made()
    extra = [(1000 + i, f"{a} of the {b} saw my {c}. " * 30, 0, "", 0) for i, (a, b, c) in enumerate(
        [("king", "town", "dogs"), ("boat", "lake", "fish"), ("road", "hill", "cart"), ("song", "hall", "drum")] * 6)]
    more = [(1000 + i, i % 4 // 2, 0, "x") for i in range(24)]
    docs = spark.createDataFrame(rows + extra, SCHEMA)
    model = quality.fit(docs, spark.createDataFrame(labels + more, LABELS))
    a, b, c = model.latent([extra[0][1], extra[2][1], extra[0][1] * 2])
    assert a @ b < 0.95 and a @ c > 0.97
    scores = model.score([extra[0][1], extra[2][1]])
    assert scores[0] < 0.3 < 0.6 < scores[1]
