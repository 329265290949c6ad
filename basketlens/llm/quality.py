"""Quality scores by votes of nearest labelled neighbours.

A text is described by its words and by its shape. Words, in lower case, are
counted in ``TERMS`` buckets of a hash, and the logarithms of the counts weighted
by how rare the bucket is among the labelled texts. The shape is how often each
triple of neighbouring character classes (small or capital letter, digit, each
common mark, and so on) occurs, and how many words repeat the word before or an
earlier one, as logarithms. Both are scaled to length 1, the words then to
``TERM_WEIGHT`` times that, as shape tells these corpora's junk best. The latent-semantic
vectors are these descriptions projected on the leading singular vectors of the
labelled sample.
The labelled vectors, ``SAMPLE`` times ``DIMENSIONS`` numbers at most, are
broadcast; every document's cosine to all of them is computed in blocks, and the
``NEIGHBOURS`` nearest vote with their similarity as weight.

Labels come only from rows of the labels table whose key is not held out; the
sample takes those with the lowest hash of their key, however large the table
is. No label, language, source or key is an input of a score.

Defined cases: a null text counts as empty, and empty texts are scored like
others, all alike; a text of any length is described whole; a null or other label than 0 and 1 is no label; a document
labelled twice alike counts once, and labelled both ways with both; with no labelled text at all every score is 0.5;
equally near neighbours are taken in the order of their keys' hash; repeated rows
and rows with a null id (not held out) each keep a row; an empty table gives no
rows. Other columns pass through, and one called as the score gives way to it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.tables import whole

#: Labelled rows that are learnt from, at most; bounds what is broadcast.
SAMPLE = 8192
DIMENSIONS = 32
NEIGHBOURS = 15
#: Votes weigh as the similarity to this power.
SHARPNESS = 8
#: Scores at or above this are taken as good.
THRESHOLD = 0.3
FOLDS = 5
#: Documents whose cosines are computed at once.
BLOCK = 512

_MARKS = b" \n.,!|*#$%&"
_CLASSES = 16
_TRIPLES = _CLASSES**3
_SHAPE = _TRIPLES + 2
#: Buckets of the words, and how long their part of a description is against the shape's.
TERMS = 2048
TERM_WEIGHT = 0.5
WIDTH = _SHAPE + TERMS

_CLASS = np.full(256, _CLASSES - 1, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[128:] = 0
for _i, _c in enumerate(_MARKS):
    _CLASS[_c] = 3 + _i


def _triples(text: str) -> np.ndarray:
    # Two line ends around, so that short texts have triples too.
    classes = _CLASS[np.frombuffer(b"\n\n" + text.encode("utf-8", "replace") + b"\n\n", np.uint8)].astype(np.int16)
    codes = (classes[:-2] * _CLASSES + classes[1:-1]) * _CLASSES + classes[2:]
    return np.bincount(codes, minlength=_TRIPLES)


def counted(texts: list[str]) -> np.ndarray:
    """A row of logarithms of counts for each text: shape first, then words."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for i, text in enumerate(texts):
        out[i, :_TRIPLES] = _triples(text)
        words = text.split()
        out[i, _TRIPLES] = sum(map(str.__eq__, words, words[1:])) if len(words) > 1 else 0
        out[i, _TRIPLES + 1] = len(words) - len(set(words))
        for word, n in Counter(text.lower().split()).items():
            out[i, _SHAPE + crc32(word.encode("utf-8", "replace")) % TERMS] += n
    np.log1p(out, out=out)
    # What repeats shows against the number of words, which the triples' counts follow.
    out[:, _TRIPLES:_SHAPE] *= 2
    return out


def rarity(words: np.ndarray) -> np.ndarray:
    """The weight of each bucket of words, from its counts in the labelled texts."""
    holding = (words > 0).sum(0)
    return np.log((1.0 + len(words)) / (1.0 + holding)).astype(np.float32)


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.maximum(np.sqrt(np.einsum("ij,ij->i", rows, rows)), 1e-9)[:, None]


def scale(rows: np.ndarray, idf: np.ndarray, shape: int = _SHAPE) -> np.ndarray:
    """Turn counts into descriptions, in place; the first ``shape`` columns are the shape's."""
    rows[:, shape:] *= idf
    for part, size in ((rows[:, :shape], 1.0), (rows[:, shape:], TERM_WEIGHT)):
        part *= size / _lengths(part)
    rows /= _lengths(rows)
    return rows


def leading(x: np.ndarray, k: int = DIMENSIONS, spare: int = 16, rounds: int = 12) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start.

    Takes little more room than ``x``. Directions in which ``x`` has nothing are left out.
    """
    width = min(k + spare, x.shape[1])
    basis = np.random.default_rng(0).standard_normal((x.shape[1], width)).astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    seen = (x @ basis).astype(np.float64)
    values, turn = np.linalg.eigh(seen.T @ seen)
    turn = turn[:, ::-1][:, :k][:, values[::-1][:k] > 1e-9 * max(values[-1], 1e-9)]
    return basis @ turn.astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Weights of words, projection, labelled latent vectors of unit length, and their labels."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, texts: list[str]) -> np.ndarray:
        z = scale(counted(texts), self.idf) @ self.projection
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str], neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors."""
        n = len(self.labels)
        if not n:
            return np.full(len(texts), 0.5)
        k, scores = min(neighbours, n), np.empty(len(texts))
        for at in range(0, len(texts), BLOCK):
            cosines = self.latent(texts[at : at + BLOCK]) @ self.vectors.T
            # Nearness in millionths and place in one number: ties go to the earlier vector.
            order = np.rint(cosines * 1e6).astype(np.int64) * n + np.arange(n)[::-1]
            best = np.argpartition(order, n - k, axis=1)[:, n - k :]
            weights = np.maximum(np.take_along_axis(cosines, best, 1), 1e-6).astype(float) ** SHARPNESS
            scores[at : at + BLOCK] = (weights * self.labels[best]).sum(1) / weights.sum(1)
        return np.clip(scores, 0.0, 1.0)


def held_out(key: Column | str = "doc_id") -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
        text: str = "text", sample: int = SAMPLE) -> Model:
    """A model of the labelled documents that are not held out.

    At most ``sample`` labelled texts are described (on the executors); their
    descriptions are what comes to the driver.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("k").isNotNull() & ~held_out("k")
    )
    # More keys than needed, as some may have no document here.
    texts = docs.select(F.col(key).alias("k"), whole(text).alias("text"))
    order = F.xxhash64(F.col("k").cast("string"))
    present = known.join(texts.select("k"), "k", "left_semi")
    # A document labelled twice takes one place.
    chosen = present.dropDuplicates(["k", "label"]).orderBy(order, "k", "label").limit(sample)
    # Two documents of one key both stand for it; the first of them by hash is used.
    one = (
        texts.join(F.broadcast(chosen), "k")
        .withColumn("h", order)
        .groupBy("h", "k", "label").agg(F.min("text").alias("text"))
    )

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at : at + 256]
                rows = counted(part["text"].tolist())
                places = [np.flatnonzero(r).astype(np.uint16) for r in rows]
                yield pd.DataFrame({
                    "h": part["h"], "k": part["k"], "label": part["label"],
                    "places": [p.tobytes() for p in places],
                    "values": [r[p].tobytes() for r, p in zip(rows, places)],
                })

    kind = dict(one.dtypes)["k"]
    schema = f"h bigint, k {kind}, label int, places binary, values binary"
    rows = one.mapInPandas(described, schema).toPandas()
    rows = rows.sort_values(["h", "k", "label"], kind="stable")
    if not len(rows):
        nothing = np.zeros((WIDTH, 1), np.float32)
        return Model(np.zeros(TERMS, np.float32), nothing, np.zeros((0, 1), np.float32), np.zeros(0))
    places = [np.frombuffer(p, np.uint16) for p in rows["places"]]
    used = np.unique(np.concatenate(places))
    x = np.zeros((len(rows), len(used)), np.float32)
    for row, at, values in zip(x, places, rows["values"]):
        row[np.searchsorted(used, at)] = np.frombuffer(values, np.float32)
    shape = int(np.searchsorted(used, _SHAPE))
    # A word that no labelled text has weighs most.
    idf = np.full(TERMS, np.log(1.0 + len(rows)), np.float32)
    idf[used[shape:].astype(int) - _SHAPE] = rarity(x[:, shape:])
    scale(x, idf[used[shape:].astype(int) - _SHAPE], shape)
    vectors = leading(x)
    projection = np.zeros((WIDTH, vectors.shape[1]), np.float32)
    projection[used] = vectors
    z = x @ vectors
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    return Model(idf, projection, z.astype(np.float32), rows["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score for each row; a column already called ``name`` gives way."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(texts.fillna("").tolist()))

    return docs.withColumn(name, scored(F.col(f"`{text}`")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their columns as they are."""
    mark = "__quality_score"
    names = docs.columns
    scored = score(docs, fit(docs, labels), name=mark)
    return scored.where(F.col(mark) >= THRESHOLD).select(*[F.col(f"`{n}`") for n in names])


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"),
    )
