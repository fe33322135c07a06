"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of hashed words, token shapes, pairs of shapes and immediate repetitions; weighted by inverse
document frequency and projected on the leading singular directions of the labelled texts. Every document is compared
with all labelled vectors by exact cosine products in blocks, and its nearest labelled neighbours vote, weighted by
similarity.

Learning reads whole texts of a bounded number of labelled rows and counts their features on the executors; the driver
gets the counts.

Defined results: a null or empty text has no direction and gets the labels' mean; texts of any length are counted whole;
neighbours tied with the last one all vote; repeated rows score alike; a column of the input named like an output stays,
and the output is called ``score_`` or ``predicted_``; an empty table gives an empty result; with no labelled row every
score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterframe.llm.common import append_columns, bounded_batches, is_set, labelled_texts

WORDS, SHAPES = 2048, 1024
#: Words, shapes, pairs of shapes, repetitions of the last word and of the one before it.
DIMS = WORDS + SHAPES + SHAPES + 2
BLOCK = 128


@dataclass(frozen=True)
class QualityModel:
    projection: np.ndarray  # (DIMS, rank), weighted by idf
    vectors: np.ndarray  # (labelled, rank), unit length
    labels: np.ndarray
    prior: float
    neighbours: int


class _Tokens(dict):
    """Token -> (word hash << 20 | shape bucket)."""

    def __missing__(self, token: str) -> int:
        if len(self) > 200_000:
            self.clear()
        if token.isalpha():
            shape = "x" if token.islower() else "X" if token.isupper() and len(token) > 1 else "Xx"
        else:
            shape = re.sub(r"[^\W\d_]+", lambda m: "X" if len(m[0]) > 1 and m[0].isupper() else "Xx" if m[0][0].isupper() else "x", token)
            shape = re.sub(r"(.)\1+", r"\1\1", re.sub(r"\d+", "9", shape))[:12]
        word = crc32(token.lower().encode("utf-8", "surrogatepass"))
        self[token] = word << 20 | crc32(shape.encode("utf-8", "surrogatepass")) % SHAPES
        return self[token]


def count_features(texts: list[str | None], tokens: dict[str, int]) -> np.ndarray:
    """log(1 + count) of each feature, a row per text."""
    out = np.zeros((len(texts), DIMS), dtype=np.float32)
    for i, text in enumerate(texts):
        parts = (text or "").split()
        if not parts:
            continue
        x = np.fromiter(map(tokens.__getitem__, parts), dtype=np.int64, count=len(parts))
        word, shape = x >> 20, x & (SHAPES - 1)
        row = np.bincount(word % WORDS, minlength=DIMS)
        row[WORDS : WORDS + SHAPES] = np.bincount(shape, minlength=SHAPES)
        row[WORDS + SHAPES : -2] = np.bincount((shape[:-1] * 31 + shape[1:]) % SHAPES, minlength=SHAPES)
        # shares, on the scale of the other counts
        row[-2] = 400 * np.count_nonzero(word[1:] == word[:-1]) // len(parts)
        row[-1] = 400 * np.count_nonzero(word[2:] == word[:-2]) // len(parts)
        out[i] = np.log1p(row)
    return out


def sample_features(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and label of each sampled text that has a token; the texts are counted on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens()
        for batch in batches:
            x = count_features(batch.column("text").to_pylist(), tokens)
            at = [np.flatnonzero(row) for row in x]
            found = [pa.array([a.tolist() for a in at], pa.list_(pa.int32())), pa.array([row[a].tolist() for row, a in zip(x, at, strict=True)], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *found], names=["label", "at", "value"])

    got = sample.mapInArrow(run, "label int, at array<int>, value array<float>").where(F.size("at") > 0).toArrow()
    x = np.zeros((len(got), DIMS), dtype=np.float32)
    flat = lambda c: got.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if len(got):
        x[np.repeat(np.arange(len(got)), got.column("at").combine_chunks().value_lengths().to_numpy()), flat("at")] = flat("value")
    # the same rows in the same order, whatever the order of tasks
    labels = got.column("label").to_numpy().astype(np.float32)
    order = np.lexsort((*x[:, :: DIMS // 60].T, x.sum(axis=1), labels))
    return x[order], labels[order]


def train(x: np.ndarray, labels: np.ndarray, *, rank: int = 48, neighbours: int = 15) -> QualityModel:
    if not len(x):
        return QualityModel(np.zeros((DIMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5, neighbours)
    idf = np.log((1 + len(x)) / (1 + np.count_nonzero(x, axis=0))) + 0.2
    x = x * idf.astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    # leading eigenvectors of the smaller Gram matrix are the singular directions
    rank = min(rank, len(x), DIMS)
    if len(x) <= DIMS:
        values, left = np.linalg.eigh(x @ x.T)
        left, values = left[:, -rank:], np.sqrt(np.maximum(values[-rank:], 1e-9))
        right = (x.T @ left) / values
    else:
        right = np.linalg.eigh(x.T @ x)[1][:, -rank:]
    vectors = x @ right
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    projection = (idf[:, None] * right).astype(np.float32)
    return QualityModel(projection, vectors.astype(np.float32), labels, float(labels.mean()), neighbours)


class Voter:
    def __init__(self, model: QualityModel):
        self.model, self.tokens = model, _Tokens()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        m, scores = self.model, np.empty(len(texts))
        k = min(m.neighbours, len(m.labels))
        for lo in range(0, len(texts), BLOCK):
            q = count_features(texts[lo : lo + BLOCK], self.tokens) @ m.projection
            norm = np.linalg.norm(q, axis=1)
            score = np.full(len(q), m.prior)
            if k:
                cosine = (q / np.maximum(norm, 1e-9)[:, None]) @ m.vectors.T
                last = np.partition(cosine, -k, axis=1)[:, [-k]]
                vote = np.where(cosine >= last, np.maximum(cosine, 1e-6) ** 4, 0)
                score = np.where(norm > 1e-9, (vote * m.labels).sum(axis=1) / vote.sum(axis=1), m.prior)
            scores[lo : lo + BLOCK] = np.clip(score, 0, 1)
        return scores, (scores >= 0.5).astype(np.int32)


def score_documents(df: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= 0.5)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # DIMS x rank and the bounded sample x rank floats
    return append_columns(df, [("score", "double"), ("predicted", "int")], text_col, lambda: Voter(shared.value))


def fit(docs: DataFrame, labels: DataFrame, *, learn: Column | None = None, label: str = "quality", per_class: int = 1500) -> QualityModel:
    """Learns from the whole texts of at most ``per_class`` documents of each label."""
    bounded_batches(docs.sparkSession)
    learn = F.lit(True) if learn is None else learn
    sample = labelled_texts(docs, labels, label, learn=learn, per_class=per_class, max_rows=2 * per_class)
    return train(*sample_features(sample.select(is_set(F.col("label")).alias("label"), "text")))
