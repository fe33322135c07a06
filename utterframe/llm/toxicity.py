"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability from a logistic model over its words and their
beginnings; a document is toxic if at least one sentence is, so that the sentence probabilities meet in a noisy-or,
``1 - prod(1 - p)`` over every sentence, in training and in scoring alike. Training sees document labels only; the
trained model then points at the sentences.

Learning reads whole texts of a bounded number of labelled rows, on the executors: one pass counts in how many documents
of each label every feature occurs and keeps those that tell the labels apart, another turns each document into its
sentences' kept features. Sentences without one all have the bias's probability, so that a document carries only their
number. The gradient steps run on the driver over these numbers.

Defined results: a null or empty text (or one without a letter) has no sentence and scores 0; a sentence and a text may
have any length; tied scores stay tied, repeated rows score alike; a column of the input named like an output stays, and
the output is called ``score_``, ``predicted_`` or ``offending_``; an empty table gives an empty result; with no labelled
row, or rows of one label only, every score is the prior's (0, or 1 if all are toxic).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterframe.llm.common import append_columns, blocks, bounded_batches, discard, is_set, labelled_texts, materialize

#: A word, or the marks that end a sentence.
TOKEN = re.compile(r"[^\W\d_]+|[.!?。！？…؟।\n]+")
END, NAN = frozenset(".!?。！？…؟।\n"), float("nan")
#: Features that the model keeps at most, those that tell most; fewer documents than this make none.
MAX_FEATURES, MIN_DOCS = 20_000, 4
#: The bias is at most this: long documents have many sentences that tell nothing.
MAX_BIAS = -9.0


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    bias: float


@dataclass(frozen=True)
class Bags:
    """Labels of documents, and their sentences: features of each (with the document's number), and how many have none."""

    labels: np.ndarray
    background: np.ndarray
    doc: np.ndarray  # of each sentence
    sentence: np.ndarray  # of each feature
    features: np.ndarray


def word_features(word: str) -> list[str]:
    """A lower-cased word and its beginnings, so that inflected and unseen forms share weight."""
    return [word, *("^" + word[:n] for n in (3, 4, 5, 6) if len(word) >= n)]


def feature_counts(sample: DataFrame) -> DataFrame:
    """feature, toxic, clean: documents of either label that hold it, counted in whole texts on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = Counter(), Counter()
        known: dict[str, list[str]] = {}

        def flush() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            out = [pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in (counts[1], counts[0]))]
            for c in counts:
                c.clear()
            known.clear()
            return pa.RecordBatch.from_arrays(out, names=["feature", "toxic", "clean"])

        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = set(TOKEN.findall(text.lower()))
                for w in words - known.keys():
                    known[w] = [] if w[0] in END else word_features(w)
                counts[int(label)].update({f for w in words for f in known[w]})
                if len(counts[0]) + len(counts[1]) > 1_000_000:
                    yield flush()
        yield flush()

    found = sample.mapInArrow(run, "feature string, toxic long, clean long")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def bags(sample: DataFrame, kept: list[str]) -> Bags:
    """The sample's documents as sentences of kept features."""
    shared = sample.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(kept)})  # MAX_FEATURES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known = shared.value, {}
        for batch in batches:
            rows: list[tuple] = []
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                n_words, here, background, sizes, features = 0, 0, 0, [], []
                for token in chain(TOKEN.findall(text.lower()), "."):
                    if token[0] in END:
                        if here:
                            sizes.append(here)
                        elif n_words:
                            background += 1
                        n_words = here = 0
                        continue
                    if (mine := known.get(token)) is None:
                        known = {} if len(known) > 300_000 else known
                        mine = known[token] = [place[f] for f in word_features(token) if f in place]
                    n_words += 1
                    here += len(mine)
                    features += mine
                rows.append((int(label), background, sizes, features))
            cols = zip(*rows, strict=True) if rows else ([], [], [], [])
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=["label", "background", "sizes", "features"])

    got = sample.mapInArrow(run, "label int, background long, sizes array<int>, features array<int>").toArrow()
    sizes = got.column("sizes").combine_chunks()
    per_doc = sizes.value_lengths().to_numpy(zero_copy_only=False) if len(got) else np.empty(0, np.int64)
    flat = sizes.flatten().to_numpy(zero_copy_only=False)
    return Bags(
        got.column("label").to_numpy().astype(np.float64), got.column("background").to_numpy().astype(np.float64),
        np.repeat(np.arange(len(got)), per_doc), np.repeat(np.arange(len(flat)), flat),
        got.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False),
    )


def train(data: Bags, kept: list[str], odds: np.ndarray, *, rounds: int = 200, l1: float = 2e-4, rate: float = 0.1) -> ToxicityModel:
    """Noisy-or likelihood of the document labels, by Adam with soft thresholding (L1), from log-odds as a start."""
    y = data.labels
    n1, n0 = (y > 0).sum(), (y == 0).sum()
    v = np.append(np.maximum(0.0, odds - 1.5), MAX_BIAS)
    m1, m2 = np.zeros_like(v), np.zeros_like(v)
    weight = np.where(y > 0, 0.5 / n1, 0.5 / n0)  # a class weighs as much as the other
    for step in range(1, rounds + 1):
        logit = np.bincount(data.sentence, v[data.features], minlength=len(data.doc)) + v[-1]
        p, p0 = (1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (logit, v[-1]))
        miss = np.bincount(data.doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)) + data.background * np.log1p(-p0)
        none = np.exp(miss)
        slope = np.where(y > 0, -none / np.maximum(1 - none, 1e-9), 1.0) * weight
        g_logit = p * slope[data.doc]
        g = np.bincount(data.features, g_logit[data.sentence], minlength=len(v))
        g[-1] = g_logit.sum() + (data.background * p0 * slope).sum()
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        pace = rate / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-4)
        v -= pace * m1 / (1 - 0.9**step)
        v[:-1] = np.sign(v[:-1]) * np.maximum(np.abs(v[:-1]) - l1 * pace[:-1], 0)
        v[-1] = min(v[-1], MAX_BIAS)
    return ToxicityModel({f: float(w) for f, w in zip(kept, v, strict=False) if w}, float(v[-1]))


class _WordWeights(dict):
    """Weight of each token; NaN for the marks that end a sentence."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.of = model.weights.get

    def __missing__(self, token: str) -> float:
        if len(self) > 300_000:
            self.clear()
        of = self.of
        weight = NAN if token[0] in END else sum(of(f, 0.0) for f in word_features(token))
        self[token] = weight
        return weight


class Scorer:
    """Scores whole texts and locates their offending sentences."""

    def __init__(self, model: ToxicityModel, threshold: float = 0.5):
        self.bias, self.threshold, self.word = model.bias, threshold, _WordWeights(model)

    def __call__(self, texts: list[str | None]) -> tuple[list, list, list]:
        scores, highest = np.zeros(len(texts)), np.zeros(len(texts))
        for lo, hi in blocks(texts):
            tokens_of = [TOKEN.findall((t or "").lower()) for t in texts[lo:hi]]
            lengths = [len(tokens) for tokens in tokens_of]
            x = np.fromiter(map(self.word.__getitem__, chain.from_iterable(tokens_of)), dtype=np.float64, count=sum(lengths))
            doc = np.repeat(np.arange(hi - lo), lengths)
            mark = np.isnan(x)
            part = np.cumsum(mark)[~mark]
            x, doc = x[~mark], doc[~mark]
            if not len(x):
                continue
            new = np.ones(len(x), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])
            starts = np.flatnonzero(new)
            p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(x, starts) + self.bias, -30, 30)))
            scores[lo:hi] = np.abs(np.expm1(np.bincount(doc[starts], np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=hi - lo)))
            np.maximum.at(highest, lo + doc[starts], p)
        spans = [self.sentences(t) if s >= self.threshold else [] for t, s in zip(texts, highest, strict=True)]
        return scores, (scores >= 0.5).astype(np.int32), spans

    def sentences(self, text: str) -> list[dict]:
        """Start, end (code points of the text) and probability of each offending sentence."""
        lowered = text.lower()
        if len(lowered) != len(text):  # a few letters grow when lower-cased: then by character, to keep offsets
            lowered = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        out, total, n, first, last = [], 0.0, 0, 0, 0

        def close() -> None:
            if n and (p := 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))) >= self.threshold:
                out.append({"start": first, "end": last, "probability": float(p)})

        for m in TOKEN.finditer(lowered):
            weight = self.word[m[0]]
            if weight != weight:
                close()
                total, n = 0.0, 0
                continue
            first = m.start() if n == 0 else first
            total, n, last = total + weight, n + 1, m.end()
        close()
        return out


def score_documents(df: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """Adds score (0 to 1), predicted (1 if score >= 0.5) and offending (spans of the sentences found toxic)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # MAX_FEATURES features at most
    fields = [("score", "double"), ("predicted", "int"), ("offending", "array<struct<start:int,end:int,probability:double>>")]
    return append_columns(df, fields, text_col, lambda: Scorer(shared.value))


def fit(docs: DataFrame, labels: DataFrame, *, learn: Column | None = None, label: str = "toxic", per_class: int = 2000) -> ToxicityModel:
    """Trains on the whole texts of at most ``per_class`` documents of each label."""
    bounded_batches(docs.sparkSession)
    learn = F.lit(True) if learn is None else learn
    sample = labelled_texts(docs, labels, label, learn=learn, per_class=per_class, max_rows=2 * per_class)
    sample = materialize(sample.select(is_set(F.col("label")).alias("label"), "text"), "toxicity-sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two labels
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        discard(sample)
        return ToxicityModel({}, 30.0 if toxic else -30.0)
    counts = materialize(feature_counts(sample).where(F.col("toxic") + F.col("clean") >= MIN_DOCS), "toxicity-features")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    holds = F.col("toxic") + F.col("clean")
    gain = lambda n, share: F.when(n > 0, n * F.log(n / (holds * share))).otherwise(0.0)
    ratio = 2 * (gain(F.col("toxic"), toxic / (toxic + clean)) + gain(F.col("clean"), clean / (toxic + clean)))
    # a feature must pay for a parameter by the Bayesian criterion, over the documents of the rarer label
    telling = counts.where(ratio >= math.log(min(toxic, clean))).withColumn("odds", odds)
    top = telling.orderBy(F.desc(F.abs("odds")), "feature").limit(MAX_FEATURES).toPandas()
    kept = top["feature"].tolist()
    model = train(bags(sample, kept), kept, top["odds"].to_numpy())
    discard(sample, counts)
    return model
