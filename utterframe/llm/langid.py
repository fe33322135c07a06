"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and every run of non-letters becomes one boundary mark. The model is a fixed-size matrix of
log-probabilities (buckets x languages), broadcast and looked up for the n-grams of a batch of texts in numpy.

Learning reads whole texts of a bounded number of rows and adds up their n-grams on the executors; the driver gets one
count for each bucket and language.

Defined results: a null text or one without a letter is ``und`` with score 0; texts of any length are read whole; ties
go to the first language by name; repeated rows get equal results; a column of the input named like an output stays, and
the output is called ``lang_pred_`` or ``score_``; an empty table gives an empty result; with no labelled row all is
``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterframe.llm.common import append_columns, blocks, bounded_batches, code_points, is_letter, labelled_texts, ngram_buckets

ORDERS = (2, 3, 4)
BITS = 16
UNDETERMINED = "und"
#: N-grams that count as independent evidence: the score is the posterior of that many, not of thousands.
EVIDENCE = 60.0


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # (2**BITS, languages)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of non-letters replaced by one 0, with a 0 at either end."""
    codes = code_points(text.lower())
    alpha = is_letter(codes)
    out = np.zeros(len(codes) + 2, dtype=np.uint32)
    out[1:-1] = np.where(alpha, codes, 0)
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def bucket_counts(sample: DataFrame) -> DataFrame:
    """label, bucket, n: how often each hashed n-gram stands in the texts of each language; one row a text for bucket -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                mine = counts.setdefault(label, np.zeros((1 << BITS) + 1, dtype=np.int64))
                codes = letters(text)
                for n in ORDERS:
                    mine[:-1] += np.bincount(ngram_buckets(codes, n, BITS), minlength=1 << BITS)
                mine[-1] += 1
            if len(counts) >= 64:
                yield from flush(counts)
        yield from flush(counts)

    def flush(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for label, mine in counts.items():
            at = np.flatnonzero(mine)
            bucket = np.where(at == 1 << BITS, -1, at)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(bucket, pa.int32()), pa.array(mine[at], pa.int64())], names=["label", "bucket", "n"])
        counts.clear()

    found = sample.mapInArrow(run, "label string, bucket int, n long")
    return found.groupBy("label", "bucket").agg(F.sum("n").alias("n"))


def train(counted: DataFrame, smoothing: float = 0.5) -> LanguageModel:
    """From label, bucket and n: at most (2**BITS + 1) rows a language, as many numbers as the model has."""
    rows = counted.toPandas()
    languages = sorted(set(rows["label"]))
    counts = np.zeros((len(languages), 1 << BITS))
    rows = rows[rows["bucket"] >= 0]
    counts[np.searchsorted(np.array(languages, dtype=object), rows["label"].to_numpy()) if len(rows) else [], rows["bucket"]] = rows["n"]
    counts += smoothing
    log_prob = np.log(counts / counts.sum(axis=1, keepdims=True))
    return LanguageModel(languages, np.ascontiguousarray(log_prob.T, dtype=np.float32))


class Identifier:
    def __init__(self, model: LanguageModel):
        self.model = model

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        width = max(1, len(self.model.languages))
        for lo, hi in blocks(texts, 250_000):
            codes = [letters(t or "") for t in texts[lo:hi]]
            total, grams = np.zeros((hi - lo, width)), np.zeros(hi - lo)
            for n in ORDERS:
                found = [ngram_buckets(c, n, BITS) for c in codes]
                sizes = np.array([len(f) for f in found])
                has = np.flatnonzero(sizes)
                if len(has) and self.model.languages:
                    starts = np.concatenate([[0], np.cumsum(sizes[has])[:-1]])
                    total[has] += np.add.reduceat(self.model.log_prob[np.concatenate(found)], starts, axis=0, dtype=np.float64)
                    grams += sizes
            best = total.argmax(axis=1)
            scaled = total * np.minimum(1, EVIDENCE / np.maximum(grams, 1))[:, None]
            odds = np.exp(scaled - scaled.max(axis=1, keepdims=True))
            chance = odds.max(axis=1) / odds.sum(axis=1)
            for i, c in enumerate(codes):
                known = bool(self.model.languages) and bool(c.any())
                names.append(self.model.languages[best[i]] if known else UNDETERMINED)
                scores[lo + i] = chance[i] if known else 0.0
        return names, scores


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Adds lang_pred and score (0 to 1)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # 2**BITS x languages floats
    return append_columns(df, [("lang_pred", "string"), ("score", "double")], text_col, lambda: Identifier(shared.value))


def fit(
    docs: DataFrame, *, learn: Column | None = None, id_col: str = "doc_id", lang_col: str = "lang", per_class: int = 400, max_rows: int = 8000
) -> LanguageModel:
    """Trains on the whole texts of at most ``per_class`` documents a language (``max_rows`` in all)."""
    bounded_batches(docs.sparkSession)
    learn = F.lit(True) if learn is None else learn
    sample = labelled_texts(
        docs, docs.select(id_col, lang_col), lang_col, id_col=id_col, learn=learn, per_class=per_class, max_rows=max_rows
    )
    return train(bucket_counts(sample))
