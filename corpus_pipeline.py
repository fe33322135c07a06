"""The corpus pipeline: five stages over documents, each written as Parquet and read again before the next.

All stages read whole texts of any length, judge repeated rows alike, keep rows that share an id (or have none) apart,
return other columns as they were, whatever their names, and give an empty result for an empty table. Each stage says
what becomes of null and empty texts and of ties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterframe.llm import bpe, decontam, langid, neardup, toxicity
from utterframe.llm.common import discard, fold, materialize, table


def _accepted(docs: DataFrame, score: Callable[[DataFrame], DataFrame], outputs: tuple[str, ...], condition: str) -> DataFrame:
    """The documents that meet a condition on what ``score`` adds; columns of theirs with such a name come back as they were."""
    aside = {c: f"__own_{c}" for c in docs.columns if c in outputs}
    scored = score(docs.withColumnsRenamed(aside)).where(condition)
    return scored.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the model, trained on the learning rows of ``labels``, finds toxic: a score of 0.5 or more.

    Null and empty texts score 0 and stay.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=fold("doc_id", 5) != 0)
    return _accepted(docs, lambda df: toxicity.score_documents(df, model), ("score", "predicted", "offending"), "predicted = 0")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose language cannot be told: no letters (null and empty texts), or a posterior under one half.

    Languages that tie at one half are told: the first by name.
    """
    model = langid.fit(docs, learn=fold("doc_id", 5) != 0)
    told = f"lang_pred <> '{langid.UNDETERMINED}' and score >= 0.5"
    return _accepted(docs, lambda df: langid.identify(df, model), ("lang_pred", "score"), told)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class of near-duplicates; of rows that tie on it that with the least text.

    Null texts stay, each by itself; texts without words are one class.
    """
    return neardup.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents into which a benchmark item leaks; null and empty texts, into which none can, stay."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenization_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every document and proves that the ids decode to it; a null or empty text has no ids.

    Returns doc_id, lang and source as far as they are there, and n_tokens, ids_sha256 and decoded_sha256.
    """
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return bpe.round_trip(docs.select(*kept, "text")).drop("text")


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", tokenization_stage),
]

#: The learned stages and the tokenizer have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
