"""The registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterframe.llm import bpe, chat, decontam, imatch, langid, neardup, quality, toxicity, urls, warc
from utterframe.llm.common import fold, held_out, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=fold("doc_id", 5) != 0)
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), learn=fold("doc_id", 3) != 1)
    scored = quality.score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digests(chat.format_conversations(turns))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, learn=fold("doc_id", 5) != 0)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    _, index = warc.archive(pages)
    key = pages.schema["page_id"].dataType
    records = warc.read_records(index, payloads=False)
    return records.select(
        F.col("page_id").cast(key).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(key).alias("refers_to"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_with_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classify(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_toxicity, op3_quality, op4_chat_format, op5_language_id, op6_byte_bpe, op7_warc,
        op8_url_filter, op9_fingerprint, op10_near_duplicates,
    )
}

_TURNS = """
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
"""
_ESCAPED = "replace(replace(replace({}, '\\', '\\\\'), '#', '\\#'), '</turn>', '<\\/turn>')"

def url_sql() -> str:
    """Splitting, rules and the model's score (each n-gram's hash and weight) in SQL; the weights are the trained ones."""
    model = urls.train(urls.LABELLED_URLS)
    used = model.weights.nonzero()[0]
    mod, factor = 1 << 64, 0x9E3779B97F4A7C15
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    ranked = sorted(urls.DEFAULT_RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    case = lambda pick: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{pick(v, h + p)}'" for v, h, p in ranked) + " END"
    steps = ", ".join(
        f"CASE WHEN n < {i} THEN h{i - 1} ELSE ((h{i - 1} + c{i}) % {mod}::UHUGEINT * {factor}::UHUGEINT) % {mod}::UHUGEINT END AS m{i}, "
        f"CASE WHEN n < {i} THEN h{i - 1} ELSE xor(m{i}, m{i} // {1 << 29}::UHUGEINT) END AS h{i}" for i in range(1, 6)
    )
    codes = ", ".join(f"lead(c1, {i - 1}) OVER w AS c{i}" for i in range(2, 6))
    return f"""
        WITH p AS (SELECT page_id, coalesce(url, '') AS url, row_number() OVER () AS k FROM pages),
        s AS (SELECT k, page_id, contains(url, '://') AS has, regexp_extract(url, '^.*?://([^/?#]*)', 1, 's') AS h, regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM p),
        d AS (SELECT k, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM s),
        t AS (SELECT k, chr(1) || host || chr(2) || path || chr(3) AS marked FROM d),
        i AS (SELECT k, marked, unnest(range(1, length(marked) + 1)) AS i FROM t),
        c AS (SELECT k, i, unicode(substr(marked, i, 1))::UHUGEINT AS c1 FROM i),
        l AS (SELECT *, {codes} FROM c WINDOW w AS (PARTITION BY k ORDER BY i)),
        g AS (SELECT k, n, (n * {0x9E3779B1})::UHUGEINT AS h0, c1, c2, c3, c4, c5 FROM l, (VALUES (3), (4), (5)) AS o(n)
              WHERE c3 IS NOT NULL AND (n < 4 OR c4 IS NOT NULL) AND (n < 5 OR c5 IS NOT NULL)),
        b AS (SELECT k, {steps} FROM g),
        w AS (SELECT unnest({used.tolist()}) AS bucket, unnest({model.weights[used].tolist()}) AS weight),
        z AS (SELECT k, sum(coalesce(weight, 0)) / sqrt(count(*)) + {model.bias!r} AS logit FROM b LEFT JOIN w ON bucket = (h5 // {1 << (64 - urls.BITS)}::UHUGEINT)::BIGINT GROUP BY k)
        SELECT page_id, host, path, {case(lambda v, r: r)} AS rule,
            coalesce({case(lambda v, r: v)}, CASE WHEN coalesce(logit, {model.bias!r}) >= 0 THEN 'block' ELSE 'allow' END) AS verdict
        FROM d LEFT JOIN z USING (k)
    """


ORACLE_SQL = {
    "op4_chat_format": f"""
        WITH t AS ({_TURNS}), o AS (
            SELECT conv_id, turn, role, text,
                length({_ESCAPED.format("role")}) + length(role) - length(replace(role, ':', ''))
                    + length({_ESCAPED.format("text")}) + 14 AS size
            FROM t)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(size) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS n_rewrites
        FROM o GROUP BY conv_id
    """,
    "op7_warc": """
        WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM m
    """,
    "op8_url_filter": url_sql(),
}
