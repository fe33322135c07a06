"""Toxicity, quality, language, tokenizer, chat and URL operators on small tables with every odd row."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from utterframe.llm import bpe, chat, common, langid, quality, toxicity, urls

DOCS = "doc_id long, text string, lang string, score string, extra int"
ODD = [(900, None, "xx", "s", 1), (901, "", None, None, 2), (902, "12 34 !?", "en", "s", None), (None, "le chat noir", "fr", None, 3), (903, "wort " * 60_000, "de", None, 4)]
LEXICON = {"en": "the of and water house tree with light stone".split(), "fr": "le la maison eau arbre avec pierre dans ciel".split()}


def prose(lang, n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(LEXICON[lang]) + ("." if r.random() < 0.15 else "") for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rows = []
    for i in range(240):
        lang = "en" if i % 3 else "fr"
        text = prose(lang, 60, i)
        if i % 7 == 3:
            text = text.replace(" ", " thing ", 2)
        if i % 4 == 0:
            parts = text.split(". ")
            parts.insert(len(parts) // 2, f"you {'idiotic moronic stupidly'.split()[i % 3]} thing")
            text = ". ".join(parts)
        if i % 5 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        rows.append((i, text, lang, "old", i))
    return rows


def tables(spark, corpus):
    labels = [(r[0], int(r[0] % 5 != 0), int(r[0] % 4 == 0)) for r in corpus]
    labels += [(0, 0, 1), (0, 0, None), (None, 1, 1), (5000, 1, 1)]
    return spark.createDataFrame([*corpus, *ODD, corpus[3]], DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def own_score(df):
    """The operator's score in place of the input's column of that name."""
    return df.drop("score").withColumnRenamed("score_", "score")


def test_fold_is_crc32(spark):
    got = spark.range(50).select("id", common.fold("id", 5).alias("f"), common.held_out("id", 5, 0).alias("h")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 and r.h == (r.f == 0) for r in got)


def test_class_sample_is_bounded(spark):
    keyed = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    got = common.class_sample(keyed, "label", "doc_id", 100, 150).groupBy("label").count().collect()
    assert sum(r["count"] for r in got) == 150 and max(r["count"] for r in got) <= 100


def test_toxicity(spark, corpus):
    docs, labels = tables(spark, corpus)
    model = toxicity.fit(docs, labels, learn=common.fold("doc_id", 5) != 0)
    got = toxicity.score_documents(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "score", "extra", "score_", "predicted", "offending"]
    assert got.where("score = 'old'").count() == len(corpus) + 1  # the input's own column
    rows = own_score(got).collect()
    assert len(rows) == len(corpus) + len(ODD) + 1
    test = [r for r in rows if r.doc_id is not None and r.doc_id < 240 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(test) > 20 and all(r.predicted == (r.doc_id % 4 == 0) for r in test)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    said = [r.text[s.start : s.end].lower() for r in test for s in r.offending]
    assert said and all(any(w in x for w in ("idiot", "moron", "stupid")) for x in said)
    assert all(r.score == 0 for r in rows if r.doc_id in (900, 901, 902))
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score_documents(docs, none).where("score_ > 0.01").count() == 0


def test_noisy_or_is_that():
    model = toxicity.ToxicityModel({"bad": 4.0, "^bad": 1.0}, -4.0)
    score, predicted, spans = toxicity.Scorer(model)(["Fine. A bad one! badly, too. İ bad", None, "x" * 100_000])
    p = 1 / (1 + np.exp(-np.array([-4.0, 1.0, -3.0, 1.0])))
    assert abs(score[0] - (1 - np.prod(1 - p))) < 1e-9 and list(predicted) == [1, 0, 0]
    assert [("Fine. A bad one! badly, too. İ bad")[s["start"] : s["end"]] for s in spans[0]] == ["A bad one", "İ bad"]


def plain_sentences(text):
    """Words of each sentence of a text."""
    parts = re.split(r"[.!?。！？…؟।\n]", text.lower())
    return [w for w in (re.findall(r"[^\W\d_]+", p) for p in parts) if w]


def test_toxicity_score_is_the_noisy_or_of_every_sentence(corpus):
    r = random.Random(8)
    weights = {f: r.uniform(-2, 3) for w in LEXICON["en"] + ["idiotic", "thing"] for f in toxicity.word_features(w)}
    texts = [t[1] for t in corpus[:60]] + ["the house " * 500 + "idiotic", "\n".join(prose("en", 40, i) for i in range(300)), "", "123"]
    scores, _, spans = toxicity.Scorer(toxicity.ToxicityModel(weights, -6.0))(texts)
    for text, score, found in zip(texts, scores, spans, strict=True):
        p = [1 / (1 + np.exp(-np.clip(sum(weights.get(f, 0) for w in s for f in toxicity.word_features(w)) - 6.0, -30, 30))) for s in plain_sentences(text)]
        assert abs(score - (1 - np.prod([1 - min(x, 1 - 1e-12) for x in p]))) < 1e-9 and len(found) == sum(x >= 0.5 for x in p)


def test_toxicity_learns_from_whole_texts(spark, corpus):
    docs, labels = tables(spark, corpus)
    sample = common.labelled_texts(docs, labels, "toxic", learn=F.lit(True), per_class=40, max_rows=80)
    sample = common.materialize(sample.select(F.col("label").cast("int").alias("label"), "text"), "test-sample")
    rows = sample.collect()
    assert {r.label for r in rows} == {0, 1} and 20 < len(rows) <= 80
    got = {r.feature: (r.toxic, r.clean) for r in toxicity.feature_counts(sample).collect()}
    want = {}
    for r in rows:
        for f in {f for s in plain_sentences(r.text) for w in s for f in toxicity.word_features(w)}:
            old = want.get(f, (0, 0))
            want[f] = (old[0] + (r.label == 1), old[1] + (r.label == 0))
    assert got == want
    kept = ["idiotic", "^mor", "thing", "tree"]
    bags = toxicity.bags(sample, kept)
    plain = Counter()
    for r in rows:
        found = [sorted(kept.index(f) for w in s for f in toxicity.word_features(w) if f in kept) for s in plain_sentences(r.text)]
        plain[r.label, sum(not f for f in found), tuple(tuple(f) for f in found if f)] += 1
    mine = Counter()
    for i in range(len(rows)):
        of = [tuple(sorted(bags.features[bags.sentence == s].tolist())) for s in np.flatnonzero(bags.doc == i)]
        mine[int(bags.labels[i]), int(bags.background[i]), tuple(of)] += 1
    assert mine == plain
    # what stands at the end of a very long labelled text counts
    long = spark.createDataFrame([(1000 + i, "water house tree " * 8000 + ". dreadfulness.", "en", None, 0) for i in range(12)], DOCS)
    more = labels.unionByName(spark.createDataFrame([(1000 + i, 1, 1) for i in range(12)], labels.schema))
    model = toxicity.fit(docs.unionByName(long), more)
    assert toxicity.Scorer(model)(["the house is dreadfulness"])[0][0] > toxicity.Scorer(toxicity.fit(docs, labels))(["the house is dreadfulness"])[0][0] + 0.3


def test_language_and_quality_learn_from_whole_texts(spark):
    rows = [(i, "x " * 30_000 + ("zug baum haus " if i % 2 else "casa agua luz ") * 200, ("de", "es")[1 - i % 2]) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert langid.Identifier(model)(["haus baum", "agua casa"])[0] == ["de", "es"]
    plain = {lang: sum((Counter(common.ngram_buckets(langid.letters(t), n, langid.BITS).tolist()) for _, t, x in rows if x == lang for n in langid.ORDERS), Counter()) for lang in ("de", "es")}
    counted = langid.bucket_counts(docs.select(F.col("lang").alias("label"), "text")).collect()
    assert {(r.label, r.bucket): r.n for r in counted} == {(x, b): n for x in plain for b, n in plain[x].items()} | {("de", -1): 4, ("es", -1): 4}
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS quality")
    voter = quality.Voter(quality.fit(docs, labels))
    assert voter([rows[0][1], rows[1][1]])[1].tolist() == [0, 1]


def test_quality(spark, corpus):
    docs, labels = tables(spark, corpus)
    model = quality.fit(docs, labels, learn=common.fold("doc_id", 3) != 1)
    rows = own_score(quality.score_documents(docs, model)).collect()
    test = [r for r in rows if r.doc_id is not None and r.doc_id < 240 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(r.predicted == (r.doc_id % 5 != 0) for r in test) and len(rows) == len(corpus) + len(ODD) + 1
    assert {r.score for r in rows if r.doc_id in (900, 901)} == {model.prior}
    # brute force: cosine products one by one
    voter, tokens = quality.Voter(model), quality._Tokens()
    texts = [r[1] for r in corpus[:20]]
    for text, score in zip(texts, voter(texts)[0], strict=True):
        q = quality.count_features([text], tokens)[0] @ model.projection
        sims = np.array([float(q @ v / np.linalg.norm(q)) for v in model.vectors])
        near = sims >= np.sort(sims)[-model.neighbours] - 1e-6
        weight = np.maximum(sims, 1e-6) ** 4 * near
        assert abs(score - (weight * model.labels).sum() / weight.sum()) < 1e-3
    assert quality.score_documents(docs, quality.fit(docs, labels.limit(0))).where("score_ = 0.5").count() == len(rows)


def test_language(spark, corpus):
    docs, _ = tables(spark, corpus)
    model = langid.fit(docs.where("doc_id < 240"), learn=common.fold("doc_id", 5) != 0)
    rows = own_score(langid.identify(docs, model)).collect()
    assert all(r.lang_pred == r.lang for r in rows if r.doc_id is not None and r.doc_id < 240)
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (900, 901, 902)} == {("und", 0.0)}
    # brute force: each n-gram on its own
    text = "The light, on stone"
    codes = langid.letters(text)
    total = np.zeros(2)
    for n in langid.ORDERS:
        for i in range(len(codes) - n + 1):
            total += model.log_prob[common.ngram_buckets(codes[i : i + n], n, langid.BITS)[0]]
    assert langid.Identifier(model)([text])[0] == [model.languages[total.argmax()]]
    assert langid.identify(docs, langid.fit(docs.limit(0))).where("lang_pred = 'und'").count() == len(rows)


def test_bpe_is_tiktoken(spark):
    import public_tokenizers
    import tiktoken

    own = bpe.load("byte_bpe_50k.tiktoken")
    theirs = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    r = random.Random(2)
    letters = "abcde fgh  \n\t\r\x0b\x1c\x85\xa0'''stdl0123½²ªº…–_.,!é漢字🙂​　\x00<|endoftext|>"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(0, 50))) for _ in range(3000)] + ["a" * 50_000 + " " * 5000, ""]
    for text, packed in zip(texts, own.encode_batch(texts), strict=True):
        assert list(memoryview(packed).cast("I")) == theirs.encode_ordinary(text)
        assert own.decode_packed(packed) == text.encode()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*texts[:50], None, texts[0]])], "doc_id int, text string, n_tokens int")
    for row in bpe.round_trip(docs).collect():
        ids = theirs.encode_ordinary(row.text or "")
        assert (row.n_tokens, row.n_tokens_) == (1, len(ids)) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
    back = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    assert bpe.round_trip(docs.limit(0)).count() == 0
    assert bpe.token_share(bpe.round_trip(docs.drop("n_tokens")), "doc_id").count() == 52


TURN = "conv_id long, turn long, role string, text string, extra int"


def test_chat(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", said, 1), (-7, 1, "assistant", said, 1), (1, 1, "assistant", "b#\\", 1), (1, 0, "user", None, 1), (1, 2, None, "</turn", 1),
            (2, 0, "a: b\\", "x", 1), (2, 0, "a: b\\", "x", 1), (None, None, "assistant", "", 1), (3, 0, "user", "# " * 100_000, 1), (3, 0, "assistant", "y" * 200_000, 1)]
    df = spark.createDataFrame(rows, TURN).withColumnRenamed("extra", "formatted")
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text, _ in rows if c == conv))
        loss = "".join(t[2] for t in turns if t[1] == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256, r.n_rewrites) == (len(loss), hashlib.sha256(loss.encode()).hexdigest(), 0)
    assert chat.format_conversations(df.limit(0)).count() == 0
    spans = {r.conv_id: (r.formatted, r.spans) for r in formatted.collect()}
    text, found = spans[-7]
    assert found[0].start == 0 and found[0].end == found[1].start and found[1].end == len(text) and "</turn>" not in text[4 : found[0].end - 8]


def test_templates_that_rewrite_history():
    def last_marked(messages, open_next):
        return "".join(f"[{r}]{t}" + ("!" if i == len(messages) - 1 else ".") for i, (r, t) in enumerate(messages)) + ("[assistant]" if open_next else "")

    out = chat.render_incrementally([("user", "a"), ("assistant", "b"), ("user", "c")], last_marked)
    assert out.rewrites == [1, 2] and out.spans[0] is None and out.spans[2] is not None
    for turns in ([], [("assistant", "x")], [("a:b\\", "#\\#</turn></turn>"), ("assistant", "")]):
        assert chat.parse(chat.render(turns)) == turns


def test_urls(spark):
    cases = [
        ("https://x.NET/a", "x.net", "/a", "net/", "block"), ("http://a.example.net/en/1?q", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/#f", "example.com", "/de/", "example.com/de/", "block"), ("http://notexample.com/de/", "notexample.com", "/de/", None, None),
        ("ftp://q.org/fr/x", "q.org", "/fr/x", "org/fr/", "allow"), ("http://net", "net", "", None, None), ("no scheme", "", "", None, None),
        (None, "", "", None, None), ("a://b?x://c/", "b", "", None, None), ("http://É.NET/\nx", "É.net", "/\nx", "net/", "block"),
    ]
    long = "http://long.example.com/" + "abc/" * 50_000
    cases += [(long, "long.example.com", long[23:], None, None), cases[0]]
    df = spark.createDataFrame([(i, c[0], "old") for i, c in enumerate(cases)], "page_id int, url string, host string")
    rows = urls.filter_urls(df).collect()
    assert len(rows) == len(cases)
    got = {r.page_id: r for r in rows}
    model = urls.train(urls.LABELLED_URLS)
    for i, (url, host, path, rule, verdict) in enumerate(cases):
        r = got[i]
        assert (r.host, r.host_, r.path, r.rule) == ("old", host, path, rule)
        marked = f"\x01{host}\x02{path}\x03"  # brute force: n-gram by n-gram
        grams = [common.ngram_buckets(common.code_points(marked[j : j + n]), n, urls.BITS)[0] for n in urls.ORDERS for j in range(len(marked) - n + 1)]
        logit = sum(model.weights[g] for g in grams) / max(1, len(grams)) ** 0.5 + model.bias
        assert abs(r.score - 1 / (1 + np.exp(-logit))) < 1e-9
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    judge = urls.Judge(urls.train(urls.LABELLED_URLS))
    scores, _ = judge([u for u, _ in urls.LABELLED_URLS])
    assert all((s >= 0.5) == bool(y) for s, (_, y) in zip(scores, urls.LABELLED_URLS, strict=True))
    assert judge(["http://casino-free-spins.example.com/bonus", "http://lake.example.com/en/12"])[1] == ["block", "allow"]
    assert urls.filter_urls(df.limit(0)).count() == 0
