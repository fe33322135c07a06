"""Decontamination, archives, fingerprints, near-duplicates and the pipeline against plain versions."""

import hashlib
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from utterframe.llm import common, decontam, imatch, neardup, queries, warc


def words(n, seed, size=400):
    r = random.Random(seed)
    return [f"{r.choice('bcdfglmnprst')}{r.choice('aeiou')}{r.choice('bcdfglmnprst')}{r.randrange(size):x}".rstrip("0123456789") + "aeiou"[r.randrange(5)] + r.choice(["n", "r", "s", "lt"]) for _ in range(n)]


ITEM = "A train leaves Boston at 9 and travels 120 miles in 3 hours, how fast was that train of Boston going on average"
ALTERED = "A train leaves Chicago at 7 and travels 200 miles in 4 hours, how fast was that train of Chicago going on average"
MIXED = "A train leaves Chicago at 7 and travels 200 miles in 4 hours, how fast was that train of Dallas going on average"


def test_leaks(spark):
    filler = lambda s: " ".join(words(80, s)) + ". "
    docs = [
        (1, filler(1) + ITEM + ". " + filler(2)), (2, filler(3) + ALTERED + ". " + filler(4)), (3, filler(5) + MIXED + ". " + filler(6)),
        (4, filler(7)), (5, None), (6, ""), (7, ITEM), (7, filler(8)), (None, ITEM), (8, "short text"), (9, " ".join(ITEM.split()[:9]) + filler(9)),
        (10, (filler(11) * 400) + ITEM),
    ]
    df = spark.createDataFrame([(a, b, 0) for a, b in docs], "doc_id long, text string, hash int")
    bench = spark.createDataFrame([(0, ITEM), (0, ITEM), (1, None), (2, "too short"), (3, " ".join(words(30, 99)))], "item_id long, text string")
    got = {r.doc_id: r.kind for r in decontam.find_leaks(df, bench).collect()}
    assert got == {1: "exact", 2: "reparameterised", 7: "exact", None: "exact", 10: "exact"}
    kept = decontam.decontaminate(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [3, 4, 5, 6, 7, 8, 9]
    assert decontam.find_leaks(df.limit(0), bench).count() == 0 and decontam.find_leaks(df, bench.limit(0)).count() == 0


def plain_windows(text, item):
    """(kind, width, place): tokens, of a text, that a window compares; and the slots of all tokens."""
    tokens = decontam.TOKEN.findall(decontam.TEXT_START + text) if text else []
    canon, plain = [decontam.canonical(t) for t in tokens], [decontam.spelling(t) for t in tokens]
    out = {}
    for i in range(len(tokens) - 4):
        part = canon[i : i + 5]
        if sum(v is None for _, v in part) >= 3:
            out[False, 5, i] = tuple(t for t, _ in part)
    starts = [not t[0].isalnum() for t in tokens] + [True]
    for width in range(1, 6):
        for i in range(len(tokens) - width + 1):
            whole = width == 5 or (len(tokens) == width if item else width > 2 or starts[i] and starts[i + width])
            if whole:
                out[True, width, i] = tuple(plain[i : i + width])
    return out, [v for _, v in canon]


def plain_leak(doc, item, coverage=0.6):
    """(kind, coverage) of an item in a document by comparing all windows with all, or None."""
    (found, slots), (mine, values) = plain_windows(doc, False), plain_windows(item, True)
    template = {i for kind, _, i in mine if not kind}
    n = {False: len(template), True: sum(kind for kind, *_ in mine)}
    shifts = {}
    for (kind, width, i), x in mine.items():
        for (kind2, width2, j), y in found.items():
            if kind == kind2 and width == width2 and x == y:
                pairs = frozenset((values[i + k], values[i + k] if kind else slots[j + k]) for k in range(width) if values[i + k] is not None)
                shifts.setdefault(j - i, set()).add((i, i in template, pairs))
    every, best = {False: set(), True: set()}, {False: 0, True: 0}
    for w in shifts.values():
        pairs = {p for _, _, ps in w for p in ps}
        clash = {(a, b) for a, b in pairs if a != b and any(a == c and b != d for c, d in pairs)}
        w = [x for x in w if not x[2] & clash]
        same = all(a == b for *_, ps in w for a, b in ps)
        for kind in every:
            places = {i for i, in_template, _ in w if kind or in_template}
            every[kind] |= places
            best[kind] = max(best[kind], len(places) if same else 0)
    ways = [(len(every[k]) / n[k], len(every[k]), "exact" if best[k] >= coverage * n[k] else "reparameterised") for k in every if n[k]]
    top = max(ways, default=None)
    return None if top is None or top[0] < coverage else (top[2], round(top[0], 6))


def test_leaks_against_all_windows(spark):
    r = random.Random(31)
    names, units = ["Boston", "Chicago", "Alice", "Bob", "Dallas"], ["miles", "kg", "hours", "dollars"]

    def sentence(k):
        parts = [r.choice([r.choice(names), str(r.randrange(2, 9)), r.choice(units), "twelve"]) if r.random() < 0.35 else w for w in words(r.randrange(2, 26), k)]
        return " ".join(parts).capitalize() + r.choice([".", "?", "!", ""])

    items = [(i, " ".join(sentence(1000 + 7 * i + j) for j in range(r.randrange(1, 3)))) for i in range(25)] + [(25, "Why?"), (26, "7 + 5 = 12"), (27, ""), (28, None), (3, "a second text")]

    def changed(text):
        out = []
        for w in text.split():
            x = r.random()
            out.append(r.choice(names) if w.strip(".?!") in names and x < 0.4 else str(r.randrange(2, 9)) if w.isdigit() and x < 0.4 else "other" if x < 0.05 else w.upper() if x < 0.08 else w)
        return " ".join(out)

    docs = []
    for i in range(90):
        item = items[i % 27][1]
        body = r.choice([item, changed(item), changed(item), " ".join(item.split()[: len(item.split()) * 2 // 3])])
        docs.append((i if i % 10 else None, f"{sentence(i)} {body} {sentence(500 + i)}"))
    docs += [(5, docs[6][1]), (6, docs[6][1]), (91, None), (92, "")]
    df = spark.createDataFrame([(a, b, "x") for a, b in docs], "doc_id long, text string, width string")
    got = Counter((x.doc_id, x.item_id, x.kind, round(x.coverage, 6)) for x in decontam.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect())
    want = Counter()
    for doc_id, text in set(docs):
        best = {}
        for item_id, item in items:
            if text and item and (leak := plain_leak(text, item)):
                best[item_id] = max(best.get(item_id, (0.0, "")), leak[::-1])
        want.update((doc_id, i, kind, c) for i, (c, kind) in best.items())
    assert got == want and len({k[2] for k in want}) == 2 and len(want) > 40


def leaks_of(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontam.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r.doc_id, r.item_id): (r.kind, round(r.coverage, 2)) for r in found}


def test_copies_in_any_case_leak(spark):
    german = (
        "Der Zug verlässt den Bahnhof in Berlin am Morgen und erreicht nach einer Fahrt von drei Stunden die Stadt Hamburg, "
        "wo der Fahrer eine Pause auf der Straße macht"
    )
    docs = [(i, f"{' '.join(words(40, i))}. {t}. {' '.join(words(40, 50 + i))}") for i, t in enumerate([german, german.lower(), german.upper(), german.title()])]
    assert leaks_of(spark, [*docs, (9, " ".join(words(90, 5)))], [(0, german)]) == {(i, 0): ("exact", 1.0) for i in range(4)}


def test_one_inconsistent_value_takes_out_its_windows_only(spark):
    w = words(60, 1)
    item = " ".join([*w[:10], "Boston", *w[10:45], "Boston", *w[45:]])
    edited = " ".join([*w[:10], "Boston", *w[10:45], "Bostan", *w[45:]])
    got = leaks_of(spark, [(1, edited), (2, MIXED)], [(0, item), (1, ITEM)])
    assert list(got) == [(1, 0)] and got[1, 0][0] == "exact" and 0.9 <= got[1, 0][1] < 1


def test_items_without_template_windows_leak(spark):
    items = ["What is 12 + 7 - 3?", "1 2 3 4 5 6 7 8", "Who was Ada Lovelace", "Why?", "Anna, Bob, Alice, Jane, Jack, Peter"]
    docs = [(i, f"{' '.join(words(30, i))}. {t} {' '.join(words(30, 50 + i))}") for i, t in enumerate(items)]
    docs += [(10, "what is 12 + 7 - 4"), (11, "nobody knows why and how"), (12, "1 2 3 4 9 6 7 8"), (13, "???"), (14, "")]
    assert leaks_of(spark, docs, [*enumerate(items), (7, "+ - ?")]) == {(i, i): ("exact", 1.0) for i in range(5)}


def test_rows_that_share_an_id_are_judged_apart(spark):
    half = ITEM.split()
    rows = [(7, ITEM), (7, "clean text of seven words or more"), (None, ITEM), (None, ALTERED), (None, "another clean text without an id"),
            (8, " ".join(half[:11])), (8, " ".join(half[11:])), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    left = decontam.decontaminate(df, bench).collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter([rows[1], *rows[4:]])
    found = Counter((r.doc_id, r.kind) for r in decontam.find_leaks(df, bench).collect())
    assert found == {(7, "exact"): 1, (None, "exact"): 1, (None, "reparameterised"): 1}


def test_template_tokens():
    got = [decontam.canonical(t) for t in decontam.TOKEN.findall(".The 1,200 kg of Alice. Bob met Twelve")]
    assert got == [("the", None), ("<num>", "1200"), ("<unit>", "kg"), ("of", None), ("<name>", "alice"), ("<name>", "bob"), ("met", None), ("<num>", "twelve")]


def test_archive(spark):
    big, other = "é" * 700, "x" * 2000
    rows = [(1, "http://a/\r\nb%20", big, 1), (5, None, big, 1), (3, "http://c/x%20y?q=%7E", big, 1), (4, "u", "small", 1), (6, "u", "small", 1), (7, "v", None, 1),
            (8, "w", "", 1), (9, "w", other, 1), (9, "w", other, 1), (2, " é ", other, 1), (None, "n", other, 1), (10, "urn:x-page:10", "z" * 3000, 1),
            (11, "", "only" * 500, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    path, index = warc.archive(pages)
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    last = {big: 5, other: 9}
    for page, url, html, _ in rows:
        body = (html or "").encode()
        mine = [r for r in got if r.page_id == (None if page is None else str(page))]
        again = html in last and page != last[html]
        assert mine and all(
            (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.url)
            == (len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", str(last[html]) if again else None, url) for r in mine
        )
        assert all(again or bytes(r.payload) == body for r in mine)
        assert {r.url for r in index.where(F.col("page_id").eqNullSafe(F.lit(None if page is None else str(page)))).collect()} == {url}
        if url is not None:  # the index finds a record by its original URL
            assert page in {None if r.page_id is None else int(r.page_id) for r in warc.read_records(index.where(F.col("url") == url)).collect()}
    assert warc.read_records(index, payloads=False).where("payload is not null").count() == 0
    # plain members end to end: any gzip reader reads the files, and no byte lies between
    import gzip

    files = list(Path(path.removeprefix("file:")).glob("*.warc.gz"))
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in files)
    assert raw.count(b"WARC/1.1\r\n") == len(rows) + len(files) and all(gzip.decompress(p.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for p in files)
    for p in files:
        data = p.read_bytes()
        while data:
            inflate = zlib.decompressobj(31)
            inflate.decompress(data)
            data = inflate.unused_data
            assert inflate.eof and data[:2] in (b"", b"\x1f\x8b")
    few = warc.read_records(index.where("page_id = '3' or page_id = '7'")).collect()
    assert sorted(r.page_id for r in few) == ["3", "7"]
    none_path, none = warc.archive(pages.limit(0))
    assert none.count() == 0 and warc.read_records(none).count() == 0


def test_archive_of_large_and_many_records(spark, monkeypatch):
    monkeypatch.setattr(warc, "PART_BYTES", 4000)
    monkeypatch.setattr(warc, "BITMAP_BITS", 6)  # nearly all pages share a bit with a copied one
    r = random.Random(6)
    rows = [(i, f"http://h/{i}", "".join(chr(r.randrange(32, 1000)) for _ in range(r.randrange(0, 3000)))) for i in range(200)]
    rows += [(1000 + i, "u", rows[i % 7][2]) for i in range(60)] + [(2000, "long", "ab" * (9 << 20))]
    index = warc.archive(spark.createDataFrame(rows, "page_id int, url string, html string").repartition(3))[1]
    read = warc.read_records(index)
    assert read.rdd.getNumPartitions() > 10
    best = {}
    for i, _, html in rows:
        if len(html.encode()) >= 1000:
            best[html] = max(i, best.get(html, i))
    got = {int(x.page_id): (x.record_type, x.refers_to, x.payload_bytes, x.payload) for x in read.collect()}
    for i, _, html in rows:
        to = best.get(html, i)
        assert got[i][:3] == ("response" if to == i else "revisit", None if to == i else str(to), len(html.encode()))
        assert to != i or bytes(got[i][3]) == html.encode()


def test_ranges_are_merged():
    rows = [{"path": "p", "offset": o, "length": 10} for o in (0, 11, 22, 1_000_000)] + [{"path": "q", "offset": 0, "length": 5}]
    assert [(p, o, n, len(g)) for p, o, n, g in warc.coalesced(rows)] == [("p", 0, 32, 3), ("p", 1_000_000, 10, 1), ("q", 0, 5, 1)]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def plain_terms(text):
    import regex

    return {signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in regex.split(imatch.SEPARATOR, text.lower()) if w}


def plain_lexicon(texts):
    n, df = len(texts), Counter()
    for t in texts:
        df.update(plain_terms(t or ""))
    return {w for w, c in df.items() if c >= 2 and imatch.BAND[0] <= np.log(n / c) <= imatch.BAND[1]}


def plain_lists(text, kept):
    """The sorted terms of a text in the whole lexicon and in each randomised one, seed by seed and level by level."""
    h = lambda data, seed: xxhash.xxh64_intdigest(data, seed)
    mine = plain_terms(text)
    mine = sorted(mine & kept or mine or {signed(h(text.encode(), 42))})
    out = [mine]
    for seed in range(1, imatch.SEEDS + 1):
        keys = {t: h(seed.to_bytes(4, "little"), h((t % (1 << 64)).to_bytes(8, "little"), 42)) for t in mine}
        out += [[t for t in mine if keys[t] >> (64 - 2 * level) == 0] for level in range(1, imatch.LEVELS + 1)]
    return out


def plain_fingerprint(text, kept):
    def digest(held):
        state = 42
        for t in held:
            state = xxhash.xxh64_intdigest((t % (1 << 64)).to_bytes(8, "little"), state)
        return state

    whole, *rest = plain_lists(text, kept)
    return f"{digest(whole):016X}" + "".join(f"{digest(x) >> 32:08X}" if x else "0" * 8 for x in rest)


def plain_likeness(a, b, kept):
    """From the term lists themselves."""
    x, y = plain_lists(a, kept), plain_lists(b, kept)
    if x == y:
        return 1.0
    at = lambda level: [(x[1 + s * imatch.LEVELS + level], y[1 + s * imatch.LEVELS + level]) for s in range(imatch.SEEDS)]
    for level, least in [*((n, imatch.SEEDS // 2) for n in range(imatch.LEVELS - 1, -1, -1)), (0, 1)]:
        held = [(p, q) for p, q in at(level) if p or q]
        if len(held) >= least:
            return sum(p == q for p, q in held) / len(held)
    return float(x[0] == y[0])


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_ROWS", 4)
    texts = [" ".join(words(60, i, 30)) for i in range(40)] + [None, "", "", "!!!", " ".join(words(20_000, 77, 4000)), "one", "Quite short, this!"]
    texts += [" ".join(words(120, 200 + i // 2, 12)[: 120 - i]) for i in range(30)]
    rows = [(i * 3, t, 1) for i, t in enumerate(texts)] + [(3, texts[1], 1), (3, texts[2], 1), (None, texts[3], 1), (None, texts[7], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    assert len(imatch.range_bounds(df, "doc_id")[0]) > 5
    got = imatch.compare_with_edited(df).collect()
    order = sorted(((-1 if i is None else i, t or "") for i, t, _ in rows))
    kept = plain_lexicon([t for _, t, _ in rows])
    assert len(kept) > 20
    want = Counter()
    for k, (i, t) in enumerate(order):
        q, nxt = len(t) // 4, order[(k + 1) % len(order)][1]
        edited = t[: len(t) - q] + nxt[:q]
        prints = [plain_fingerprint(x, kept) for x in (t, edited)]
        near = [round(plain_likeness(t, x, kept), 9) for x in (edited, nxt)]
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *prints, *near)] += 1
    assert want == Counter(
        (-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got
    )
    by_id = {r.doc_id: r.fingerprint for r in got}
    assert by_id[41 * 3] == by_id[42 * 3] == by_id[40 * 3]
    long = [r for r in got if r.n_chars > 300 and r.doc_id is not None and r.doc_id < 110]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long])
    assert imatch.compare_with_edited(df.limit(0)).count() == 0
    assert [(r.near_edited, r.near_next) for r in imatch.compare_with_edited(df.limit(1)).collect()][0][1] == 1.0
    plain = imatch.fingerprints(df).where("doc_id = 0").first()
    assert plain.fingerprint == 1 and plain.fingerprint_ == by_id[0]


def test_signatures_agree_exactly_where_the_filtered_terms_do(spark):
    r = random.Random(12)
    pool = words(90, 5, 40)
    texts = [" ".join(r.sample(pool, 40)) for _ in range(60)] + [" ".join(pool[:30]), " ".join(pool[29::-1]), " ".join(pool[:29])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [x.fingerprint for x in imatch.fingerprints(df).orderBy("doc_id").collect()]
    kept = plain_lexicon(texts)
    lists = [plain_lists(t, kept) for t in texts]
    cut = lambda f: [f[:16], *(f[i : i + 8] for i in range(16, len(f), 8))]
    agreed = 0
    for i in range(len(texts)):
        for j in range(i):
            same = [x == y for x, y in zip(cut(got[i]), cut(got[j]), strict=True)]
            assert same == [x == y for x, y in zip(lists[i], lists[j], strict=True)]
            agreed += sum(bool(x) and x == y for x, y in zip(lists[i], lists[j], strict=True))
    assert agreed > 100 and got[60] == got[61]


def shingle_set(text):
    w = [x.lower() for x in neardup.WORD.findall(text)]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_classes(rows):
    """Union of all pairs at 0.8 or more, and of equal words."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [None if t is None else shingle_set(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a is not None and b is not None and (not a and not b or a and b and len(a & b) / len(a | b) >= 0.8):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def near_rows():
    r = random.Random(4)
    rows = []
    base = words(120, 1000)
    for i in range(40):  # a large group of near copies, some only linked through others
        w = list(base)
        for _ in range(r.randrange(0, 4)):
            w[r.randrange(len(w))] = f"edit{i}x{r.randrange(99)}"
        rows.append(" ".join(w))
    for g in range(12):
        w = words(80, g)
        rows += [" ".join(w), " ".join(w).upper(), " ".join([*w[:40], "new", *w[40:]]), " ".join(words(80, 500 + g))]
    rows += ["one two three", "One two, three!", "", " ", None, None, "x", " ".join(["same"] * 300), " ".join(words(20_000, 7, 4000))]
    out = [(i, t) for i, t in enumerate(rows)]
    return [*out, (3, rows[60]), (None, rows[0]), (None, "only once here now and then"), (0, rows[0])]


@pytest.mark.parametrize("pairwise", [48, 2])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, pairwise):
    monkeypatch.setattr(neardup, "PAIRWISE", pairwise)
    monkeypatch.setattr(neardup, "BLOCK", 3 if pairwise == 2 else 192)
    rows = near_rows()
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, class_id int")
    got = neardup.classify(df).collect()
    assert len(got) == len(rows)
    roots = plain_classes(rows)
    least = {}
    for (i, _), root in zip(rows, roots, strict=True):
        least[root] = min((x for x in (least.get(root), i) if x is not None), default=None)
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, least[root]) for (i, _), root in zip(rows, roots, strict=True))
    kept = neardup.deduplicate(df)
    assert kept.columns == df.columns
    n_null = sum(t is None for _, t in rows)
    left = kept.collect()
    assert len(left) == len({r for r, (_, t) in zip(roots, rows, strict=True) if t is not None}) + n_null
    texts = [(r.doc_id, r.text) for r in left if r.text is not None]
    assert len(set(plain_classes(texts))) == len(texts)
    assert neardup.classify(df.limit(0)).count() == 0 and neardup.deduplicate(df.limit(0)).count() == 0


def test_copies_with_a_repeated_line_are_found(spark):
    rows = []
    for g in range(12):
        base = words(200, 3000 + g)
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(base + words(20, 4000 + g) * 50))]
    assert all(len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b)) >= 0.8 for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True))
    got = {r.doc_id: r.class_id for r in neardup.classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i // 2 * 2 for i, _ in rows}
    # at any number of repeats: nine of ten pairs at 0.82 meet in a band at least
    known = neardup._WordHash()
    for repeats in (1, 8, 60, 400):
        met = 0
        for g in range(60):
            base, line = words(184, 7000 + g, 4000), words(36, 8000 + g, 4000)
            pair = neardup._sets([" ".join(base + line), " ".join(base + line * repeats)], known)
            assert neardup.similarity(*map(np.unique, pair)) >= 0.8
            one, other = neardup.text_bands(pair)
            met += bool(set(one) & set(other))
        assert met >= 54, repeats
    # bands agree where the plain Jaccard similarity is high, also if both copies repeat other lines
    hash_sets = neardup._sets([" ".join(words(200, 1) + words(12, 2) * 40), " ".join(words(200, 1) + words(12, 3) * 40)], neardup._WordHash())
    one, other = neardup.text_bands(hash_sets)
    assert len(set(one)) == len(one) and set(one) & set(other)


def test_common_counts():
    r = random.Random(3)
    sets = [np.array(sorted(r.sample(range(60), r.randrange(1, 40))), dtype=np.uint64) for _ in range(12)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[5:]] for a in sets[:5]]
    assert neardup.common_counts(sets[:5], sets[5:], width=7).tolist() == want


def test_registers_estimate_probability_jaccard():
    r = random.Random(9)
    a = {i: r.choice([1.0, 2.0, 3.5]) for i in range(400)}
    b = {i: r.choice([1.0, 2.0]) for i in range(100, 480)}
    x = {np.uint64(k * 7919 + 13): v for k, v in a.items()}
    y = {np.uint64(k * 7919 + 13): v for k, v in b.items()}
    agree = []
    for salt in range(12):
        sig = []
        for s in (x, y):
            keys = neardup.mix(np.array(list(s), dtype=np.uint64) + np.uint64(salt * 104729))
            sig.append(neardup.signatures(np.zeros(len(keys), dtype=np.int64), keys, np.array(list(s.values())), 1)[0])
        agree.append(np.mean(sig[0] == sig[1]))
    assert abs(np.mean(agree) - neardup.probability_jaccard(a, b)) < 0.04


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = common.table(spark, sf, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        left = {r.doc_id for r in out.select("doc_id").collect()}
        assert left <= ids and len(left) >= 0.5 * len(ids), name
    toxic = {r.doc_id for r in common.table(spark, sf, "labels").where("toxic = 1").collect()}
    assert not toxic & {r.doc_id for r in corpus_pipeline.toxicity_stage(spark, docs, sf).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    roots = plain_classes(rows)
    best = {}
    for (i, _), root in zip(rows, roots, strict=True):
        best[root] = min(i, best.get(root, i))
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf).collect()} == set(best.values())
    final = corpus_pipeline.run(spark, sf).collect()
    text = dict(rows)
    assert final and all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in final)


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_stages_keep_odd_rows_and_foreign_columns(spark):
    sf = "/root/testdata/sf0.001"
    real = common.table(spark, sf, "documents").withColumns({"score": F.lit("mine"), "predicted": F.lit("p"), "lang_pred": F.lit("l")})
    odd = spark.createDataFrame([(9001, None), (9002, ""), (None, "Texte sans id ni langue, mais une phrase entière."), (9003, "12 !?")], "doc_id long, text string")
    docs = real.unionByName(odd, allowMissingColumns=True)
    clean = corpus_pipeline.toxicity_stage(spark, docs, sf)
    assert clean.columns == docs.columns and {r.score for r in clean.where("doc_id < 9000").collect()} == {"mine"}
    assert clean.where("doc_id > 9000 or doc_id is null").count() == 4
    told = corpus_pipeline.language_stage(spark, docs, sf)
    assert told.columns == docs.columns and {r.predicted for r in told.where("doc_id < 9000").collect()} == {"p"}
    assert told.where("doc_id > 9000").count() == 0
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, sf)
    assert kept.columns == docs.columns and kept.where("doc_id > 9000 or doc_id is null").count() >= 3
    bench = [r.text for r in common.table(spark, sf, "benchmark").limit(2).collect()]
    odd_rows = spark.createDataFrame([(9001, None), (9002, ""), (None, bench[0]), (9004, bench[1]), (9005, "12 !?"), (9005, "12 !?"), (9006, "wort " * 60_000)], "doc_id long, text string")
    clean = corpus_pipeline.decontamination_stage(spark, odd_rows.withColumn("hash", F.lit("mine")), sf)
    assert sorted((r.doc_id, r.hash) for r in clean.collect()) == [(i, "mine") for i in (9001, 9002, 9005, 9005, 9006)]
    coded = corpus_pipeline.tokenization_stage(spark, odd_rows.withColumn("n_tokens", F.lit("mine")), sf)
    assert coded.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((r.doc_id or 0, r.decoded_sha256) for r in coded.collect()) == sorted((r.doc_id or 0, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd_rows.collect())
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_scratch_tables_go(spark):
    folder = Path(common.scratch_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    df = spark.createDataFrame(near_rows(), "doc_id long, text string")
    assert neardup.classify(df).count() == len(near_rows())
    left = [p.name for p in set(folder.iterdir()) - before]
    assert len(left) == 1 and left[0].startswith("named-")


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    result = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    plain = lambda rows: sorted(tuple(str(r[i]) for i in at) for r in rows)
    at = [names.index(c) for c in sorted(names)]
    want = plain(result.fetchall())
    at = [df.columns.index(c) for c in sorted(names)]
    assert plain(df.collect()) == want
