"""Benchmark decontamination by template windows and plain windows.

Texts become typed tokens: numbers, names and units turn into placeholders that keep their value as a slot, other words
stay, lower-cased. Windows of five tokens, at least three of them words, are hashed and joined between benchmark and
documents; so are windows of any five plain tokens, whatever their case, which find copies word for word where case turns
words into names or slots stand close. Windows are grouped by alignment (place in the document less place in the item). If
the slots of an alignment map one value of the item to two values of the document, the windows that hold such a value in
another form than the item's don't count; windows with the item's values always do. An item leaks into a document where
the remaining windows cover at least ``COVERAGE`` of its template windows, or of all its windows; it is ``exact`` if all
their slot values are the item's, else ``reparameterised``.

An item under five tokens is one plain window of all its tokens; one of one or two tokens is only found where it stands
between ends of sentences, since any text may hold the words.

A bitmap of the benchmark's window hashes, of fixed size whatever the benchmark's, lets the scan of the documents drop
windows that cannot join; those that pass meet the benchmark in an equi-join.

Slots are checked within one alignment and from the item's values to the document's: two values of an item may become one
in a document, as they may in a question asked with other numbers.

Defined results: null and empty texts, and those without a word or number, have no windows; texts of any length are read
whole; a document is an id (or null) with a text, so that rows that share an id, or have none, are judged and reported
apart; of two ways to cover an item that tie the one with more windows is reported; repeated documents report once,
repeated items once by item_id; other columns are ignored, or kept by ``decontaminate``, whatever their names; empty
tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterframe.llm.common import bitmap_of, blocks, bounded_batches

WINDOW, LITERALS, COVERAGE = 5, 3, 0.6
BITMAP_BITS = 22

#: A number or a word, with the end of a sentence before it, if there is one.
TOKEN = re.compile(r"(?:[.!?:\n][^\w]*)?(?:\d+(?:[.,]\d+)*|[^\W\d_]+)")
BODY = re.compile(r"[^\W_].*$", re.DOTALL)
TEXT_START = "."

#: Units that follow numbers.
UNITS = frozenset(
    "mm cm km inch inches foot feet ft yard yards mile miles mg kg gram grams kilogram kilograms ton tons pound pounds "
    "lb lbs oz ounce ounces ml liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours "
    "day days week weeks month months year years dollar dollars cent cents euro euros usd eur percent degree degrees "
    "celsius fahrenheit meter meters metre metres kilometer kilometers kilometre kilometres mph kph watt watts volt volts "
    "joule joules newton newtons hz bytes kb mb gb tb".split()
)
#: Numbers written as words.
NUMBER_WORDS = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
#: Given names that count as names at the start of a sentence too, where every word is capitalised.
GIVEN_NAMES = frozenset(
    "james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph jessica "
    "thomas sarah charles karen daniel lisa matthew nancy anthony betty mark sandra paul ashley steven kimberly andrew "
    "emily kenneth donna joshua michelle kevin carol brian amanda george melissa edward deborah ronald stephanie tim tom "
    "anna bob alice jane jack peter maria sam ben lucy emma olivia liam noah ava sophia mia jose juan carlos luis pierre "
    "marie hans klaus".split()
)


def canonical(token: str) -> tuple[str, str | None]:
    """Template token and slot value (None for a plain word) of one match of ``TOKEN``."""
    starts = not token[0].isalnum()
    word = BODY.search(token)[0] if starts else token
    lowered = word.lower()
    if word[0].isdigit() or lowered in NUMBER_WORDS:
        return "<num>", lowered.replace(",", "") if word[0].isdigit() else lowered
    if lowered in UNITS:
        return "<unit>", lowered
    if word[0].isupper() and (lowered in GIVEN_NAMES or not starts and word[1:].islower()):
        return "<name>", lowered
    return lowered, None


def spelling(token: str) -> str:
    """A match of ``TOKEN`` as plain windows compare it: its word or number, whatever its case."""
    word = token if token[0].isalnum() else BODY.search(token)[0]
    return word.replace(",", "") if word[0].isdigit() else word.casefold()


class _Tokens(dict):
    """Match of ``TOKEN`` -> its number in template (hash of the template token, lowest bit set for plain words) and plain."""

    def __init__(self):
        from xxhash import xxh64_intdigest

        super().__init__()
        self.of = xxh64_intdigest
        self.template, self.plain = np.zeros(1 << 16, dtype=np.uint64), np.zeros(1 << 16, dtype=np.uint64)

    def __missing__(self, token: str) -> int:
        n = len(self)
        if n == len(self.plain):
            self.template, self.plain = np.append(self.template, np.zeros_like(self.template)), np.append(self.plain, np.zeros_like(self.plain))
        template, slot = canonical(token)
        spelt = spelling(token)
        self.plain[n] = h = self.of(spelt.encode("utf-8", "surrogatepass"))
        h = h if template == spelt else self.of(template.encode("utf-8", "surrogatepass"))
        self.template[n] = (h & ~1) | (slot is None)
        self[token] = n
        return n


def window_hashes(
    hashes: np.ndarray, ends: np.ndarray, width: int, seed: int, bitmap: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, text and hash of each window of ``width`` tokens that may be in the bitmap; ``ends`` is where texts end."""
    n = max(0, len(hashes) - width + 1)
    h = np.full(n, seed, dtype=np.uint64)
    for i in range(width):
        h ^= hashes[i : i + n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    at = np.arange(n)
    if bitmap is not None:
        bit = h >> np.uint64(64 - BITMAP_BITS)
        at = np.flatnonzero((bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1))
    row = np.searchsorted(ends, at, side="right")
    inside = at + width <= ends[row] if len(at) else np.zeros(0, dtype=bool)
    at, row = at[inside], row[inside]
    return at, row, h[at]


def slots(tokens: list[str]) -> list[str | None]:
    return [canonical(t)[1] for t in tokens]


def text_windows(texts: list[str | None], known: _Tokens, short: set[int] | None, bitmap: np.ndarray | None = None) -> Iterator[tuple]:
    """Kind, width, text, place, place in all tokens, hash of the texts' windows that may be in the bitmap, and all tokens.

    Texts under five tokens are one plain window as items (``short`` is None); documents have windows of the widths
    ``short`` instead, those under three tokens only where they stand between ends of sentences.
    """
    tokens_of = [TOKEN.findall(TEXT_START + t) if t else [] for t in texts]
    counts = np.array([len(t) for t in tokens_of], dtype=np.int64)
    tokens = list(chain.from_iterable(tokens_of))
    number = np.fromiter(map(known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(counts)
    template, plain = known.template[number], known.plain[number]
    at, row, h = window_hashes(template, ends, WINDOW, 0x5851F42D4C957F2D, bitmap)
    enough = sum((template[at + i] & np.uint64(1)).astype(np.int64) for i in range(WINDOW)) >= LITERALS
    at, row, h = at[enough], row[enough], h[enough]
    yield False, WINDOW, row, at - ends[row] + counts[row], at, h, tokens
    for width in range(1, WINDOW + 1):
        if width < WINDOW and short is not None and width not in short:
            continue
        at, row, h = window_hashes(plain, ends, width, 0x2545F4914F6CDD1D + width, bitmap)
        if width < WINDOW and short is None:
            keep = counts[row] == width
            at, row, h = at[keep], row[keep], h[keep]
        elif width < LITERALS:
            starts = np.array([not t[0].isalnum() for t in tokens] + [True])
            keep = starts[at] & starts[at + width]  # a text's first token starts a sentence too
            at, row, h = at[keep], row[keep], h[keep]
        yield True, width, row, at - ends[row] + counts[row], at, h, tokens


WINDOW_FIELDS = "hash long, plain boolean, in_template boolean, width int, at int, n_template int, n_plain int, slots array<string>"


def windows(
    df: DataFrame, id_col: str, text_col: str, out_id: str, bitmap: np.ndarray | None = None, short: set[int] | None = None
) -> DataFrame:
    """A row per window that may be in the bitmap: id, hash of the text, and WINDOW_FIELDS.

    Slot values are null for plain windows of documents (they are the item's), the numbers of windows are the item's.
    """
    bounded_batches(df.sparkSession)
    shared = None if bitmap is None else df.sparkSession.sparkContext.broadcast(bitmap)
    schema = f"{out_id} {df.schema[id_col].dataType.simpleString()}, text_hash long, {WINDOW_FIELDS}"
    kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Tokens()
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            rows: list[int] = []
            cols: list[list] = [[] for _ in kinds]
            for lo, hi in blocks(texts):
                if len(known) > 300_000:
                    known = _Tokens()
                total = np.zeros((2, hi - lo), dtype=np.int64)
                mine = list(text_windows(texts[lo:hi], known, short, None if shared is None else shared.value))
                for plain, _, row, *_ in mine if shared is None else ():
                    total[int(plain)] += np.bincount(row, minlength=hi - lo)
                for plain, width, row, at, place, h, tokens in mine:
                    rows += (row + lo).tolist()
                    values = [None] * len(h) if plain and shared is not None else [slots(tokens[i : i + width]) for i in place.tolist()]
                    more = (
                        h.view(np.int64).tolist(), [plain] * len(h), np.isin(place, mine[0][4]).tolist(), [width] * len(h), at.tolist(),
                        total[0][row].tolist(), total[1][row].tolist(), values,
                    )
                    for col, part in zip(cols, more, strict=True):
                        col += part
            picked = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(out_id).take(picked), batch.column("text_hash").take(picked), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=[out_id, "text_hash", *(f.split()[0] for f in WINDOW_FIELDS.split(", "))],
            )

    given = df.select(F.col(id_col).alias(out_id), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("__text"))
    return given.mapInArrow(run, schema)


def leaks_by_text(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", coverage: float = COVERAGE,
) -> DataFrame:
    """A row per document (id and hash of the text) and item that leaks into it."""
    once = benchmark.where(F.col(item_text_col).isNotNull()).dropDuplicates([item_col, item_text_col])
    items = windows(once, item_col, item_text_col, "item_id").withColumnsRenamed({"text_hash": "item_hash", "at": "item_at", "slots": "item_slots"})
    short = {r.width for r in items.where(F.col("width") < WINDOW).select("width").distinct().collect()}  # WINDOW - 1 at most
    found = windows(docs, id_col, text_col, "doc_id", bitmap_of(items, F.col("hash"), BITMAP_BITS), short).drop("in_template", "n_template", "n_plain", "width")
    joined = found.join(items, ["hash", "plain"]).withColumn("shift", F.col("at") - F.col("item_at"))
    zipped = F.arrays_zip("item_slots", F.coalesce("slots", "item_slots").alias("slots"))
    joined = joined.withColumn("pairs", F.array_distinct(F.filter(zipped, lambda p: p["item_slots"].isNotNull())))
    by_item = ["doc_id", "text_hash", "item_id", "item_hash", "n_template", "n_plain"]
    # of each alignment: the windows matched, each with its (item value, document value) pairs: as many as the item has
    aligned = joined.groupBy(*by_item, "shift").agg(F.collect_set(F.struct("item_at", "in_template", "pairs")).alias("w"))
    pairs = F.array_distinct(F.flatten("w.pairs"))
    repeated = lambda ps: F.filter(ps, lambda p: F.size(F.filter(ps, lambda q: q["item_slots"] == p["item_slots"])) > 1)
    other = lambda p: ~p["item_slots"].eqNullSafe(p["slots"])
    aligned = aligned.withColumn("clash", F.filter(repeated(pairs), other))
    aligned = aligned.withColumn("w", F.filter("w", lambda w: ~F.arrays_overlap(w["pairs"], F.col("clash"))))
    same = ~F.exists("w", lambda w: F.exists(w["pairs"], other))
    at = lambda w: F.array_distinct(F.transform(w, lambda x: x["item_at"]))
    places = aligned.select(
        *by_item, at(F.col("w")).alias("all"), at(F.filter("w", lambda x: x["in_template"])).alias("template"), same.alias("same")
    )
    distinct = lambda c: F.size(F.array_distinct(F.flatten(F.collect_set(c))))
    equal = lambda c: F.max(F.when(F.col("same"), F.size(c)).otherwise(0))
    covered = places.groupBy(*by_item).agg(
        distinct("all").alias("all"), distinct("template").alias("template"), equal("all").alias("same_all"), equal("template").alias("same_template")
    )
    shares = [
        F.struct(
            (F.col(n) / F.when(F.col(of) > 0, F.col(of))).alias("coverage"), F.col(n).cast("int").alias("matched_windows"),
            F.when(F.col(same_n) >= coverage * F.col(of), "exact").otherwise("reparameterised").alias("kind"),
        ) for n, same_n, of in (("template", "same_template", "n_template"), ("all", "same_all", "n_plain"))
    ]
    leaks = covered.select("doc_id", "text_hash", "item_id", F.greatest(*shares).alias("b")).where(F.col("b.coverage") >= coverage)
    return leaks.groupBy("doc_id", "text_hash", "item_id").agg(F.max("b").alias("b")).select(
        "doc_id", "text_hash", "item_id", "b.kind", "b.coverage", "b.matched_windows"
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """A row per document and item that leaks into it: doc_id, item_id, kind, coverage, matched windows."""
    return leaks_by_text(docs, benchmark, **columns).drop("text_hash")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows into whose text an item leaks, those without an id included."""
    leaks = leaks_by_text(docs, benchmark, id_col=id_col, text_col=text_col).select(F.col("doc_id").alias("__leak"), F.col("text_hash").alias("__hash"))
    here = docs[id_col].eqNullSafe(F.col("__leak")) & (F.xxhash64(docs[text_col]) == F.col("__hash"))
    return docs.join(leaks.distinct(), here, "left_anti")
