"""Document fingerprints by I-Match over randomised lexicons; DataFrame functions only.

A term is a run of letters and digits, lower-cased; terms are compared by a 64-bit hash. The lexicon keeps the terms whose
inverse document frequency ln(N / df) lies in ``BAND`` and that occur in two documents at least. The band is absolute, so
that a corpus that grows alike keeps its lexicon and the same text its fingerprint, and it bounds the lexicon: at most
exp(BAND[1]) terms for each term that a document has on average, whatever the number of documents.

Randomised lexicons are fixed for all documents: for each of ``SEEDS`` seeds, nested subsets that hold a 4th, 16th and so
on (``LEVELS`` of them) of the lexicon, by a hash of the term and the seed. A signature is the hash of all the text's sorted
distinct terms in one of these lexicons: two texts agree in it exactly if they have the same terms there. The fingerprint
is the signature by the whole lexicon and then those by all subsets, zeros where the text has no term in one.

Likeness is read at the sparsest level at which at least half of the seeds hold a term of either text, for there a
lexicon holds a few terms and survives some edits: it is the share of these seeds whose signatures agree. Where no level
is that full, the densest one that holds a term counts, and else the signature by the whole lexicon.

Defined results: a null text counts as empty; texts of any length are read whole; a text without a term of the lexicon is
fingerprinted on all its terms, one without terms on its characters; equal texts have equal fingerprints; rows that tie on
their id follow each other by text; null ids come first; a column of the input named ``fingerprint`` stays, and the output
is called ``fingerprint_``; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterframe.llm.common import constants, free_name

#: Inverse document frequency, ln(N / df), of the terms kept: in about one of 8 to one of 500 documents.
BAND = (2.0, 6.25)
SEEDS, LEVELS = 12, 6
#: Hexadecimal digits of the signature by the whole lexicon, and of the others.
WHOLE, PART = 16, 8
#: What separates terms.
SEPARATOR = r"[^\p{L}\p{N}]+"
#: Rows in a range of ids in which the next document is looked up, few enough that a hash deals the ranges evenly; ranges at
#: most; and sampled ids to a range.
RANGE_ROWS, MOST_RANGES, SAMPLED = 500, 1 << 16, 8


def bind(value: Column, then) -> Column:
    """``then(value)``, with value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def terms(text: Column) -> Column:
    """Distinct term hashes of a text."""
    words = F.filter(F.split(F.lower(text), SEPARATOR), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = BAND) -> Column:
    """The terms within the band, as a constant: a hash table whose bucket of a term is its lowest bits.

    Counted by term, with partial sums before the shuffle; only the terms in the band, whose number is bounded, leave it.
    """
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    # explode_outer: a plain explode would have the terms computed a second time, in a filter for empty arrays
    counted = texts.select(F.explode_outer(terms(F.col("__text"))).alias("term")).where("term is not null").groupBy("term").agg(F.count("*").alias("df"))
    total = docs.count()
    least, most = max(2, math.ceil(total / math.exp(band[1]))), math.floor(total / math.exp(band[0]))
    found = [r["term"] for r in counted.where(F.col("df").between(least, most)).select("term").collect()]
    size = 1 << max(0, (len(found) - 1).bit_length())
    buckets: list[list[int]] = [[] for _ in range(size)]
    for term in sorted(found):
        buckets[term & (size - 1)].append(term)
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<array<bigint>>")


def signatures(text: Column, words: Column) -> Column:
    """The signatures of a text as numbers: by the whole lexicon, then seed by seed and level by level, 0 for none."""
    mask = (F.size(words) - 1).cast("long")
    known = lambda t: F.array_contains(F.get(words, t.bitwiseAND(mask).cast("int")), t)

    def sparser(held: Column, seed: Column, level: int) -> Column:
        """Signatures of a seed from a level on; ``held`` are the text's terms in the lexicon before it."""
        inside = lambda t: F.shiftrightunsigned(F.xxhash64(t, seed), 64 - 2 * level) == 0
        own = lambda kept: F.array(F.shiftrightunsigned(F.xxhash64(kept), 64 - 4 * PART))
        here = lambda kept: F.concat(own(kept), sparser(kept, seed, level + 1)) if level < LEVELS else own(kept)
        none = F.array_repeat(F.lit(0).cast("long"), LEVELS - level + 1)
        return bind(F.filter(held, inside), lambda kept: F.when(F.size(kept) > 0, here(kept)).otherwise(none))

    def every(held: Column) -> Column:
        seeds = F.transform(F.sequence(F.lit(1), F.lit(SEEDS)), lambda s: sparser(held, s, 1))
        return F.concat(F.array(F.xxhash64(held)), F.flatten(seeds))

    def chosen(found: Column) -> Column:
        whole = F.when(F.size(found) > 0, found).otherwise(F.array(F.xxhash64(text)))
        return bind(F.filter(found, known), lambda kept: F.sort_array(F.when(F.size(kept) > 0, kept).otherwise(whole)))

    return bind(bind(terms(text), chosen), every)


def as_text(found: Column) -> Column:
    """The fingerprint: the signatures as hexadecimal digits."""
    parts = F.transform(F.slice(found, 2, SEEDS * LEVELS), lambda x: F.lpad(F.hex(x), PART, "0"))
    return F.concat(F.lpad(F.hex(F.get(found, F.lit(0))), WHOLE, "0"), F.array_join(parts, ""))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, from two texts' signatures: see the module's docstring."""

    def at_level(level: int) -> Column:
        """Of the seeds that hold a term of either text 1000 each, and 1 for each that agrees."""
        def add(n: Column, seed: Column) -> Column:
            x, y = F.get(a, seed * LEVELS + level), F.get(b, seed * LEVELS + level)
            return n + F.when(x == y, F.when(x != 0, 1001).otherwise(0)).otherwise(1000)

        return F.aggregate(F.sequence(F.lit(0), F.lit(SEEDS - 1)), F.lit(0), add)

    whole = (F.get(a, F.lit(0)) == F.get(b, F.lit(0))).cast("double")
    share = lambda least: lambda n: F.when(n >= 1000 * least, n % 1000 / F.floor(n / 1000))
    full = [bind(at_level(level), share(SEEDS // 2)) for level in range(LEVELS, 0, -1)]
    return F.when(a == b, 1.0).otherwise(F.coalesce(*full, bind(at_level(1), share(1)), whole))


def fingerprints(docs: DataFrame, text_col: str = "text", lexicon_of: DataFrame | None = None) -> DataFrame:
    """``docs`` with the column fingerprint; the lexicon is that of ``lexicon_of`` (docs, if none is given)."""
    words = lexicon(docs if lexicon_of is None else lexicon_of, text_col)
    return docs.withColumn(free_name("fingerprint", docs.columns), as_text(signatures(F.coalesce(F.col(text_col), F.lit("")), words)))


def range_bounds(docs: DataFrame, id_col: str) -> tuple[list, bool]:
    """Ids that begin the ranges, the least of all among them, and whether there are null ids.

    A sample by hash of the distinct ids, of a size that follows the ranges' number, is collected; it only shapes tasks.
    """
    row = docs.agg(F.count("*").alias("n"), F.min(id_col).alias("least"), F.max(F.col(id_col).isNull()).alias("nulls")).first()
    ranges = max(1, min(row["n"] // RANGE_ROWS, MOST_RANGES))
    share = min(1.0, SAMPLED * ranges / max(1, row["n"]))
    place = F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 11) / F.lit(2.0**53)
    sample = [r[0] for r in docs.where(F.col(id_col).isNotNull() & (place < share)).select(id_col).distinct().collect()] if ranges > 1 else []
    sample.sort()
    bounds = {*sample[SAMPLED::SAMPLED], *([] if row["least"] is None else [row["least"]])}
    return sorted(bounds), bool(row["nulls"])


def with_next(docs: DataFrame, id_col: str, order: list[str], carried: list[str], derive=lambda df: df) -> DataFrame:
    """Adds ``next``, a struct of ``carried`` from the next row by (id, order); the last row's is the first row.

    Rows are dealt once to ranges of ids of about RANGE_ROWS rows, whose number grows with the table. A range's last row
    finds its next in a copy of the first row of the range that follows, so that no task sees all rows. ``derive`` adds
    columns to rows once dealt.
    """
    bounds, nulls = range_bounds(docs, id_col)
    kind = docs.schema[id_col].dataType.simpleString()
    width = max(1, math.isqrt(len(bounds)))
    fine, coarse = constants(bounds or [0], kind), constants(bounds[::width] or [0], kind)
    key = F.col(id_col)
    upto = lambda values: F.size(F.filter(values, lambda b: b <= key))
    group = F.greatest(upto(coarse) - 1, F.lit(0))
    in_range = F.when(key.isNull(), 0).otherwise(bind(group, lambda g: g * width + upto(F.slice(fine, g * width + 1, F.lit(width)))))
    heads = docs.sparkSession.createDataFrame([(b, i + 1) for i, b in enumerate(bounds)], f"__id {kind}, __range int")
    firsts = docs.join(F.broadcast(heads), key == F.col("__id")).drop("__id")  # MOST_RANGES + 1 ids at most
    if nulls:
        firsts = firsts.unionByName(docs.where(key.isNull()).withColumn("__range", F.lit(0)))
    # of rows that share a first id the first by order: partial minima before the shuffle
    firsts = firsts.groupBy("__range").agg(F.min(F.struct(*order, *[c for c in docs.columns if c not in order])).alias("__row")).select("__row.*", "__range")
    first_range, last_range = (0 if nulls else 1), len(bounds)
    before = F.when(F.col("__range") == first_range, last_range).otherwise(F.col("__range") - 1)
    copies = firsts.select(*docs.columns, before.cast("int").alias("__range"), F.lit(1).alias("__copy"))
    both = docs.withColumns({"__range": in_range.cast("int"), "__copy": F.lit(0)}).unionByName(copies)
    dealt = derive(both.repartition(F.col("__range")))
    w = Window.partitionBy("__range").orderBy("__copy", F.col(id_col).asc_nulls_first(), *order)
    return dealt.withColumn("next", F.lead(F.struct(*carried)).over(w)).where("__copy = 0").drop("__copy", "__range")


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints each text and its edited form, whose last quarter is the beginning of the next document."""
    words = lexicon(docs, text_col)
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marked = lambda df: df.withColumn("own", signatures(F.col("text"), words))
    pairs = with_next(own, "doc_id", ["text"], ["text", "own"], marked)
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - quarter), F.substr(F.col("next.text"), F.lit(1), quarter))
    out = pairs.withColumn("__edited", edited).withColumn("other", signatures(F.col("__edited"), words))
    return out.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("__edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next.own")).alias("near_next"),
    )
