"""Near-duplicates by ProbMinHash, banding and verification.

A text's shingles are its runs of five words (lower-cased letters and digits), weighted by 1 + log2(count). ProbMinHash:
every shingle arrives at random registers as a Poisson process with its weight as the rate; a register keeps the shingle
that arrives first. Arrivals are made in rounds for all shingles of a block of texts at once, and a shingle stops when
its next arrival is later than all registers' first ones. Two texts agree in a register with their probability Jaccard
similarity. Registers are cut into bands; texts that agree in a whole band are candidates.

Links are verified by the plain Jaccard similarity, which a shingle repeated in one copy only leaves high while it lowers
the weighted one. A text with a repeated shingle therefore has a second row of registers with all weights 1, which agree
with the plain Jaccard similarity; where no shingle repeats both rows are the same. All texts so meet by equal weights.

Texts with equal words are one node. In each band's bucket every node is compared with the bucket's leaders (the first
nodes by three random orders that hold for all buckets), links that reach the threshold join nodes to classes, and then
each bucket that still holds several classes is compared node by node across classes, until no pair of a bucket is left
undecided: classes are those that comparing all pairs of all buckets would give. A comparison is the exact Jaccard
similarity of the two sets of shingles. Classes come from repeated spreading of the least label over links, in tables.

Recall: banding by equal weights misses a pair at exactly 0.8 with a probability of (1 - 0.8**5)**24, 7e-5, and one at more
with less, whatever repeats in either text.

Defined results: texts of any length are read whole; texts under five words have one shingle, all their words; texts
without words, all alike, form one class, as equal texts do; null texts are singletons; a class is named by its least id
(null if all are null), and of rows that tie on that id the one with the least text stays; rows that share an id keep
their own texts and classes; other columns are carried along or ignored, whatever their names; an empty table gives an
empty result.

Tables in the shared folder are deleted as soon as no result depends on them: what is left is the result's own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterframe.llm.common import append_columns, bitmap_of, blocks, bounded_batches, discard, materialize

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
LEADERS = 3
BITMAP_BITS = 24
#: Nodes of a bucket that are compared pair by pair; larger buckets are cut into blocks of about BLOCK.
PAIRWISE, BLOCK = 48, 192
WORD = re.compile(r"[^\W_]+")
_M = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Links:
    """rows: id and node; links: a, b, similarity of nodes; classes: node and label of all nodes that have a link."""

    rows: DataFrame
    links: DataFrame
    classes: DataFrame
    tables: tuple[DataFrame, ...]

    def discard(self) -> None:
        """Deletes the tables behind it."""
        discard(self.rows, self.classes, *self.tables)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        raw = word.encode("utf-8", "surrogatepass")
        h = crc32(raw) << 32 | crc32(raw, 0x5BD1E995)
        self[word] = h
        return h


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hash of each run of five word hashes; of all words together, where they are fewer."""
    if not len(hashes):
        return hashes
    width = min(WORDS, len(hashes))
    h = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        h = mix(h * _M + hashes[i : len(hashes) - width + 1 + i])
    return h


def weighted(all_shingles: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, shingle and weight of each distinct shingle of each document, in that order."""
    sets = [np.unique(s, return_counts=True) for s in all_shingles]
    doc = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    values = np.concatenate([s for s, _ in sets]) if sets else np.empty(0, np.uint64)
    counts = np.concatenate([c for _, c in sets]) if sets else np.empty(0, np.int64)
    return doc, values.astype(np.uint64), 1 + np.log2(np.maximum(counts, 1))


def band_hashes(kept: np.ndarray) -> np.ndarray:
    """A hash of each band of each row of registers."""
    h = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(kept), 1))
    for r in range(ROWS):
        h = mix(h * _M + kept[:, r::ROWS])
    return h.view(np.int64)


def text_bands(all_shingles: list[np.ndarray]) -> list[list[int]]:
    """Distinct band hashes of each text, by weights and by equal weights; none for a text without words."""
    n = len(all_shingles)
    doc, values, weights = weighted(all_shingles)
    by_weight = band_hashes(signatures(doc, values, weights, n)).tolist()
    repeats = np.unique(doc[weights > 1])
    number = np.full(n, -1)
    number[repeats] = np.arange(len(repeats))
    of = number[doc] >= 0
    equal = band_hashes(signatures(number[doc[of]], values[of], np.ones(of.sum()), len(repeats))).tolist()
    for i, row in zip(repeats.tolist(), equal, strict=True):
        by_weight[i] = list(dict.fromkeys(by_weight[i] + row))
    return [row if len(s) else [] for row, s in zip(by_weight, all_shingles, strict=True)]


def signatures(doc: np.ndarray, values: np.ndarray, weights: np.ndarray, n_docs: int) -> np.ndarray:
    """The first shingle to arrive at each register, a row per document (0 where it has no shingle)."""
    first = np.full((n_docs, REGISTERS), np.inf)
    kept = np.zeros((n_docs, REGISTERS), dtype=np.uint64)
    time = np.zeros(len(values))
    state = mix(values + np.uint64(0x1F83D9ABFB41BD6B))
    while len(values):
        state = mix(state + _M)
        uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        time = time - np.log(uniform) / weights
        register = (mix(state ^ np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(REGISTERS)).astype(np.int64)
        place = doc * REGISTERS + register
        # the earliest arrival at each register; ties, if ever, by shingle
        flat, owner = first.reshape(-1), kept.reshape(-1)
        order = np.lexsort((values, time))
        places, at = np.unique(place[order], return_index=True)
        best = order[at]
        sooner = time[best] < flat[places]
        flat[places[sooner]], owner[places[sooner]] = time[best[sooner]], values[best[sooner]]
        alive = time < first.max(axis=1)[doc]
        doc, values, weights, time, state = doc[alive], values[alive], weights[alive], time[alive], state[alive]
    return kept


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of shingles."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def probability_jaccard(a: dict[int, float], b: dict[int, float]) -> float:
    """What the registers estimate: sum over common shingles of 1 / sum over all of the larger weight ratio."""
    every = a.keys() | b.keys()
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in every) for d in a.keys() & b.keys())


def _sets(texts: list[str | None], known: _WordHash) -> list[np.ndarray]:
    found = []
    for text in texts:
        words = WORD.findall((text or "").lower())
        found.append(shingles(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))))
    return found


def node_key(s: np.ndarray) -> bytes:
    """128 bits over a text's shingles in their order, that is over its words."""
    at = np.arange(1, len(s) + 1, dtype=np.uint64) * _M
    a, b = mix(s + at), mix(s ^ mix(at))
    return np.array([np.bitwise_xor.reduce(a) + np.uint64(len(s)), np.add.reduce(b)], dtype=np.uint64).tobytes()


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per document with a text: id, node (key of its words), band hashes (none for texts without words)."""
    bounded_batches(docs.sparkSession)
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, node binary, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            nodes: list[bytes] = []
            bands: list = []
            for lo, hi in blocks(texts):
                found = _sets(texts[lo:hi], known)
                nodes += map(node_key, found)
                bands += text_bands(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "node", "bands"]
            )

    given = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("__text"))
    return given.mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, text_col: str, members: DataFrame) -> DataFrame:
    """node, set: the sorted distinct shingles (as bytes) of each text whose node is a member.

    The texts are read again; a bitmap of the members, of fixed size, lets only their sets (and a few others) leave the
    scan, and a join then keeps the members.
    """
    import xxhash

    shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(members, F.xxhash64("node"), BITMAP_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lately = _WordHash(), {}
        for batch in batches:
            nodes: list[bytes] = []
            sets: list[bytes] = []
            for s in _sets(batch.column("__text").to_pylist(), known):
                node = node_key(s)
                place = xxhash.xxh64_intdigest(node, 42) >> (64 - BITMAP_BITS)
                if int(shared.value[place >> 6]) >> (place & 63) & 1 and node not in lately:
                    lately = {} if len(lately) > 100_000 else lately
                    lately[node] = True
                    nodes.append(node)
                    sets.append(np.unique(s).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], names=["node", "set"])

    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("__text"))
    found = texts.mapInArrow(run, "node binary, set binary")
    return found.groupBy("node").agg(F.first("set").alias("set")).join(members, "node", "left_semi")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets' similarity reaches the threshold, with it."""
    wide = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b").select("a", "b", "set_b")
    wide = wide.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            as_sets = lambda c: [np.frombuffer(x, dtype=np.uint64) for x in batch.column(c).to_pylist()]  # noqa: B023, E731
            score = np.array([similarity(x, y) for x, y in zip(as_sets("set_a"), as_sets("set_b"), strict=True)])
            keep = pa.array(score >= threshold, pa.bool_())
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(score, pa.float64())], names=["a", "b", "similarity"])
            yield out.filter(keep)

    return wide.mapInArrow(run, "a binary, b binary, similarity double")


def common_counts(a: list[np.ndarray], b: list[np.ndarray], width: int = 16_384) -> np.ndarray:
    """Sizes of the intersections of each set of a with each of b, by products of incidence matrices in strips."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    cat = lambda sets: (np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
    (va, ra), (vb, rb) = cat(a), cat(b)
    shared = np.intersect1d(va, vb)
    ka, kb = np.searchsorted(shared, va), np.searchsorted(shared, vb)
    in_a = (ka < len(shared)) & (shared[np.minimum(ka, len(shared) - 1)] == va) if len(shared) else np.zeros(len(va), bool)
    in_b = (kb < len(shared)) & (shared[np.minimum(kb, len(shared) - 1)] == vb) if len(shared) else np.zeros(len(vb), bool)
    ka, ra, kb, rb = ka[in_a], ra[in_a], kb[in_b], rb[in_b]
    for lo in range(0, len(shared), width):
        x, y = np.zeros((len(a), width), dtype=np.float32), np.zeros((len(b), width), dtype=np.float32)
        at = (ka >= lo) & (ka < lo + width)
        x[ra[at], ka[at] - lo] = 1
        at = (kb >= lo) & (kb < lo + width)
        y[rb[at], kb[at] - lo] = 1
        out += x @ y.T
    return out


def compare_blocks(rest: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between the classes of large buckets: small nodes against all, block by block.

    A bucket's nodes are dealt to blocks of about BLOCK; each pair of blocks is one bounded group, compared by matrix
    products, and gives its links only. Takes band, node, label, small and n, the bucket's nodes.
    """
    blocks_of = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    dealt = rest.withColumn("own", F.pmod(F.xxhash64("node", "band"), blocks_of).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks_of - 1)))
    keyed = paired.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label", "small")
    schema = "a binary, b binary, similarity double"
    arrow = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])

    def compare(group: pa.Table) -> pa.Table:
        rows = group.select(["i", "j", "own", "node", "label", "small", "set"]).to_pylist()
        left = [r for r in rows if r["own"] == r["i"]]
        right = [r for r in rows if r["own"] == r["j"]]
        out: list[tuple] = []
        for x, y in ((left, right), (right, left)):
            x = [r for r in x if r["small"]]
            if not x or not y:
                continue
            sx, sy = ([np.frombuffer(r["set"], dtype=np.uint64) for r in side] for side in (x, y))
            both = common_counts(sx, sy)
            score = both / np.maximum(np.array([len(s) for s in sx])[:, None] + np.array([len(s) for s in sy]) - both, 1)
            for p, q in np.argwhere(score >= threshold).tolist():
                if x[p]["label"] != y[q]["label"]:
                    out.append((*sorted((x[p]["node"], y[q]["node"])), float(score[p, q])))
        cols = list(zip(*set(out), strict=True)) or [(), (), ()]
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return keyed.join(sets, "node").groupBy("band", "i", "j").applyInArrow(compare, schema).distinct()


def components(links: DataFrame, name: str = "labels") -> DataFrame:
    """node, label: the least node of its component, for each node that has a link.

    Every round takes the least label among a node and its neighbours and then that label's own label, so that labels
    travel in leaps; a round's labels are a table in the shared folder.
    """
    both = materialize(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), f"{name}-edges")
    labels = table = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), name)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        leap = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        following = step.join(leap, "mid").select("node", "old", F.least("mid", "far").alias("label"))
        following = materialize(following, name)
        discard(table)
        table = following
        changed = following.where(F.col("old") != F.col("label")).limit(1).count()
        labels = following.select("node", "label")
        if not changed:
            discard(both)
            labels._scratch_path = table._scratch_path
            return labels


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> Links:
    rows = materialize(sketch(docs, id_col, text_col), "sketch")
    nodes = rows.groupBy("node").agg(F.first("bands").alias("bands"))
    banded = nodes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets = materialize(banded.join(shared, "band"), "buckets")
    orders = [F.struct(F.xxhash64("node", F.lit(i)).alias("o"), F.col("node")) for i in range(LEADERS)]
    leaders = buckets.groupBy("band").agg(F.array_distinct(F.array(*[F.min(o)["node"] for o in orders])).alias("leaders"))
    pairs = buckets.join(leaders, "band").select("node", F.explode("leaders").alias("leader")).where("node != leader")
    pairs = materialize(pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct(), "pairs")
    members = materialize(buckets.select("node").distinct(), "members")
    sets = materialize(shingle_sets(docs, text_col, members), "sets")
    links = materialize(verified(pairs, sets, threshold), "links")

    # buckets that aren't one class yet: nodes outside the bucket's largest class against all of other classes
    labels = components(links, "labels")
    named = buckets.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    sizes = named.groupBy("band", "label").agg(F.count("*").alias("n"))
    split = sizes.groupBy("band").agg(
        F.count("*").alias("classes"), F.sum("n").alias("n"), F.max(F.struct("n", "label"))["label"].alias("largest")
    ).where("classes > 1").select("band", "n", "largest")
    rest = materialize(named.join(split, "band").select("band", "node", "label", (F.col("label") != F.col("largest")).alias("small"), "n"), "rest")
    few = rest.where(F.col("n") <= PAIRWISE)
    small = few.where("small").select("band", F.col("node").alias("x"), F.col("label").alias("lx"))
    others = few.select("band", F.col("node").alias("y"), F.col("label").alias("ly"), (~F.col("small")).alias("large"))
    across = small.join(others, "band").where((F.col("lx") != F.col("ly")) & (F.col("large") | (F.col("x") < F.col("y"))))
    across = across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    more = materialize(verified(across.join(pairs, ["a", "b"], "left_anti"), sets, threshold), "links")
    many = materialize(compare_blocks(rest.where(F.col("n") > PAIRWISE), sets, threshold), "links")
    discard(buckets, pairs, members, sets, labels, rest)
    every = links.unionByName(more).unionByName(many)
    return Links(rows, every, components(every, "classes"), (links, more, many))


def named_classes(found: Links) -> DataFrame:
    """A row per document with a text: id, node, label (the class's key), class_id (its least id)."""
    least = found.rows.groupBy("node").agg(F.min("id").alias("id"))
    labelled = least.join(found.classes, "node", "left").select("node", "id", F.coalesce("label", "node").alias("label"))
    names = labelled.groupBy("label").agg(F.min("id").alias("class_id"))
    by_node = labelled.select("node", "label").join(names, "label")
    return found.rows.join(by_node, "node").select("id", "node", "label", "class_id")


def _named(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """``named_classes`` as a table, with all others gone."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, threshold=threshold)
    named = materialize(named_classes(found), "named")
    found.discard()
    return named


def classify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row per document: its id and class_id."""
    found = _named(docs, id_col, text_col, threshold)
    alone = docs.where(F.col(text_col).isNull()).select(F.col(id_col), F.col(id_col).alias("class_id"))
    return found.select(F.col("id").alias(id_col), "class_id").unionByName(alone)


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class: that with the class's least id; all documents without a text."""
    from pyspark.sql import Window

    classes = _named(docs, id_col, text_col, threshold)
    keepers = classes.where("id = class_id").select(F.col("id").alias("__id")).distinct()
    repeated = classes.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null").select(F.col("id").alias("__id"))
    repeated = materialize(repeated, "repeated")
    with_text = docs.where(F.col(text_col).isNotNull())
    without = docs.where(F.col(text_col).isNull())
    # the ids that stay are about as many as the documents: both sides are dealt by id at any size
    single = with_text.join(keepers.join(repeated, "__id", "left_anti").hint("merge"), F.col(id_col) == F.col("__id"), "left_semi")
    if repeated.isEmpty():
        return single.unionByName(without)
    # rows that share an id, or have none, are told apart by their text
    unclear = with_text.join(repeated, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    keyed = append_columns(unclear, [("__node", "binary")], text_col, lambda: lambda texts: [[node_key(s) for s in _sets(texts, _WordHash())]])
    of_node = classes.groupBy(F.col("node").alias("__node")).agg(F.first("label").alias("__label"), F.first("class_id").alias("__class"))
    first = Window.partitionBy("__label").orderBy(text_col)
    chosen = keyed.join(of_node, "__node").where(F.col(id_col).eqNullSafe(F.col("__class"))).withColumn("__n", F.row_number().over(first)).where("__n = 1")
    return single.unionByName(chosen.select(docs.columns)).unionByName(without)
