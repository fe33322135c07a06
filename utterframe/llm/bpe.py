"""Byte-level BPE encoding and decoding through a sentencepiece model built from the vocabulary.

The model is serialised directly: a piece per token, its bytes mapped to printable characters, its score the negative
rank, identity normalisation and no escaping of white space. Sentencepiece then merges by best score, leftmost first,
which is the order of ranks. Texts are split by the vocabulary's pattern, each pre-token is encoded by itself (a
pre-token that is a token is that token, as in the tiktoken library), and ids decode by the inverse mapping.

Defined results: a null or empty text has no ids; texts of any length are encoded whole; of two merges that tie the left
one comes first, as in the tiktoken library; repeated rows get equal results; a column of the input named like an output
stays, and the output's name gets an underscore (``n_tokens_``); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterframe.llm.common import append_columns, blocks, bounded_batches, free_name

#: Byte b stands for the character with this code point: printable, and no white space.
BYTE_TABLE = {b: chr(0x100 + b) for b in range(256)}
#: Letters, digits and white space among the characters that ``UNUSUAL`` doesn't name.
_L = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u02af"
_S = "\\t-\\r\\x20\\xa0"
#: The usual pattern in the faster standard library, right for texts without unusual characters.
PLAIN = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^{_S}{_L}0-9]+|[{_S}]+(?![^{_S}])|[{_S}]+"
UNUSUAL = re.compile(r"[^\t-\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u02af\u2010-\u2027]")
GPT2_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens whose ids are kept at hand.
CACHE = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def serialize_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto; id 0 is unknown, the token that is n-th by rank has id n + 1."""
    piece = lambda text, score, kind: _field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + b"\x18" + _varint(kind)
    out = [_field(1, piece("<unk>", 0.0, 2))]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        out.append(_field(1, piece(token.decode("latin-1").translate(BYTE_TABLE), -float(rank), 1)))
    trainer = b"\x18\x02" + b"\x20" + _varint(len(ranks) + 1)  # model type BPE, vocabulary size
    normalizer = _field(1, b"identity") + b"\x18\x00\x20\x00\x28\x00"  # no dummy prefix, keep and don't escape white space
    return b"".join([*out, _field(2, trainer), _field(3, normalizer)])


class ByteBpe:
    """Encodes and decodes with one vocabulary and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.ranks = ranks
        self.by_rank = sorted(ranks.values())
        self.token_of = {rank: token for token, rank in ranks.items()}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialize_model(ranks))
        self.split = regex.compile(pattern).findall
        self.plain = re.compile(PLAIN).findall if pattern == GPT2_PATTERN else None
        self._forget()

    def _forget(self) -> None:
        #: A number for each pre-token met, given when it is first looked up; the ids of all of them, end to end.
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.ids = np.empty(0, dtype="<u4")
        self.ends = np.zeros(1, dtype=np.int64)

    def pre_tokens(self, text: str) -> list[str]:
        if self.plain and not UNUSUAL.search(text):
            return self.plain(text)
        return self.split(text)

    def encode_pre_tokens(self, tokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token: its own rank if it is a token, else what sentencepiece merges."""
        raws = [t.encode("utf-8", "replace") for t in tokens]
        out = [self.ranks.get(raw) for raw in raws]
        split = [i for i, rank in enumerate(out) if rank is None]
        out = [[rank] for rank in out]
        merged = self.model.encode([raws[i].decode("latin-1").translate(BYTE_TABLE) for i in split], out_type=int, num_threads=1) if split else []
        rank_of = self.by_rank
        for i, ids in zip(split, merged, strict=True):
            out[i] = [rank_of[x - 1] for x in ids]
        return out

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for lo, hi in blocks(texts):
            if len(self.number) > CACHE:
                self._forget()
            known, lookup = len(self.number), self.number.__getitem__
            split = [np.fromiter(map(lookup, t), dtype=np.int64, count=len(t)) for t in map(self.pre_tokens, texts[lo:hi])]
            if len(self.number) > known:
                new = self.encode_pre_tokens(list(islice(reversed(self.number), len(self.number) - known))[::-1])
                sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
                self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(new), dtype="<u4", count=int(sizes.sum())))
                self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes))
            for tokens in split:
                first, size = self.ends[tokens], self.ends[tokens + 1] - self.ends[tokens]
                out = np.repeat(first - np.cumsum(size) + size, size)
                out += np.arange(len(out))
                yield self.ids[out].tobytes()

    def encode(self, text: str) -> list[int]:
        return list(memoryview(next(self.encode_batch([text]))).cast("I"))

    def decode_packed(self, packed: bytes) -> bytes:
        return b"".join(map(self.token_of.__getitem__, memoryview(packed).cast("I")))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def load(vocabulary: str, pattern: str | None = None) -> ByteBpe:
    """The encoder for a ``public_tokenizers`` rank file, one in each Python process."""
    import public_tokenizers

    key = (vocabulary, pattern or public_tokenizers.PATTERN)
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(read_ranks(public_tokenizers.path(vocabulary)), key[1])
    return _LOADED[key]


def encode_documents(df: DataFrame, text_col: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken", *, keep_ids: bool = True) -> DataFrame:
    """Adds ids (array<int>, unless not kept), n_tokens and ids_sha256."""
    ids_field = [("ids", "array<int>")] if keep_ids else []

    def start():
        bpe = load(vocabulary)

        def work(texts: list[str | None]) -> list[list]:
            packed = list(bpe.encode_batch([t or "" for t in texts]))
            ids = [[list(memoryview(p).cast("i")) for p in packed]] if keep_ids else []
            return [*ids, [len(p) // 4 for p in packed], [hashlib.sha256(p).hexdigest() for p in packed]]

        return work

    return append_columns(df, [*ids_field, ("n_tokens", "long"), ("ids_sha256", "string")], text_col, start)


def decode_documents(df: DataFrame, ids_col: str = "ids", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Adds decoded (binary): the bytes of the ids."""
    from pyspark.sql import types as T

    bounded_batches(df.sparkSession)
    name = free_name("decoded", df.columns)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            decoded = [bpe.decode(ids or []) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, text_col: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256: encodes each text, decodes the ids, and hashes both."""

    def start():
        bpe = load(vocabulary)

        def work(texts: list[str | None]) -> list[list]:
            packed = list(bpe.encode_batch([t or "" for t in texts]))
            sha = lambda b: hashlib.sha256(b).hexdigest()
            return [[len(p) // 4 for p in packed], [sha(p) for p in packed], [sha(bpe.decode_packed(p)) for p in packed]]

        return work

    fields = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    return append_columns(df, fields, text_col, start)


def token_share(df: DataFrame, by: str) -> DataFrame:
    """Tokens, documents and mean tokens of each value of ``by``, from encoded documents."""
    return df.groupBy(by).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.avg("n_tokens").alias("mean_tokens"))
