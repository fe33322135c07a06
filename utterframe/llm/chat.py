"""Chat formatting by incremental black-box rendering.

The renderer is any function from a list of messages (and whether to open the assistant's next turn) to a string.
Each prefix of a conversation's turns is rendered and compared with the one before: where the new output begins with
the old one, the rest is the new turn's span; where it doesn't, the template rewrites history, which is recorded and
leaves the turns that were rewritten without a span. The text's place in a span is found the same way, from the prefix
with the next turn opened and from the turn rendered without its text.

The own template ``render`` marks turns by control strings and escapes these inside roles and texts, reversibly;
``parse`` reads the turns back.

Defined results: a null role or text counts as empty; turns of a conversation are ordered by turn, role and text, null
turns first, ties thus by what they say, and repeated rows stay repeated turns; a null conv_id is a conversation of its
own; texts of any length are rendered whole; other columns are ignored, whatever their names; an empty table gives an
empty result. A conversation is one output string and so must fit a task; rendering all its prefixes takes time in
proportion to its length times its turns, and memory for two of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterframe.llm.common import bounded_batches

Message = tuple[str, str]
Renderer = Callable[[list[Message], bool], str]

OPEN, HEAD, CLOSE = "### ", ": ", "</turn>\n"


def escape(text: str) -> str:
    """No ``#`` and no ``</turn>`` of the text stays as it is; a backslash is doubled."""
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</turn>", "<\\/turn>")


def unescape(text: str) -> str:
    parts = text.split("\\\\")
    return "\\".join(p.replace("<\\/turn>", "</turn>").replace("\\#", "#") for p in parts)


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def unescape_role(role: str) -> str:
    parts = role.split("\\\\")
    return "\\".join(p.replace("\\:", ":").replace("<\\/turn>", "</turn>").replace("\\#", "#") for p in parts)


def render(messages: list[Message], open_next: bool = False) -> str:
    turns = [f"{OPEN}{escape_role(role)}{HEAD}{escape(text)}{CLOSE}" for role, text in messages]
    return "".join(turns) + (f"{OPEN}assistant{HEAD}" if open_next else "")


def parse(formatted: str) -> list[Message]:
    """The turns of ``render``'s output."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn begins at {at}")
        end = formatted.index(CLOSE, at)
        head = formatted.index(HEAD, at)
        while formatted[head - 1] == "\\" and (head - len(formatted[:head].rstrip("\\"))) % 2:
            head = formatted.index(HEAD, head + 1)
        out.append((unescape_role(formatted[at + len(OPEN) : head]), unescape(formatted[head + len(HEAD) : end])))
        at = end + len(CLOSE)
    return out


@dataclass
class Rendered:
    formatted: str = ""
    #: (start, end) of each turn, None where a later turn rewrote it.
    spans: list[tuple[int, int] | None] = field(default_factory=list)
    #: (start, end) of the text in each assistant turn.
    loss: list[tuple[int, int]] = field(default_factory=list)
    #: Turns whose addition changed what was there.
    rewrites: list[int] = field(default_factory=list)


def common_prefix(a: str, b: str) -> int:
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return lo


def render_incrementally(messages: list[Message], renderer: Renderer = render, train_on: str = "assistant") -> Rendered:
    out = Rendered()
    inner: list[tuple[int, int] | None] = []
    for k, (role, text) in enumerate(messages):
        before, now = out.formatted, renderer(messages[: k + 1], False)
        start = len(before)
        if not now.startswith(before):
            out.rewrites.append(k)
            start = common_prefix(before, now)
            out.spans = [s if s and s[1] <= start else None for s in out.spans]
            inner = [s if s and s[1] <= start else None for s in inner]
        out.spans.append((start, len(now)))
        place = None
        if role == train_on:
            opened = renderer(messages[:k], True)
            empty = renderer([*messages[:k], (role, "")], False)
            if now.startswith(opened) and empty.startswith(opened):
                tail = len(empty) - len(opened)
                if now[len(now) - tail :] == empty[len(opened) :]:
                    place = (len(opened), len(now) - tail)
        inner.append(place)
        out.formatted = now
    out.loss = [s for s in inner if s]
    return out


SCHEMA = (
    "conv_id long, formatted string, n_turns long, spans array<struct<start:int,end:int>>, "
    "loss_spans array<struct<start:int,end:int>>, rewrites array<int>"
)


def format_conversations(df: DataFrame, renderer: Renderer = render) -> DataFrame:
    """A row per conversation: the formatted string, spans of turns and of what is trained on, rewriting turns."""
    bounded_batches(df.sparkSession)
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = df.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for turns in batch.column("turns").to_pylist():
                r = render_incrementally([(t["role"], t["text"]) for t in turns], renderer)
                pair = lambda s: None if s is None else {"start": s[0], "end": s[1]}
                rows.append((r.formatted, len(turns), [pair(s) for s in r.spans], [pair(s) for s in r.loss], r.rewrites))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.string(), pa.int64(), span, span, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(list(c), t) for c, t in zip(cols, types, strict=True))],
                names=["conv_id", "formatted", "n_turns", "spans", "loss_spans", "rewrites"],
            )

    return turns.mapInArrow(run, SCHEMA)


def digests(formatted: DataFrame) -> DataFrame:
    """Reads formatted conversations back: turns, what is trained on, and their hashes."""
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "n_rewrites long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n", "t", "lc", "ls", "fc")}
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode())
                for key, v in zip(out, (len(turns), sha.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)), strict=True):
                    out[key].append(v)
            n, t, lc, ls, fc = out.values()
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(n, pa.int64()), pa.array(t, pa.string()), pa.array(lc, pa.int64()),
                 pa.array(ls, pa.string()), pa.array(fc, pa.int64()), batch.column("n_rewrites")],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_rewrites"],
            )

    kept = formatted.select("conv_id", "formatted", "loss_spans", F.size("rewrites").cast("long").alias("n_rewrites"))
    return kept.mapInArrow(run, schema)
