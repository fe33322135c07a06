"""Text expressions, equal to what Python's str methods and formatting give."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that end a sentence.
SENTENCE_END = ".!?。…؟।"
#: White space as str.strip sees it, as a pattern and as characters.
SPACES = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def normalize(text: Column) -> Column:
    """Letters, digits and underscores only, lower-cased."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}_]", ""))


def ends_sentence(text: Column, marks: Iterable[str] = SENTENCE_END) -> Column:
    """Whether the last character that isn't white space is a mark; only texts that end in white space are stripped."""
    last = F.right(text, F.lit(1))
    last = F.when(last.isin(*SPACES), F.right(strip(text), F.lit(1))).otherwise(last)
    return F.coalesce(last.isin(*marks), F.lit(False))


def or_unknown(speaker: Column) -> Column:
    return F.coalesce(F.nullif(speaker, F.lit("")), F.lit("UNKNOWN"))


def segment_id(video_id: Column, idx: Column) -> Column:
    """``<video>_<idx>`` with five digits at least."""
    return F.format_string("%s_%05d", video_id.cast("string"), idx)


def joined_text(words: Column) -> Column:
    """The words' texts with single spaces."""
    return strip(F.array_join(F.transform(words, lambda w: w["text"]), " "))


def fixed(value: Column, digits: int) -> Column:
    """A number with so many decimals, half to even on the binary value: neither format_number nor bround does that."""

    @F.pandas_udf("string")
    def as_text(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if pd.isna(v) else f"{v:.{digits}f}")

    return as_text(value.cast("double"))


def rounded(value: Column, digits: int) -> Column:
    @F.pandas_udf("double")
    def as_rounded(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if pd.isna(v) else round(v, digits)).astype("float64")

    return as_rounded(value.cast("double"))


def quoted(text: Column) -> Column:
    """Python's repr of a string without control characters."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    plain = F.concat(F.lit("'"), escaped, F.lit("'"))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(~F.contains(text, F.lit("'")), plain).when(~F.contains(text, F.lit('"')), double).otherwise(single)
