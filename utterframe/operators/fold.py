"""Order-dependent folds: rows of a key in order, streamed through a task that holds the fold's state only."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utterframe.session import ensure_importable


def in_order(df: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """``df`` with each key's rows in one partition, in order; adds __row.

    A window says so, not a repartition: rows that lie together already aren't shuffled again.
    """
    return df.withColumn("__row", F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def changes(column: pa.Array) -> np.ndarray:
    """Whether a row's value isn't that of the row before; the first row's is true."""
    new = np.ones(len(column), dtype=bool)
    a, b = column.slice(1), column.slice(0, max(0, len(column) - 1))
    same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
    if column.null_count:
        same = same | (a.is_null().to_numpy(zero_copy_only=False) & b.is_null().to_numpy(zero_copy_only=False))
    new[1:] = ~same
    return new


def whole_keys(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that hold all rows of their keys, which stand together; one key at least is in memory."""
    waiting: list[pa.RecordBatch] = []

    def joined() -> pa.RecordBatch:
        return waiting[0] if len(waiting) == 1 else pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        firsts = np.flatnonzero(changes(batch.column(key)))
        if waiting and batch.column(key)[0] != waiting[-1].column(key)[-1]:
            yield joined()
            waiting = []
        cut = int(firsts[-1])
        if cut:
            waiting.append(batch.slice(0, cut))
            yield joined()
            waiting = []
        waiting.append(batch.slice(cut))
    if waiting:
        yield joined()


class Fold:
    """``start`` before a key's first row, ``row`` for each, ``end`` after the last; each yields output rows."""

    def start(self) -> None: ...

    def row(self, row: dict[str, Any]) -> Iterator[tuple]:
        yield from ()

    def end(self) -> Iterator[tuple]:
        yield from ()


def ordered_fold(df: DataFrame, key: str, order: list[Column | str], fold: Callable[[], Fold], schema: str) -> DataFrame:
    """Runs a fold over each key's rows; the key comes first in every output row.

    At most one shuffle on the key and a sort within partitions; a key's rows need not fit in memory.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ensure_importable(df.sparkSession)
    key_type = df.schema[key].dataType
    out = T.StructType([T.StructField(key, key_type), *T._parse_datatype_string(schema).fields])
    arrow = to_arrow_schema(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, first, rows = fold(), None, True, []
        for batch in batches:
            for row in batch.to_pylist():
                if first or row[key] != current:
                    if not first:
                        rows += [(current, *r) for r in state.end()]
                    state.start()
                    current, first = row[key], False
                rows += [(current, *r) for r in state.row(row)]
            if len(rows) >= 5000:
                yield batch_of(rows)
                rows = []
        if not first:
            rows += [(current, *r) for r in state.end()]
        if rows:
            yield batch_of(rows)

    return in_order(df, key, order).mapInArrow(run, out)
