"""Functions of the caller over batches of rows: a mapped dataset and a collator (``map(fn, batched=True)`` and its like).

``map_batches`` hands a function the columns of a batch as lists, as many rows at a time as asked for, and takes lists back; the
number of rows may change.  Rows stay where they are: nothing is shuffled, and a task holds one batch at a time.

``collate`` hands a function all rows of one batch, in order, and takes the rows that stand for it.  Batches are
bounded by their size, so is what one call sees.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

Columns = dict[str, list]


def _schema(schema: str | StructType) -> tuple[StructType, pa.Schema]:
    kind = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    return kind, to_arrow_schema(kind)


def map_batches(df: DataFrame, fn: Callable[[Columns], Columns], schema: str | StructType, batch_size: int = 1000) -> DataFrame:
    """``fn`` over every ``batch_size`` rows of a task (the last batch may be shorter); ``schema`` is that of what it returns."""
    kind, arrow = _schema(schema)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, batch_size - rows)
                held.append(part)
                rows += part.num_rows
                at += part.num_rows
                if rows == batch_size:
                    yield from _called(fn, pa.Table.from_batches(held), arrow)
                    held, rows = [], 0
        if rows:
            yield from _called(fn, pa.Table.from_batches(held), arrow)

    return df.mapInArrow(run, kind)


def _called(fn, table: pa.Table, arrow: pa.Schema):
    out = fn(table.to_pydict())
    yield from pa.table({f.name: pa.array(out[f.name], f.type) for f in arrow}, schema=arrow).to_batches()


def collate(df: DataFrame, fn: Callable[[list[dict]], list[dict]], schema: str | StructType, batch_col: str = "batch_id",
            order: list[str] | None = None) -> DataFrame:
    """``fn`` over the rows of each batch, as dictionaries, sorted by ``order`` (ascending, nulls last)."""
    kind, arrow = _schema(schema)

    def run(table: pa.Table) -> pa.Table:
        if order:
            table = table.sort_by([(c, "ascending") for c in order])
        return pa.Table.from_pylist(fn(table.to_pylist()), schema=arrow)

    return df.groupBy(batch_col).applyInArrow(run, kind)
