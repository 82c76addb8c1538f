"""Padded training batches.

Examples are numbered in a total order by a distributed index, grouped
``batch_size`` at a time, and every array is right-padded to its batch maximum.
The mask stays in edge form (padding adds no edges), so B5 costs nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import dense_index, tasks_for
from ..session import bounded, cut_lineage
from .trees import dense_row_line
from .vocab import IGNORE_ID

DEFAULT_BATCH_SIZE = 16
#: Cells of dense masks that a task writes.
CELLS_PER_TASK = 50_000_000
#: Bytes of text that are made at once.
BLOCK = 4 << 20


def pad(arr: Column, length: Column, fill) -> Column:
    """Right-pad an array to ``length``."""
    return F.concat(arr, F.array_repeat(F.lit(fill), length - F.size(arr)))


def assign_batches(examples: DataFrame, order: list[Column], batch_size: int = DEFAULT_BATCH_SIZE,
                   length_col: str = "n", keys: list[str] | None = None, cells: bool = False, together: bool = True) -> DataFrame:
    """B1: ``batch_id`` and the batch's longest example ``max_len``.

    The examples are made once (sorting them samples them first), and tasks follow the sum of their lengths, with ``cells`` also
    that of the squares.  ``keys`` names the columns that ``order`` reads: only these and the lengths are sorted and numbered, and the
    rest meets its batch by the row's number; without it whole examples are sorted.  A batch's rows lie in one task, unless ``together``
    is false.
    """
    row = F.monotonically_increasing_id()  # fixed by the checkpoint
    examples = cut_lineage(examples.withColumn("_row", row))
    n = F.greatest(F.col(length_col), F.lit(1)).cast("bigint")
    lengths, squares = examples.agg(F.sum(n), F.sum(n.cast("double") * n)).first()
    tasks = tasks_for(examples, lengths or 0)
    if cells:
        tasks = max(tasks, int((squares or 0) // CELLS_PER_TASK))
    held = examples if keys is None else examples.select(*dict.fromkeys([*keys, length_col, "_row"]))
    idx = dense_index(held, order, name="_i", tasks=tasks)
    b = idx.withColumn("batch_id", F.floor(F.col("_i") / batch_size).cast("bigint")).repartition(tasks, "batch_id")
    # a batch has at most batch_size rows: this window is bounded
    b = b.withColumn("max_len", F.max(length_col).over(Window.partitionBy("batch_id"))).drop("_i")
    if keys is None:
        return b.drop("_row")
    rows = examples.repartition(tasks, "_row").join(b.select("_row", "batch_id", "max_len").repartition(tasks, "_row"), "_row")
    return (rows.repartition(tasks, "batch_id") if together else rows).drop("_row")


def pad_batches(examples: DataFrame, pad_id: int, batch_size: int = DEFAULT_BATCH_SIZE,
                order: list[Column] | None = None, cells: bool = False, together: bool = True) -> DataFrame:
    """Examples ``(sent_id, input_ids, labels, position_ids)`` -> padded rows with batch ids; other columns stay as they are
    (``cells`` and ``together`` as in :func:`assign_batches`)."""
    ex = examples.withColumn("n", F.size("input_ids"))
    b = assign_batches(ex, order or [F.col("sent_id").asc()], batch_size, keys=None if order else ["sent_id"], cells=cells, together=together)
    m = F.col("max_len")
    own = {"input_ids": pad_id, "labels": IGNORE_ID, "position_ids": 0}
    return b.select(
        "batch_id", "sent_id", "n", "max_len", *(pad(F.col(c), m, fill).alias(c) for c, fill in own.items()),
        *(c for c in examples.columns if c not in own and c != "sent_id"))


def stack_batches(padded: DataFrame) -> DataFrame:
    """One row per batch with ordered lists of the padded columns (bounded by batch size)."""
    s = F.sort_array(F.collect_list(F.struct("sent_id", "input_ids", "labels", "position_ids")))
    return padded.groupBy("batch_id").agg(s.alias("rows"), F.max("max_len").alias("max_len")).select(
        "batch_id", "max_len",
        F.transform("rows", lambda r: r["sent_id"]).alias("sent_ids"),
        F.transform("rows", lambda r: r["input_ids"]).alias("input_ids"),
        F.transform("rows", lambda r: r["labels"]).alias("labels"),
        F.transform("rows", lambda r: r["position_ids"]).alias("position_ids"),
    )


def padded_dense_mask(mask: Column, length: Column) -> Column:
    """B5 export: zero-pad a dense n x n mask to length x length."""
    rows = F.transform(mask, lambda r: F.concat(r, F.array_repeat(F.lit(0.0).cast("float"), length - F.size(r))))
    zero_row = F.array_repeat(F.lit(0.0).cast("float"), length)
    return F.concat(rows, F.array_repeat(zero_row, length - F.size(mask)))


def padded_mask_lines(rows: Column, length: Column, sep: str = " ") -> Column:
    """B5 export: the lines of :func:`padded_dense_mask` in text, from rows ``array<struct<qi, ks>>``: each row is as long as
    the padded mask, and the rows below the last are zero."""
    below = F.repeat(F.lit(f"{sep}0.0"), length).substr(F.lit(len(sep) + 1), length * (len(sep) + 3))
    return F.concat(F.transform(rows, lambda x: dense_row_line(x["ks"], length, sep)),
                    F.array_repeat(below, length - F.size(rows)))


def mask_blocks(ki: np.ndarray, death: np.ndarray, closer: np.ndarray, n: int, length: int):
    """B5 export: the same lines from a packed mask's keys, as blocks ``uint8[rows, 4 * length]`` of a bounded size; every cell is
    four bytes, of which the last is the separator (a blank, also at a line's end)."""
    dies = np.zeros(length, np.int64)  # of a column that is no key: never live
    dies[ki] = death
    at, compose = np.arange(length), np.zeros(length, bool)
    compose[ki[closer]] = True
    step = max(1, BLOCK // (4 * max(1, length)))
    for first in range(0, length, step):
        q = np.arange(first, min(length, first + step))
        cells = np.full((len(q), length), _ZERO)
        real = q[q < n - 1]  # the last row and those below it are zero
        if len(real):
            row, own = real[:, None], compose[real]
            seen = (at < row) & (dies > row)
            seen[own] = dies == row[own]
            seen[np.arange(len(real)), real] = True
            cells[:len(real)] += seen
        yield cells.view(np.uint8)


_ZERO = np.frombuffer(b"0.0 ", "<u4")[0]  # a one differs by one in its first byte


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list column, each a view of its values."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum([0, *column.value_lengths().to_numpy(zero_copy_only=False)])
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _key_columns(keys: Column) -> list[Column]:
    return [keys[c].alias(c) for c in ("ki", "death", "closer")]


def padded_mask_rows(padded: DataFrame) -> DataFrame:
    """B5 export: ``(sent_id, qi, row_text)``, every line of the padded masks of ``padded(sent_id, max_len, n_in, keys)``."""
    rows = bounded(padded).select("sent_id", F.col("max_len").cast("int"), F.col("n_in").cast("int"), *_key_columns(F.col("keys")))
    return rows.mapInArrow(_mask_batches, "sent_id bigint, qi int, row_text string")


def _mask_batches(batches):
    for batch in batches:
        ids, length, n = (batch.column(i).to_pylist() for i in range(3))
        held, size = [], 0
        for s, ln, m, *keys in zip(ids, length, n, *map(_lists, batch.columns[3:]), strict=True):
            first = 0
            for block in mask_blocks(*keys, m, ln):
                rows, width = len(block), block.shape[1] - 1
                held.append((s, first, rows, width, np.ascontiguousarray(block[:, :width])))
                first, size = first + rows, size + rows * width
                if size >= BLOCK:
                    yield _mask_batch(held)
                    held, size = [], 0
        if held:
            yield _mask_batch(held)


def _mask_batch(held: list[tuple]) -> pa.RecordBatch:
    ids, firsts, rows, widths, texts = zip(*held, strict=True)
    lines = np.repeat(np.array(widths, np.int64), rows)
    ends = np.concatenate([[0], np.cumsum(lines)]).astype(np.int32)
    text = pa.StringArray.from_buffers(len(lines), pa.py_buffer(ends), pa.py_buffer(np.concatenate([t.ravel() for t in texts])))
    places = np.concatenate([np.arange(a, a + r, dtype=np.int32) for a, r in zip(firsts, rows, strict=True)])
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids, np.int64), rows)), pa.array(places), text], names=["sent_id", "qi", "row_text"])


def padded_masks_md5(batches: DataFrame, name: str = "attention_mask_md5") -> DataFrame:
    """B5, B6 export: ``batches`` with the MD5 of each batch's stacked masks in place of ``max_len`` and ``masks(n_in, keys)``, an array in the
    examples' order: lines joined by ``|``, examples by ``;``.  The text is hashed block by block and never whole."""
    names = [c for c in batches.columns if c not in ("max_len", "masks")]

    def run(parts):
        for part in parts:
            length, *cols = part.columns[len(names):]
            n, (ki, death, closer) = _lists(cols[0]), ([*map(_lists, map(pa.ListArray.flatten, cols[1:]))])
            out, at = [], 0
            for ln, sizes in zip(length.to_pylist(), n, strict=True):
                out.append(_masks_md5(ln, [(m, *x) for m, *x in zip(sizes, *(k[at:at + len(sizes)] for k in (ki, death, closer)), strict=True)]))
                at += len(sizes)
            yield pa.RecordBatch.from_arrays([*part.columns[:len(names)], pa.array(out, pa.string())], names=[*names, name])

    def of_keys(c):
        return F.transform("masks", lambda x: x["keys"][c]).alias(c)
    rows = bounded(batches).select(
        *names, F.col("max_len").cast("int"), F.col("masks.n_in").alias("n_in"), *map(of_keys, ("ki", "death", "closer")))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batches.select(*names).schema)
    return rows.mapInArrow(run, f"{kinds}, {name} string")


def _masks_md5(length: int, masks: list[tuple]) -> str:
    digest = hashlib.md5(usedforsecurity=False)
    for i, (n, ki, death, closer) in enumerate(masks):
        done = 0
        for block in mask_blocks(ki, death, closer, int(n), length):
            done += len(block)
            block[:, -1] = ord("|")
            text = block.ravel()
            if done == length:
                text[-1] = ord(";")
                text = text[:-1] if i == len(masks) - 1 else text
            digest.update(text)
    return digest.hexdigest()
