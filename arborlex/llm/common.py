"""Helpers shared by the operators: table reading, written tables in the shared folder, text kernels.

Intermediate tables go to a fresh sub-folder of ``spark.checkpoint.dir`` (the folder that all
executors of a cluster share).  A folder is made only where that setting is unset (tests).
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..session import bounded  # noqa: F401

#: The white space of the contracts: blank and the control characters 0x09 to 0x0D.
WS_CLASS = r"\x20\x09-\x0D"
WS_CHARS = " \t\n\x0b\x0c\r"

M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only where it is unset and the session is local (on a
    cluster an unset folder is an error)."""
    from ..session import ensure_checkpoint_dir
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: a lineage cut that survives
    lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_slices(texts, limit: int = 1 << 18):
    """Slices (start, stop) of a list of byte strings, about ``limit`` bytes each; a longer
    single text makes its own slice."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an array of uint64 (constants of the published generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MULT = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_MULT**i and its inverse modulo 2**64, i < n (kept and grown per process)."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(_MULT, -1, 1 << 64)
        _POWERS[:] = [np.multiply.accumulate(np.concatenate(
            [np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)])) for base in (_MULT, inverse)]
    return _POWERS[0], _POWERS[1]


def word_spans(texts: list[bytes], lower: bool = False):
    """Bytes of the texts joined by a blank, and per word: start, end, index of its text.

    Words are maximal runs of anything but ``[\\x20\\x09-\\x0D]``; bytes of UTF-8 sequences are
    never white space, so bytes and code points give the same words.
    """
    b = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    if lower:
        b = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    start, end = edge[0::2], edge[1::2]
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:-1]
    return b, start, end, np.searchsorted(begin, start, side="right") - 1


def word_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each byte span: polynomial prefix sums, then mixed with the length."""
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(b) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:len(b)])])
    h = (total[end] - total[start]) * inverse[start]
    return mix64(h ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word k-shingles of each text (A-Z lower-cased).

    A text of fewer words has its whole sequence as one shingle; a text without words none.
    """
    b, start, end, doc = word_spans(texts, lower=True)
    h = word_hashes(b, start, end)
    n = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
    first = np.concatenate([[0], np.cumsum(n)])
    step = np.uint64(0xC2B2AE3D27D4EB4F)
    acc = np.full(max(0, len(h) - k + 1), k, np.uint64)
    for j in range(k):
        acc = mix64(acc * step + h[j:j + len(acc)])
    out = []
    for i in range(len(texts)):
        lo, hi = first[i], first[i + 1]
        if hi - lo >= k:
            out.append(np.unique(acc[lo:hi - k + 1]))
        elif hi > lo:
            one = np.full(1, hi - lo, np.uint64)
            for x in h[lo:hi]:
                one = mix64(one * step + x)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
