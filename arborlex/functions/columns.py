"""Column-level helpers (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for matching results.
FINGERPRINT_SALT = "i-love-nlp"


def salted_md5(text: Column, salt: str = FINGERPRINT_SALT) -> Column:
    """Hex MD5 of ``salt`` followed by the text."""
    return F.md5(F.concat(F.lit(salt), text))


def uniform(seed: str | Column, key: Column) -> Column:
    """Deterministic uniform draw in [0, 1) from the first 8 hex digits of md5(seed|key).

    Same bits in every engine, independent of partitioning and task retries.
    """
    seed_col = F.lit(seed) if isinstance(seed, str) else seed
    h = F.md5(F.concat(seed_col, F.lit("|"), key.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def py_str(tok: Column) -> Column:
    """Python ``repr`` of a string: single quotes unless it holds ' but no "."""
    esc = F.regexp_replace(tok, r"\\", r"\\\\")
    dq = F.concat(F.lit('"'), esc, F.lit('"'))
    sq = F.concat(F.lit("'"), F.regexp_replace(esc, "'", "\\\\'"), F.lit("'"))
    return F.when(tok.contains("'") & ~tok.contains('"'), dq).otherwise(sq)


def py_list(items: Column) -> Column:
    """Python ``str`` of a list from an array of already rendered items."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def manhattan(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """L1 distance of two points."""
    return F.abs(x1 - x2) + F.abs(y1 - y2)


def nearest_int(x: Column) -> Column:
    """Nearest grid point, ``int(x + 0.5)`` (truncation toward zero)."""
    return (x + F.lit(0.5)).cast("bigint")


def sign(x: Column) -> Column:
    """Sign with sign(0) = 1."""
    return F.when(x >= 0, F.lit(1)).otherwise(F.lit(-1))
