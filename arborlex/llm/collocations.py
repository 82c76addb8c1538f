"""Operator 11: phrase collocations by SETM relational mining.

Relations.  R1 holds the word occurrences of all texts, one per (piece, position); R2 the occurrences of
frequent word pairs.  They are persisted in *blocks*: a block has up to ``BLOCK`` consecutive places of one
language's texts in one task, sorted by place.  Places go up by one from word to word and skip one between
pieces, so two rows are neighbours in a piece exactly if their places differ by one.  A block that ends
inside a piece carries ``LONGEST - 1`` words of what follows, which count in the next block only; a
block thus has everything it needs, however long a piece is.

Mining.  R1 is grouped and counted; its rows of frequent words are semi-joined.  R2 is R1 merge-joined with itself
on the next place, grouped and counted, and semi-joined with its frequent groups; the triples are R2 merge-joined
with itself on the next place (two frequent pairs that share their middle word), grouped and counted.

Group counts are of the whole language.  Each block sends a group once, with its number and its local
number of the group; one shuffle by the group adds the numbers up and sends those of frequent groups back
to their blocks, under an id made of the group's first (block, local number).  So the hottest group has one
row a block, and no list of frequent groups is ever held whole anywhere.

Scores are exact: 1000000 * a * a and l * r are decimals of 38 digits (a up to 10**16).

Edge cases.  A null text has no words, a null lang is ``und``.  Repeated rows count again.  Empty tables give no
rows.  A text without pieces' separators or a word without end is taken whole.  Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, written

LEAST, TOP, LONGEST = 10, 2000, 3
BLOCK = 1 << 21
SLICE = 1 << 20
SALTS = 32
_LOCAL, _SEQ = 24, 16  # bits of a local number in a group's id, and of a block's number in its task

#: Separators of pieces become a line end, a tab a blank, and A-Z lower case: then words are what bytes.split() gives.
_FOLD = bytes.maketrans(b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * 9 + b" abcdefghijklmnopqrstuvwxyz")
_GAP = b"."  # no word has one
_BETWEEN = re.compile(rb"[ \n]")


class _Numbers(dict):
    """A number for each new key, from 1 on; the gap between pieces has 0."""

    def __init__(self):
        self[_GAP] = 0

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _slices(text: bytes):
    """The folded text in slices that end between words."""
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + SLICE)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


class _Block:
    """Word occurrences of one language in one task, until ``BLOCK`` places are full."""

    def __init__(self):
        self.numbers, self.parts, self.size = _Numbers(), [], 0

    def add(self, text: bytes, places: int):
        """Takes a text in; yields ``cut(places)`` whenever so many are full."""
        for part in (*_slices(text.translate(_FOLD)), b"\n"):
            ids = np.fromiter(map(self.numbers.__getitem__, part.replace(b"\n", b" . ").split()), np.int32)
            self.parts.append(ids)
            self.size += len(ids)
            while self.size >= places + LONGEST - 1:
                yield self.cut(places)

    def cut(self, places: int):
        """The first ``places`` places with the words that follow them, and the words by number; the rest stays."""
        ids = np.concatenate(self.parts)
        words = list(self.numbers)
        head, rest = ids[:places + LONGEST - 1], ids[places:]
        self.__init__()
        if len(rest):
            used, back = np.unique(rest, return_inverse=True)
            new = np.array([self.numbers[words[x]] for x in used], np.int32)
            self.parts, self.size = [new[back]], len(rest)
        return head, words


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2**32 by planes of bytes, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, size).T).view("<u4").ravel().astype(np.int64)


_R1 = "block bigint, lang string, local bigint, word string, n bigint, own bigint, size bigint, rows binary"
_R2 = "block bigint, local bigint, g1 bigint, g2 bigint, n bigint, own bigint, size bigint, rows binary"


def _chunks(columns: dict, size: int, most: int = 1 << 16):
    for at in range(0, size, most):
        yield pa.RecordBatch.from_pydict({k: v[at:at + most] for k, v in columns.items()})


def occurrences(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per block one row with its occurrences (``rows``), and one row per distinct word with its local number and count."""
    def rows(number: int, lang: str, ids: np.ndarray, words: list[bytes], own: int):
        counts = np.bincount(ids[:own], minlength=len(words))  # a word that only follows the block counts 0
        local = np.unique(ids[ids > 0]).astype(np.int64)
        n = len(local)
        yield from _chunks({
            "block": pa.array(np.full(n, number)), "lang": pa.array([lang] * n, pa.string()), "local": pa.array(local),
            "word": pa.array([words[x] for x in local], pa.binary()).cast(pa.string()), "n": pa.array(counts[local]),
            "own": pa.nulls(n, pa.int64()), "size": pa.nulls(n, pa.int64()), "rows": pa.nulls(n, pa.binary())}, n)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([number]), "lang": pa.array([lang], pa.string()), "local": pa.nulls(1, pa.int64()),
            "word": pa.nulls(1, pa.string()), "n": pa.nulls(1, pa.int64()), "own": pa.array([own]), "size": pa.array([len(ids)]),
            "rows": pa.array([pack(ids)], pa.binary())})

    def run(batches):
        from pyspark import TaskContext
        blocks: dict[str, _Block] = {}
        number = TaskContext.get().partitionId() << _SEQ
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                for ids, words in blocks.setdefault(lang, _Block()).add(text, block):
                    yield from rows(number, lang, ids, words, block)
                    number += 1
        for lang, held in blocks.items():
            own = held.size
            yield from rows(number, lang, *held.cut(own), own)
            number += 1

    return bounded(docs).select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                                F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, _R1)


def _frequent(groups: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Rows of the groups whose numbers add up to ``least``, with that sum ``f`` and the group's ``id``."""
    whole = Window.partitionBy(*keys)
    return (groups.withColumn("f", F.sum("n").over(whole)).where(F.col("f") >= least)
            .withColumn("id", F.min(F.shiftleft("block", _LOCAL).bitwiseOR(F.col("local"))).over(whole)))


def _groups(frequent: DataFrame, *columns: str) -> DataFrame:
    """One row of each group: that whose own number is the group's id."""
    return frequent.where(F.col("id") == F.shiftleft("block", _LOCAL).bitwiseOR(F.col("local"))).select("id", "f", *columns)


def _semi_joined(held: pa.Table, found: pa.Table) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The block's rows (place, id) of frequent groups, in the order of places; own places; block."""
    block, own, size, rows = (held.column(c)[0].as_py() for c in ("block", "own", "size", "rows"))
    local = unpack(rows, size)
    ids = np.zeros(int(local.max(initial=0)) + 1, np.int64)  # no group's id is 0, as local numbers begin with 1
    if found.num_rows:
        ids[found.column("local").to_numpy()] = found.column("id").to_numpy()
    place = np.flatnonzero(ids[local])
    return place, ids[local[place]], own, block


def _next_to(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge join of a relation sorted by place with itself on the next place."""
    at = np.searchsorted(place, place + 1)
    at[at == len(place)] = 0
    left = np.flatnonzero(place[at] == place + 1) if len(place) else np.zeros(0, np.int64)
    return left, at[left]


def _counted(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs as places of one of their rows, the pair's number of each row, and counts."""
    if not len(first):
        return (np.zeros(0, np.int64),) * 3
    order = np.lexsort((second, first))
    new = np.concatenate([[True], (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number, np.bincount(number)


def pairs(r1: DataFrame, words: DataFrame) -> DataFrame:
    """R2: per block one row with its pair occurrences, and one row per distinct pair of frequent words."""
    def run(held: pa.Table, found: pa.Table) -> pa.Table:
        schema = pa.schema([("block", pa.int64()), ("local", pa.int64()), ("g1", pa.int64()), ("g2", pa.int64()), ("n", pa.int64()),
                            ("own", pa.int64()), ("size", pa.int64()), ("rows", pa.binary())])
        if not held.num_rows:
            return schema.empty_table()
        place, ids, own, block = _semi_joined(held, found)
        left, right = _next_to(place)
        first, number, _ = _counted(ids[left], ids[right])
        n = np.bincount(number[place[left] < own], minlength=len(first))
        # the pair of every place, 0 where none begins
        size = held.column("size")[0].as_py()
        dense = np.zeros(size, np.int64)
        dense[place[left]] = number + 1
        k = len(first)
        groups = pa.table({
            "block": pa.array(np.full(k, block)), "local": pa.array(np.arange(1, k + 1)), "g1": pa.array(ids[left][first]),
            "g2": pa.array(ids[right][first]), "n": pa.array(n), "own": pa.nulls(k, pa.int64()),
            "size": pa.nulls(k, pa.int64()), "rows": pa.nulls(k, pa.binary())}, schema=schema)
        rows = pa.table({"block": [block], "local": [None], "g1": [None], "g2": [None], "n": [None], "own": [own], "size": [size],
                         "rows": [pack(dense)]}, schema=schema)
        return pa.concat_tables([groups, rows])

    held = r1.where("rows is not null").select("block", "own", "size", "rows")
    return held.groupBy("block").cogroup(words.select("block", "local", "id").groupBy("block")).applyInArrow(run, _R2)


def triples(r2: DataFrame, pairs_found: DataFrame) -> DataFrame:
    """(p1, p2, n): two frequent pairs that overlap in a word, counted by block."""
    def run(held: pa.Table, found: pa.Table) -> pa.Table:
        schema = pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("n", pa.int64())])
        if not held.num_rows:
            return schema.empty_table()
        place, ids, own, _ = _semi_joined(held, found)
        left, right = _next_to(place)
        left, right = left[place[left] < own], right[place[left] < own]
        first, _, n = _counted(ids[left], ids[right])
        return pa.table({"p1": ids[left][first], "p2": ids[right][first], "n": n}, schema=schema)

    held = r2.where("rows is not null").select("block", "own", "size", "rows")
    return held.groupBy("block").cogroup(pairs_found.select("block", "local", "id").groupBy("block")).applyInArrow(
        run, "p1 bigint, p2 bigint, n bigint")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) of three columns, in decimals."""
    n = f"cast({a} as decimal(18,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({n} * {n} as decimal(31,0))) div "
                  f"(cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))").cast("bigint")


def phrases(docs: DataFrame, least: int = LEAST, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Candidates (lang, phrase, words, a, l, r, n, score) before any is dropped, and the largest count of a
    longer candidate around each phrase of two words: (lang, phrase, longer)."""
    r1 = written(occurrences(docs, block), "r1")
    words = written(_frequent(r1.where("rows is null").select("block", "local", "lang", "word", "n"), ["lang", "word"], least), "r1-frequent")
    r2 = written(pairs(r1, words), "r2")
    two = written(_frequent(r2.where("rows is null").select("block", "local", "g1", "g2", "n"), ["g1", "g2"], least), "r2-frequent")
    three = triples(r2, two).groupBy("p1", "p2").agg(F.sum("n").alias("a")).where(F.col("a") >= least)

    totals = r1.where("rows is null").groupBy("lang").agg(F.sum("n").alias("n"))
    word = _groups(words, "lang", "word")
    first, second = (word.toDF(f"g{i}", f"f{i}", f"lang{i}", f"w{i}") for i in (1, 2))
    two = written(_groups(two, "g1", "g2").join(first, "g1").join(second, "g2").select(
        "id", "f", F.col("lang1").alias("lang"), "w1", "w2", "f1", "f2"), "two")
    a, b = two.toDF("p1", "c1", "lang", "x1", "x2", "u1", "u2"), two.toDF("p2", "c2", "lang_", "x2_", "x3", "u2_", "u3")
    three = written(three.join(a, "p1").join(b, "p2").select("lang", "x1", "x2", "x3", "a", "c1", "c2", "u1", "u3"), "three")

    found = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.lit(2).alias("words"), F.col("f").alias("a"),
                       F.col("f1").alias("l"), F.col("f2").alias("r"), score("f", "f1", "f2").alias("score"))
    cuts = F.least(*(F.struct(score("a", x, y).alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r"))
                     for k, (x, y) in enumerate((("u1", "c2"), ("c1", "u3")), 1)))
    found = found.unionByName(three.select("lang", F.concat_ws(" ", "x1", "x2", "x3").alias("phrase"), F.lit(3).alias("words"),
                                           "a", cuts.alias("c")).select("lang", "phrase", "words", "a", "c.l", "c.r", "c.score"))
    longer = three.select("lang", "a", F.explode(F.array(F.concat_ws(" ", "x1", "x2"), F.concat_ws(" ", "x2", "x3"))).alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("a").alias("longer"))
    return found.join(totals, "lang").select("lang", "phrase", "words", "a", "l", "r", "n", "score"), longer


def collocations(docs: DataFrame, least: int = LEAST, top: int | None = TOP, block: int = BLOCK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` candidates (None: all) that no longer one covers."""
    found, longer = phrases(docs, least, block)
    kept = found.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a"))).drop("longer", "words")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:  # first by parts of the language, so that the last step has SALTS * top rows at most
        kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(
            F.col("rank") <= top).drop("salt", "rank")
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
        kept = kept.withColumn("rank", rank).where(F.col("rank") <= top)
    else:
        from ..functions.ranking import grouped_index
        kept = grouped_index(kept, ["lang"], order, 1, "rank")
    return kept.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
