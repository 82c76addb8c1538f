"""Operator 2: near-duplicate documents by a MinHash LSH forest.

Method.  Each distinct shingle set (a *class*: 128-bit digest of the whole sorted set) gets a
signature of ``trees x depth`` minimum hashes.  Each tree is one sorted order of the classes by
its own ``depth`` values.  All orders are one range-partitioned sort with the class as the last
key, so a dense region is cut into even tasks like any other.  Candidates of a class are its neighbours of longest
common prefix, above and below, in each order.  The depth adapts by region: neighbours must
agree on ``min_depth`` values at least, and where an order is dense the nearest ``reach`` rows
agree on ever more values, so a sparse region is searched shallow and a dense one deep.

Candidates are confirmed on the full sets by exact integer arithmetic, and the links' components
come from distributed star steps.  A second pass over the same orders, up and down, looks only at neighbours
of *different* components.  A run of one component takes one place in the window, so
a class whose only partner stands behind a crowd of already joined copies is still compared with
the crowd, row by row.

Where a group's members are near but unlinked, most neighbours are no links.  In the second pass a class therefore carries the
parities of its set, whose difference bounds the sets' own from below: a pair that they hold apart is no link, takes
no place of a window and is never joined with its sets.

The windows have one size.  A class whose windows left out others that share ``min_depth`` values with it is *cut*,
and so is then each class that it wasn't compared with.  The cut classes are completed exactly: each one's rarest shingles
(``n - ceil(n * similarity) + 1`` of them, so that two linked classes share one) make an index, and classes of
different components that meet there, fit in size and could still share enough by the places of the shingle
are confirmed like the others.  No link between classes that share ``min_depth`` values in any tree is lost.

Edge cases.  Null text counts as empty.  Empty sets link with nothing.  Rows of equal sets are
one class however many there are (repeated doc_ids included).  A null doc_id never becomes a
component id unless its component has no other.  Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS_CLASS, bounded, byte_slices, mix64, shingles, shuffle_parts, written
from .components import connected_components

TREES, DEPTH = 16, 8
MIN_DEPTH, REACH = 3, 2
MOST_BITS = 4096  # parities of a set


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n] | np.uint64(1), seeds[n:]


def signature(values: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Top 32 bits of the minimum of each multiply-add hash over the set."""
    low = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), 128):
        np.minimum(low, (values[i:i + 128, None] * mult + add).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(">u4")


def set_digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def parity(values: np.ndarray) -> np.ndarray:
    """The parities of a set's members by their low bits, 64 to a long: a power of two of them, as many as the set has
    members or more, up to ``MOST_BITS``.  Half as many follow by folding, see :func:`apart`."""
    m = max(64, min(MOST_BITS, 1 << (len(values) - 1).bit_length()))
    odd = np.bincount((values & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def apart(x: tuple[int, int], y: tuple[int, int]) -> int:
    """A lower bound of the members that one of two sets has alone, from their parities (number of bits, bits)."""
    (m, x), (k, y) = (x, y) if x[0] >= y[0] else (y, x)
    while m > k:
        m //= 2
        x = (x >> m) ^ (x & ((1 << m) - 1))
    return (x ^ y).bit_count()


def _texts(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def signatures(docs: DataFrame, k: int, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """(doc_id, node, n_shingles, sig, digest) of every row; node and sig are null for an empty set, digest is the text's MD5."""
    def run(batches):
        mult, add = _constants(trees * depth)
        for batch in batches:
            texts = _texts(batch.column(1))
            for lo, hi in byte_slices(texts):
                sets = shingles(texts[lo:hi], k)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[lo:hi],
                    pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s, mult, add).tobytes() if len(s) else None for s in sets], pa.binary()),
                    pa.array([hashlib.md5(t, usedforsecurity=False).digest() for t in texts[lo:hi]], pa.binary()),
                ], names=["doc_id", "node", "n_shingles", "sig", "digest"])

    return bounded(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, node binary, n_shingles bigint, sig binary, digest binary")


def sets(docs: DataFrame, k: int) -> DataFrame:
    """(node, values, bits): the sorted distinct shingle hashes of every non-empty row, 8 bytes each, and their parities."""
    def run(batches):
        for batch in batches:
            texts = _texts(batch.column(0))
            for lo, hi in byte_slices(texts):
                found = [s for s in shingles(texts[lo:hi], k) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_digest(s) for s in found], pa.binary()),
                                                  pa.array([s.tobytes() for s in found], pa.binary()),
                                                  pa.array([parity(s) for s in found], pa.list_(pa.int64()))],
                                                 names=["node", "values", "bits"])

    return docs.select("text").mapInArrow(run, "node binary, values binary, bits array<bigint>")


def forest(classes: DataFrame, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """One row per class and tree: (tree, label, node, n); the label is the tree's part of the signature."""
    width = 4 * depth
    rows = classes.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "sig", "node",
                          F.col("n_shingles").alias("n"))
    return rows.select(F.col("tree").cast("int"), F.expr(f"substring(sig, tree * {width} + 1, {width})").alias("label"),
                       "node", "n")


_FOUND_SCHEMA = ("kind string, a binary, b binary, part int, tree int, label binary, n bigint, comp binary, left bigint, "
                 "room bigint, joins binary, bits array<bigint>")
_FOUND = [c.split()[0] for c in _FOUND_SCHEMA.split(", ")]
_FOUND_TYPES = [pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64(),
                pa.int64(), pa.binary(), pa.list_(pa.int64())]


def _found(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_FOUND)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FOUND_TYPES, strict=True)], names=_FOUND)


def _packed(bits: list[int] | None) -> tuple[int, int] | None:
    return None if bits is None else (64 * len(bits), int.from_bytes(np.array(bits, "<i8").tobytes(), "little"))


def _unpacked(bits: tuple[int, int] | None) -> list[int] | None:
    return None if bits is None else np.frombuffer(bits[1].to_bytes(bits[0] // 8, "little"), "<i8").tolist()


class _Window:
    """The rows before a row in its sorted order that it is compared with.

    Rows are (tree, label, node, n, comp, folded, bits).  Only rows of the latest row's *region* are held: those of
    its tree that share ``min_depth`` values with it.  Up to ``reach`` nearest rows that could reach the
    similarity by their sizes, and by their parities where they have some, are partners; four times as many rows are held.  With ``across``, rows of
    one component are no partners, and a run of them takes one place, which is then *folded*.  ``lost`` tells that rows of the
    region have left the window, ``whole`` that the region began with the window.
    """

    def __init__(self, reach: int, min_depth: int, num: int, den: int, across: bool):
        self.reach, self.min_depth, self.num, self.den, self.across = reach, min_depth, num, den, across
        self.rows: deque = deque()
        self.lost, self.whole = False, True

    def enter(self, row) -> None:
        """Rows of another region than the row's leave."""
        if self.rows:
            last, width = self.rows[-1], 4 * self.min_depth
            if last[0] != row[0] or last[1][:width] != row[1][:width]:
                self.rows.clear()
                self.lost, self.whole = False, False

    def partners(self, row, rows=None, most: int | None = None, inner: bool | None = None) -> tuple[list[bytes], bool]:
        """The partners among the held rows (or ``rows``), and whether the row is cut: it has one more than ``most``, or stands
        inside a run (``inner``) and meets a folded place, so that inner rows of two runs aren't compared."""
        out, most, cut = [], self.reach if most is None else most, False
        rows = self.rows if rows is None else rows
        if inner is None:
            inner = bool(rows) and rows[-1][4] == row[4]
        for q in reversed(rows):
            small, large = (row[3], q[3]) if row[3] < q[3] else (q[3], row[3])
            other = not (self.across and row[4] == q[4]) and row[2] != q[2]
            if other and self.across and inner and q[5]:
                cut = True
            if other and self.den * small >= self.num * large and self.near(row, q):
                if len(out) == most:
                    return out, True
                out.append(q[2])
        return out, cut

    def near(self, row, q) -> bool:
        """Linked sets hold (den - num) / (den + num) of their sizes' sum at most apart."""
        if row[6] is None or q[6] is None:
            return True
        return (self.den + self.num) * apart(row[6], q[6]) <= (self.den - self.num) * (row[3] + q[3])

    def push(self, row) -> None:
        if self.across and self.rows and self.rows[-1][4] == row[4]:
            self.rows.pop()
            row = (*row[:5], True, row[6])
        self.rows.append(row)
        if len(self.rows) > 4 * self.reach:
            self.rows.popleft()
            self.lost = True


def _neighbours(reach: int, min_depth: int, num: int, den: int, across: bool):
    """Candidate pairs of a sorted partition (kind ``pair``).  Rows that the windows of partitions before
    could add partners to come out as ``head``, with the partners and places that are left to them and the
    component that the partition began with; the last window comes out as ``tail``; ``cut`` names the rows that
    the window left something out for.  Without ``across``, ``beside`` names the classes that
    share a region with another (or could, at the ends of a partition), and none is cut."""
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        window = _Window(reach, min_depth, num, den, across)
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row, bits = (*row[:5], False, _packed(row[5])), row[5]
                window.enter(row)
                if not across and (window.rows or window.whole):
                    out += [("beside", r[2], *[None] * 10) for r in [row, *([window.rows[0]] if len(window.rows) == 1 else [])]]
                found, cut = window.partners(row)
                out += [("pair", row[2], q, *[None] * 9) for q in found]
                if cut or window.lost:
                    if across:
                        out.append(("cut", row[2], *[None] * 10))
                elif window.whole:
                    out.append(("head", row[2], None, part, row[0], row[1], row[3], row[4], reach - len(found),
                                4 * reach - len(window.rows), window.rows[0][4] if window.rows else None, bits))
                window.push(row)
            yield _found(out)
        yield _found([("tail", r[2], None, part, r[0], r[1], r[3], r[4], int(window.lost), int(r[5]), None, _unpacked(r[6])) for r in window.rows]
                     + [("beside", r[2], *[None] * 10) for r in window.rows if not across])

    return run


def _incoming(tails, make, down: bool) -> dict:
    """The window that each partition begins with, by folding the last windows of those before it in order."""
    parts: dict = {}
    for r in tails:
        parts.setdefault(r.part, []).append(((r.tree, bytes(r.label), bytes(r.a), r.n, r.comp and bytes(r.comp), bool(r.room),
                                              _packed(r.bits)), r.left))
    window, out = make(), {}
    for part in sorted(parts):
        out[part] = (list(window.rows), window.lost)
        for row, lost in sorted(parts[part], key=lambda x: x[0][:3], reverse=down):
            window.enter(row)
            window.push(row)
        window.lost = window.lost or bool(lost)
    return out


def _over_boundaries(make, incoming: dict):
    """Pairs of ``head`` rows with the window their partition begins with; a pair without b tells of a cut row."""
    def run(batches):
        window = make()
        for batch in batches:
            out = []
            for _, node, _, part, tree, label, n, comp, left, room, joins, bits in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                row = (tree, label, node, n, comp, False, _packed(bits))
                rows, lost = incoming[part]
                if not rows or rows[-1][0] != tree or rows[-1][1][:4 * window.min_depth] != label[:4 * window.min_depth]:
                    continue
                # a run that goes over the boundary takes one place
                if window.across and room < 4 * window.reach and rows[-1][4] == joins:
                    rows = rows[:-1]
                held = rows[max(0, len(rows) - room):]
                found, cut = window.partners(row, held, left, inner=True)
                out += [(node, q) for q in found]
                if window.across and (cut or lost or len(held) < len(rows)):
                    out.append((node, None))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return run


def look(order: DataFrame, num: int, den: int, reach: int = REACH, min_depth: int = MIN_DEPTH, across: bool = False,
         down: bool = False) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) of neighbours in the sorted orders of ``order(tree, label, node, n, comp[, bits])``, and
    classes: with ``across`` those that are cut, else every class that shares ``min_depth`` values with another at all.

    The orders are range-partitioned and sorted here, descending with ``down``.  The windows go on over
    partition boundaries, however many a region or a run covers: the last windows (4 * ``reach`` rows a
    partition) are folded in order, and the rows that need them are looked at once more.
    """
    parts = 4 * shuffle_parts(order.sparkSession)
    keys = [F.col(c).desc() if down else F.col(c) for c in ("tree", "label", "node")]
    bits = F.col("bits") if "bits" in order.columns else F.lit(None).cast("array<bigint>").alias("bits")
    order = (order.select("tree", "label", "node", "n", "comp", bits).repartitionByRange(parts, *keys)
             .sortWithinPartitions(*keys))
    found = written(order.mapInArrow(_neighbours(reach, min_depth, num, den, across), _FOUND_SCHEMA), "neighbours")

    def make():
        return _Window(reach, min_depth, num, den, across)

    incoming = _incoming(found.where("kind = 'tail'").collect(), make, down)
    over = written(found.where("kind = 'head'").mapInArrow(_over_boundaries(make, incoming), "a binary, b binary"), "over")
    pairs = found.where("kind = 'pair'").select("a", "b").unionByName(over.where("b is not null"))
    named = found.where("kind in ('cut', 'beside')").select(F.col("a").alias("node")).unionByName(
        over.where("b is null").select(F.col("a").alias("node")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), named.distinct()


def candidates(order: DataFrame, num: int, den: int, reach: int = REACH, min_depth: int = MIN_DEPTH,
               across: bool = False, down: bool = False) -> DataFrame:
    """The pairs of ``look``."""
    return look(order, num, den, reach, min_depth, across, down)[0]


def confirm(pairs: DataFrame, values: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs with den * |A and B| >= num * |A or B|, counted on the full sets."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    left = values.select(F.col("node").alias("a"), F.col("values").alias("va"))
    right = values.select(F.col("node").alias("b"), F.col("values").alias("vb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb")
    return both.mapInArrow(run, "a binary, b binary")


def _apart(x, y):
    """:func:`apart` in Spark; 0 of sets without parities, or whose numbers of them are more than a factor of two apart."""
    m = F.least(F.size(x), F.size(y))
    at = lambda c, i: F.get(c, i).bitwiseXOR(F.coalesce(F.get(c, i + m), F.lit(0).cast("bigint")))
    found = F.aggregate(F.sequence(F.lit(0), m - 1), F.lit(0), lambda sum_, i: sum_ + F.bit_count(at(x, i).bitwiseXOR(at(y, i))))
    return F.when(x.isNotNull() & y.isNotNull() & (F.greatest(F.size(x), F.size(y)) <= 2 * m), found).otherwise(0)


def completed(classes: DataFrame, values: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a < b) of ``classes(node, comp)`` of different components, all those that link among them.

    Shingles are ordered by the number of classes that have them.  Two linked classes share one among the first
    ``n - ceil(n * num / den) + 1`` of each, and where they first meet, at places x and y from 0, they can have
    ``1 + min(n - x, m - y) - 1`` in common at most, which has to be enough; so has what their parities leave in common.
    Shingles of one class alone hold their places but make no posting.
    """
    if "bits" not in values.columns:
        values = values.withColumn("bits", F.lit(None).cast("array<bigint>"))
    rows = written(classes.join(values, "node").withColumn("row", F.monotonically_increasing_id()), "cut-sets")

    def spread(batches):
        for batch in batches:
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(data, np.int64)
                for at in range(0, len(found), 1 << 16):
                    part = found[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), row)), pa.array(part)], names=["row", "s"])

    shingles_ = rows.select("row", "values").mapInArrow(spread, "row bigint, s bigint")
    often = shingles_.groupBy("s").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    n = (F.octet_length("values") / 8).cast("bigint")
    ordered = shingles_.join(often, "s").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("times", "s"))).alias("shared"))
    ordered = ordered.join(rows.select("row", "node", "comp", n.alias("n"), "bits"), "row").withColumn(
        "alone", F.col("n") - F.size("shared")).withColumn(
        "wanted", F.col("n") - F.ceil(F.col("n") * num / F.lit(den)).cast("bigint") + 1 - F.col("alone"))
    post = written(ordered.where("wanted > 0").select(
        "row", "node", "comp", "n", "bits", "alone", F.posexplode(F.slice("shared", F.lit(1), F.col("wanted").cast("int"))).alias("i", "x")).select(
        F.col("x.s").alias("s"), "row", "node", "comp", "n", "bits", (F.col("alone") + F.col("i")).alias("place")), "postings")
    left, right = (post.select("s", *(F.col(c).alias(f"{c}{i}") for c in ("row", "node", "comp", "n", "bits", "place"))) for i in (1, 2))
    enough = (num + den) * F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) >= num * (F.col("n1") + F.col("n2"))
    sizes = den * F.least("n1", "n2") >= num * F.greatest("n1", "n2")
    near = (num + den) * _apart(F.col("bits1"), F.col("bits2")) <= (den - num) * (F.col("n1") + F.col("n2"))
    met = left.join(right, "s").where(
        (F.col("row1") < F.col("row2")) & (F.col("comp1") != F.col("comp2")) & sizes & enough & near)
    return met.select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()


def members(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """(doc_id, n_shingles, digest, root, component_id) of every row: its text's MD5, its component's class and
    smallest doc_id (both null for a row without shingles)."""
    rows = written(signatures(docs, k, trees, depth), "signatures")
    classes = written(rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "classes")
    order = forest(classes, trees, depth)
    first, beside = look(order.withColumn("comp", F.lit(None).cast("binary")), num, den)
    first, ids = written(first, "pairs"), written(beside, "beside")
    wanted = ids.join(classes.select("node", "doc_id"), "node").select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    texts = texts.join(wanted.select(F.col("doc_id").alias("_want")),
                       F.col("doc_id").eqNullSafe(F.col("_want")), "left_semi")
    values = written(sets(texts, k), "sets").dropDuplicates(["node"])
    roots = connected_components(written(confirm(first, values, num, den), "confirmed"))
    bits = ids.join(values.select("node", "bits"), "node", "left")
    joined = written(order.join(bits, "node").join(roots, "node", "left").select(
        "tree", "label", "node", "n", F.coalesce("root", "node").alias("comp"), "bits"), "joined")
    (up, cut_up), (down, cut_down) = (look(joined, num, den, 2 * REACH, across=True, down=x) for x in (False, True))
    cut = written(cut_up.unionByName(cut_down).distinct(), "cut")
    comps = cut.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("comp"))
    met = completed(comps, values, num, den)
    fresh = up.unionByName(down).unionByName(met).distinct().join(first, ["a", "b"], "left_anti")
    links = written(confirm(written(fresh, "pairs"), values, num, den), "confirmed")
    if not links.isEmpty():
        roots = connected_components(links.unionByName(roots.toDF("a", "b")))
    # smallest doc_id of each component, then back to the rows
    comp = classes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    comp = written(comp, "membership")
    low = comp.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_node = comp.select("node", "root").join(low, "root").select("node", "root", "component_id")
    return rows.select("doc_id", "n_shingles", "digest", "node").join(by_node, "node", "left").select(
        "doc_id", "n_shingles", "digest", "root", "component_id")


def survivors(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component: the one of smallest (doc_id, MD5 of the text, other columns), null
    doc_ids last.  Rows without shingles all stay."""
    rows = members(docs, **options).where("root is not null").groupBy("root", "doc_id", "digest").agg(
        F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "copies"))
    chosen = written(rows.groupBy("root").agg(first.alias("x")).select(
        F.col("x.doc_id").alias("_id"), F.col("x.digest").alias("_digest"), F.col("x.copies").alias("_copies")), "chosen")
    # the row travels as one struct, so that no column of it can clash with those made here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    words = F.coalesce(F.col("_doc.text").rlike(f"[^{WS_CLASS}]"), F.lit(False))
    kept = rows.where(words).withColumn("_text_digest", F.unhex(F.md5(F.col("_doc.text")))).join(
        chosen, (F.col("_text_digest") == F.col("_digest")) & F.col("_doc.doc_id").cast("bigint").eqNullSafe(F.col("_id")))
    # rows of the same id and text: one of them
    again = kept.where(F.col("_copies") > 1).groupBy("_digest").agg(F.min("_doc").alias("_doc"))
    whole = [F.col("_doc").getField(c).alias(c) for c in docs.columns]
    return rows.where(~words).unionByName(kept.where(F.col("_copies") == 1).select("_doc")).unionByName(again.select("_doc")).select(*whole)


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, trees: int = TREES,
                    depth: int = DEPTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs(doc_id, text, ...)``.

    Documents are linked when den * intersection >= num * union of their k-word shingle sets.
    ``component_id`` is the smallest doc_id of the component, ``kept`` marks the row whose doc_id
    it is.  A row without shingles is its own component.
    """
    return members(docs, k, num, den, trees, depth).select(
        "doc_id", "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.when(F.col("root").isNull(), F.lit(True)).otherwise(F.col("doc_id") == F.col("component_id")),
                   F.lit(False)).alias("kept"))

