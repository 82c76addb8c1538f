"""Operator 13: ranked lexical search by dense blocked multiplication.

Items are the queries.  They are dealt to blocks of at most ``BLOCK_ITEMS`` items and about ``BLOCK_TERMS``
distinct terms (an item of more terms is a block of its own), and each block goes over all documents.
Only terms of the block's items matter, so a document becomes a compact row: its number of terms
and the occurrences of the block's terms in it.  These rows are written once; the corpus counts and the scores are read from them.

Scoring multiplies tiles.  A tile of the vocabulary holds up to ``TILE_TERMS`` terms with their weights in
each item, a tile of documents up to ``TILE_DOCS`` rows with the impact of each term.  Their product in
float64 (BLAS) is exact, since all factors are integers and the tile is cut where the weights times the largest
impact could pass 2**53 for any item; a term that would do so alone is spread over several tiles.  The
tiles' products are added up as 64-bit integers.

Each task keeps an item's best rows over all its tiles.  A row that equals the last of them in score is
weighed too, so ties end with the smallest doc_id whatever the tiles.  The tasks' best rows are cut to ``top`` per item
in two steps (per group of tasks, then per item), so what one task sees of an item doesn't grow with the input.

Edge cases.  Null and empty texts have no terms: such documents are never found and don't count in N; items
without a term have no rows.  Every row of the items is an item of its own, repeated ids included.  Null doc_ids come last
among equal scores.  Long texts are cut into slices between terms.  Columns besides id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import running_total
from .common import bounded, fresh_path, written

TOP = 20
BLOCK_ITEMS, BLOCK_TERMS = 1024, 1 << 17
TILE_TERMS, TILE_DOCS = 1024, 512
SLICE = 1 << 20
GROUPS = 32
#: No impact of a term in a document reaches it.
IMPACT = 1_000_000
EXACT = 1 << 53

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
BETWEEN = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def term_counts(text: str | bytes | None) -> Counter:
    """Occurrences of each term, as UTF-8 with A-Z lower-cased."""
    text = (text.encode() if isinstance(text, str) else text) or b""
    found, at = Counter(), 0
    while at < len(text):
        cut = BETWEEN.search(text, at + SLICE)
        end = cut.start() if cut else len(text)
        found.update(TERM.findall(text[at:end].lower()))  # bytes.lower() changes A-Z only
        at = end
    return found


def item_terms(items: DataFrame, id_col: str = "item_id") -> DataFrame:
    """(item_id, terms, counts) of every row with a term."""
    def run(batches):
        for batch in batches:
            counts = [term_counts(t) for t in batch.column(1).to_pylist()]
            keep = [i for i, c in enumerate(counts) if c]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(keep, pa.int64())),
                pa.array([list(counts[i]) for i in keep], pa.list_(pa.binary())),
                pa.array([list(counts[i].values()) for i in keep], pa.list_(pa.int64()))], names=["item_id", "terms", "counts"])

    return bounded(items).select(F.col(id_col).cast("bigint").alias("item_id"), "text").mapInArrow(
        run, "item_id bigint, terms array<binary>, counts array<bigint>")


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, ids, tfs): the number of terms of every row, and the occurrences of the vocabulary's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                found = term_counts(text)
                n.append(found.total())
                both = [(known[t], c) for t, c in found.items() if t in known]
                ids.append([x for x, _ in both])
                tfs.append([x for _, x in both])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "ids", "tfs"])

    return bounded(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n bigint, ids array<int>, tfs array<bigint>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def vocabulary_tiles(items: list[dict[int, int]], weights: list[int], terms: int = TILE_TERMS, exact: int = EXACT):
    """Tiles of (term numbers, begin of each term's entries, items, weights): ``items`` holds each item's terms with
    their occurrences, and no item's weights of one tile times ``IMPACT`` reach ``exact``."""
    entries: dict[int, list[tuple[int, int]]] = {}
    for i, found in enumerate(items):
        for t, times in found.items():
            if weights[t]:
                entries.setdefault(t, []).append((i, times * weights[t]))
    most = (exact - 1) // IMPACT
    tiles, tile, held = [], [], Counter()

    def close():
        if tile:
            tiles.append((np.array([t for t, _ in tile], np.int64), np.cumsum([0, *(len(e) for _, e in tile)]),
                          np.array([i for _, e in tile for i, _ in e], np.int64),
                          np.array([w for _, e in tile for _, w in e], np.float64)))
        tile.clear()
        held.clear()

    for t in sorted(entries):
        rest = entries[t]
        while rest:
            part = [(i, min(w, most)) for i, w in rest]
            if len(tile) == terms or any(held[i] + w > most for i, w in part):
                close()
            tile.append((t, part))
            for i, w in part:
                held[i] += w
            rest = [(i, w - most) for i, w in rest if w > most]
    close()
    return tiles


def tile_scores(rows: np.ndarray, ids: np.ndarray, impacts: np.ndarray, n_rows: int, n_items: int, tiles) -> np.ndarray:
    """Scores (row, item) of one tile of documents; postings (row, id, impact) are sorted by id."""
    total = np.zeros((n_rows, n_items), np.int64)
    for terms, begin, items, weights in tiles:
        lo, hi = np.searchsorted(ids, terms[0]), np.searchsorted(ids, terms[-1], side="right")
        at = np.searchsorted(terms, ids[lo:hi])
        known = terms[at] == ids[lo:hi]
        used, column = np.unique(at[known], return_inverse=True)  # compact: only terms that occur in these documents
        if not len(used):
            continue
        left = np.zeros((n_rows, len(used)))
        left[rows[lo:hi][known], column] = impacts[lo:hi][known]
        sizes = begin[used + 1] - begin[used]
        entry = np.repeat(begin[used] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        right = np.zeros((len(used), n_items))
        right[np.repeat(np.arange(len(used)), sizes), items[entry]] = weights[entry]
        total += np.rint(left @ right).astype(np.int64)
    return total


class Best:
    """The best rows of each item so far: scores downwards, then doc_id, null last."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.ones(n_items, np.int64)
        self.item, self.score, self.none, self.doc = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, scores: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)  # what equals the last one may have the smaller doc_id
        if not len(row):
            return
        score = np.concatenate([self.score, scores[row, item]])
        item = np.concatenate([self.item, item])
        none, doc = np.concatenate([self.none, none[row]]), np.concatenate([self.doc, doc[row]])
        order = np.lexsort((doc, none, -score, item))
        item, score, none, doc = item[order], score[order], none[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.top - 1
        self.least[item[last]] = score[last]
        keep = place < self.top
        self.item, self.score, self.none, self.doc = item[keep], score[keep], none[keep], doc[keep]


def best_rows(found: DataFrame, tiles, n_items: int, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """(item, doc_id, score, part): the ``top`` best rows of each item in each task."""
    shared = found.sparkSession.sparkContext.broadcast(tiles)

    def run(batches):
        from pyspark import TaskContext
        part, best = TaskContext.get().partitionId(), Best(n_items, top)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                tile = batch.slice(at, TILE_DOCS)
                lists, tfs = tile.column(2), tile.column(3).flatten().to_numpy(zero_copy_only=False)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                if not len(ids):
                    continue
                rows = np.repeat(np.arange(tile.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                n = tile.column(1).to_numpy(zero_copy_only=False)
                m = 75 + (25 * n * n_docs) // n_terms
                impacts = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[rows])
                order = np.argsort(ids, kind="stable")
                scores = tile_scores(rows[order], ids[order], impacts[order].astype(np.float64), tile.num_rows, n_items, tiles=shared.value)
                doc = tile.column(0)
                best.add(scores, doc.fill_null(0).to_numpy(zero_copy_only=False), doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
        yield pa.RecordBatch.from_arrays([
            pa.array(best.item), pa.array(best.doc, mask=best.none == 1), pa.array(best.score),
            pa.array(np.full(len(best.item), part % GROUPS, np.int32))], names=["item", "doc_id", "score", "part"])

    return found.mapInArrow(run, "item bigint, doc_id bigint, score bigint, part int")


def _ranked(rows: DataFrame, group: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(items: DataFrame, docs: DataFrame, top: int = TOP, block_items: int = BLOCK_ITEMS,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each row of ``items(item_id, text)``."""
    spark = docs.sparkSession
    queries = written(item_terms(items).withColumn("item", F.monotonically_increasing_id()), "items")
    least = max(1, block_terms // block_items)  # what an item counts at least, so that a block has block_items at most
    cost = queries.select("item", F.greatest(F.size("terms"), F.lit(least)).cast("bigint").alias("cost"))
    blocks = written(running_total(cost, [F.col("item")], "cost").select(
        "item", F.floor((F.col("cum") - F.col("cost")) / F.lit(block_terms)).cast("bigint").alias("block")), "blocks")
    paths, size = [], None
    for block in [r.block for r in blocks.select("block").distinct().orderBy("block").collect()]:
        held = queries.join(blocks.where(F.col("block") == block), "item").orderBy("item").collect()
        vocabulary: dict[bytes, int] = {}
        counts = [{vocabulary.setdefault(bytes(t), len(vocabulary)): c for t, c in zip(r.terms, r.counts, strict=True)} for r in held]
        found = written(postings(docs, vocabulary), "postings")
        if size is None:
            size = found.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = [0] * len(vocabulary)
        for r in found.select(F.explode("ids").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
            df[r.t] = r.df
        tiles = vocabulary_tiles(counts, [weight(size[0], x) if x else 0 for x in df])
        rows = best_rows(found.where(F.size("ids") > 0), tiles, len(held), size[0], size[1], top)
        rows = _ranked(_ranked(rows, ["item", "part"], top).drop("rank"), ["item"], top)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(held)], "item bigint, item_id bigint")
        paths.append(fresh_path(spark, "ranked"))
        rows.join(F.broadcast(ids), "item").select(
            "item_id", F.col("rank").cast("int"), "doc_id", "score").write.parquet(paths[-1])
    schema = "item_id bigint, rank int, doc_id bigint, score bigint"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
