"""Registered queries: trained BPE models, block-sparse masks and their hash tree, many keywords, files, callers' functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import batching as B
from ..operators import counts as K
from ..operators import tiles as L
from ..operators import trees as T
from ..operators import vocab as V
from .catalog import _t, order_actions, order_inputs, query

KEYWORD_LETTERS = 6  # keywords are the benchmark's words of this length at least


@query("bpe_train")
def bpe_train(spark, d):
    """Merges trained on every document, merges of merges included, with the pair's number when taken."""
    from ..operators import bpe_train as P
    return P.train(_t(spark, d, "documents"))


@query("bpe_encode_trained")
def bpe_encode_trained(spark, d):
    """V14 with a trained model: numbers of pieces and pre-tokens of every document, the longest piece, and the
    digest of the ordered pieces."""
    from ..operators import bpe as P
    from ..operators import bpe_train as N
    docs = _t(spark, d, "documents")
    merges = N.train(docs)
    enc = P.bpe_rows(docs, N.model(merges), merges.select("rank", "a", "b"))
    pieces = F.flatten("pieces")
    longest = F.array_max(F.transform(pieces, F.length))
    return enc.select("doc_id", F.size(pieces).cast("bigint").alias("n_tokens"), F.size("pieces").cast("bigint").alias("n_pretokens"),
                      F.coalesce(longest, F.lit(0)).cast("bigint").alias("longest"),
                      F.md5(F.array_join(pieces, " ")).alias("pieces_md5"))


def order_tiles(spark, d):
    """The order trees' tokens and the tiles of their masks, each written once."""
    inp = order_inputs(spark, d)
    return inp, T.materialize(L.mask_tiles(inp, T.mask_intervals(inp)))


@query("tree_mask_tiles")
def tree_mask_tiles(spark, d):
    """T10 as tiles: the set cells of every order-tree mask in squares of 32."""
    return order_tiles(spark, d)[1].select("sent_id", "tile_row", "tile_col", "ones", L.tile_text(F.col("columns")).alias("cells"))


@query("tree_mask_refs")
def tree_mask_refs(spark, d):
    """What each example holds of its mask ``[1, n, n]``."""
    refs = L.references(*order_tiles(spark, d))
    return refs.select("sent_id", F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"), "n_tiles", "ones")


@query("batch_masks")
def batch_masks(spark, d):
    """Batches of 16 order trees with the shape of the stacked masks and their examples' tiles."""
    refs = T.materialize(L.references(*order_tiles(spark, d)))
    batches = B.assign_batches(refs.select("sent_id", "n"), [F.col("sent_id")]).select("batch_id", "sent_id", "max_len")
    ref = lambda x: F.concat_ws(":", *(x[c].cast("string") for c in ("sent_id", "n", "n_tiles", "ones")))
    return L.batch_masks(batches, refs).select(
        "batch_id", F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"),
        F.array_join(F.transform("masks", ref), ";").alias("masks"))


@query("tree_hash_tree")
def tree_hash_tree(spark, d):
    """T14 as a hash tree over tiles: every node from the examples to the root."""
    inp, tiles = order_tiles(spark, d)
    return L.hash_tree(L.example_hashes(L.row_hashes(inp, tiles)))


@query("keyword_scan")
def keyword_scan(spark, d):
    """C4 with a long list: the benchmark's longer words that each document holds anywhere, case aside."""
    from ..operators import keywords as W
    docs = _t(spark, d, "documents")
    words = _t(spark, d, "benchmark").select(F.explode(V.split_words(F.col("text"))).alias("keyword")).where(
        F.length("keyword") >= KEYWORD_LETTERS)
    hits = W.keyword_hits(docs, words, "doc_id").groupBy("doc_id").agg(F.sort_array(F.collect_list("keyword")).alias("k"))
    return docs.select("doc_id").join(hits, "doc_id", "left").select(
        "doc_id", F.coalesce(F.size("k"), F.lit(0)).cast("bigint").alias("n_keywords"),
        F.md5(F.coalesce(F.array_join("k", " "), F.lit(""))).alias("keywords_md5"))


# ------------------------------------------------------------------ files

def _folder(spark) -> str:
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex[:12]}"


@query("file_lines")
def file_lines(spark, d):
    """S1 by file: every line of the documents written to text files and read back with its global number."""
    from ..sources import text as X
    path = _folder(spark)
    X.write_lines(X.split_lines(_t(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id"),
                  path, ["doc_id", "line_no"])
    return X.read_lines(spark, path)


@query("merge_file")
def merge_file(spark, d):
    """S3 by file: the trained merges written as a merge list and read back by rank."""
    from ..operators import bpe_train as P
    from ..sources import text as X
    path = _folder(spark)
    merges = P.train(_t(spark, d, "documents")).select("rank", F.concat_ws(" ", "a", "b").alias("text"))
    head = spark.createDataFrame([(-1, "#version: 0.2")], "rank bigint, text string")
    X.write_lines(head.unionByName(merges), path, ["rank"])
    return X.read_merges(spark, path)


@query("dataset_sink")
def dataset_sink(spark, d):
    """The order trees' inputs saved twice, read back once, and what the manifest says of them."""
    from ..sources import text as X
    path = _folder(spark)
    rows = T.materialize(T.expand(order_actions(spark, d)).select("sent_id", "idx", "kind", "tok", "label", "pid"))
    X.write_dataset(rows.where("idx < 2"), path)  # a write that a later one takes the place of
    version = X.write_dataset(rows, path)
    held = spark.read.parquet(f"{path}/manifest").where(F.col("version") == version).agg(F.sum("n_rows")).first()[0]
    per = X.read_dataset(spark, path).groupBy("sent_id").agg(
        F.count(F.lit(1)).alias("n"), F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(
            F.struct("idx", F.concat_ws(" ", "kind", "tok", "label", F.col("pid").cast("string")).alias("t")))), lambda x: x["t"]), "|")).alias("rows_md5"))
    return per.withColumn("manifest_rows", F.lit(held).cast("bigint"))


# ------------------------------------------------------------------ functions of the caller

def _lengths(rows: dict) -> dict:
    words = [(t or "").split(" ") for t in rows["text"]]
    return {"doc_id": rows["doc_id"], "n_parts": [len(w) for w in words], "longest": [max(map(len, w)) for w in words]}


@query("map_batched")
def map_batched(spark, d):
    """A function of the caller over batches of documents: number and length of the parts between blanks."""
    from ..operators.batch_map import map_batches
    return map_batches(_t(spark, d, "documents").select("doc_id", "text"), _lengths, "doc_id bigint, n_parts bigint, longest bigint", 256)


def _collated(rows: list[dict]) -> list[dict]:
    top = max(len(r["pids"]) for r in rows)
    padded = [" ".join(map(str, r["pids"] + [0] * (top - len(r["pids"])))) for r in rows]
    return [{"batch_id": rows[0]["batch_id"], "n_rows": len(rows), "position_ids": ";".join(padded)}]


@query("collate_batches")
def collate_batches(spark, d):
    """A collator of the caller over batches of 16 order trees: their position ids padded to one length."""
    from ..operators.batch_map import collate
    ex = T.expand(order_actions(spark, d)).groupBy("sent_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("idx", "pid"))), lambda x: x["pid"]).alias("pids")).withColumn("n", F.size("pids"))
    rows = B.assign_batches(ex, [F.col("sent_id")]).select("batch_id", "sent_id", "pids")
    return collate(rows, _collated, "batch_id bigint, n_rows int, position_ids string", order=["sent_id"])


# ------------------------------------------------------------------ products of many groups

@query("count_dot_top")
def count_dot_top(spark, d):
    """K7 for many groups: the five documents of the largest word-count product with each benchmark item."""
    def counts(name, key):
        words = _t(spark, d, name).select(F.col(key).alias("grp"), V.split_words(F.coalesce("text", F.lit(""))).alias("w"))
        return K.increment_all(words, "grp", "w")
    return K.dot_top(counts("documents", "doc_id"), counts("benchmark", "item_id"), 5)
