"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` over the driver tables.

Every query reads whole tables.  Column names equal those of the DuckDB oracle
in ``oracle.py``; doubles are rounded to 6 places where summation order differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import salted_md5
from ..operators import trees as T
from ..sources.tables import table
from . import inputs as I

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _t(spark, d, name):
    return table(spark, d, name)


def order_actions(spark, d):
    """Derived once, dealt and cut from its lineage: the tokens and the carries between their chunks read it."""
    return I.order_tree(_t(spark, d, "orders"), _t(spark, d, "lineitem"), T.spread)


def order_inputs(spark, d):
    """The expanded order trees, derived once: tokens, intervals and texts read them."""
    return T.materialize(T.expand(order_actions(spark, d)), dealt=True)


def page_actions(spark, d):
    return T.materialize(I.page_tree(_t(spark, d, "pages")))


# ---------------------------------------------------------------- trees

def broken_actions(spark, d):
    return I.broken_order_tree(order_actions(spark, d))


@query("tree_rejects")
def tree_rejects(spark, d):
    """T2/T3 on order trees of which eleven in twelve are broken, each in its own way: first error."""
    return T.validate(broken_actions(spark, d))


@query("tree_rejects_pages")
def tree_rejects_pages(spark, d):
    """T2/T3 on whole pages: first error per page."""
    return T.validate(page_actions(spark, d))


@query("tree_validate")
def tree_validate(spark, d):
    """T1-T3 on the partly broken order trees: status of every tree (``ok`` or the first error)."""
    acts = broken_actions(spark, d)
    sents = acts.select("sent_id").distinct()
    rej = T.validate(acts)
    return sents.join(rej, "sent_id", "left").select(
        "sent_id", F.coalesce("code", F.lit("ok")).alias("code"), F.col("pos").alias("err_pos"))


@query("tree_expand")
def tree_expand(spark, d):
    """T4, T6-T8 on the order tree: long-form inputs, labels and position ids."""
    return T.expand(order_actions(spark, d)).select(
        "sent_id", "idx", "kind", "tok", "label", F.col("pid").alias("position_id"))


def _seq_text(inputs: DataFrame, col: str, out: str) -> DataFrame:
    return inputs.groupBy("sent_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", F.col(col).cast("string").alias("v")))),
                                 lambda x: x["v"]), " ").alias(out))


@query("tree_labels")
def tree_labels(spark, d):
    """Label sequence per customer (``<pad>`` after each closer)."""
    return _seq_text(T.expand(order_actions(spark, d)), "label", "labels")


@query("tree_positions")
def tree_positions(spark, d):
    """Position ids per customer."""
    return _seq_text(T.expand(order_actions(spark, d)), "pid", "position_ids")


@query("tree_match")
def tree_match(spark, d):
    """T5: closer -> opener positions in the order trees."""
    return T.matches(order_actions(spark, d))


@query("tree_mask_intervals")
def tree_mask_intervals(spark, d):
    """T9 compact mask on the order tree: one live interval per key."""
    return T.mask_intervals(T.expand(order_actions(spark, d))).select("sent_id", "ki", "death")


@query("tree_mask_edges")
def tree_mask_edges(spark, d):
    """T9 edges on the order trees."""
    return T.mask_edges(order_inputs(spark, d))


@query("tree_mask_degree")
def tree_mask_degree(spark, d):
    """Row sums of the order-tree mask, computed by a sweep (no edge expansion)."""
    return T.mask_degree(order_inputs(spark, d))


@query("tree_dense_mask")
def tree_dense_mask(spark, d):
    """T10/T11 + K13 export: every dense row as Python-style float text, order trees."""
    inp = order_inputs(spark, d)
    return T.dense_mask_text(inp, T.mask_edges(inp, packed=True))


@query("tree_example")
def tree_example(spark, d):
    """The four example columns per order tree, as Python-style text."""
    inp = order_inputs(spark, d)
    return T.row_texts(inp, T.mask_edges(inp, packed=True, span=None)).select("sent_id", "text")


@query("tree_fingerprint")
def tree_fingerprint(spark, d):
    """T14 + K15: salted MD5 of each order-tree example (parallel form of the dataset hash)."""
    inp = order_inputs(spark, d)
    return T.sentence_fingerprints(T.row_texts(inp, T.mask_edges(inp, packed=True, span=None)))


@query("tree_dataset_digest")
def tree_dataset_digest(spark, d):
    """T14 at scale, order tree: hashes of the examples folded in order, per bucket of ids and then
    over the buckets, so that swapping two examples changes the digest."""
    inp = order_inputs(spark, d)
    fp = T.sentence_fingerprints(T.row_texts(inp, T.mask_edges(inp, packed=True, span=None)))
    return T.ordered_digest(fp)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # import for registration side effects
    from . import catalog_models, catalog_more  # noqa: F401
    return dict(QUERIES)


__all__ = ["QUERIES", "queries", "query", "salted_md5"]
