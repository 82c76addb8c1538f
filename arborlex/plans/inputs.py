"""Bracketed action sequences derived from the driver tables.

* order tree: per customer ``<s> (C (O p.. p.. O) (O .. O) C) </s>`` from orders x lineitem
* broken tree: order trees broken in eleven ways, for the reject path
* page tree:  the whole page after dropping comments, scripts, styles and void tags
              (real pages leave tags open, so this feeds the reject path)

All outputs are long-form ``actions(sent_id, pos, tok)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import grouped_total, tasks_for
from ..operators.trees import BOS, EOS, frame
from ..session import cut_lineage, release

# Fixed patterns for the HTML-to-bracket mapping (mirrored in the DuckDB oracle).
PIECE_RE = r"<[^>]*>|[^<]+"
CLOSE_NAME_RE = r"^</\s*([A-Za-z0-9]+)"
OPEN_NAME_RE = r"^<\s*([A-Za-z0-9]+)"
DROP_RE = (
    r"(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>|<![^>]*>"
    r"|<(meta|br|img|hr|input|link)[^>]*>"
)


def order_tree(orders: DataFrame, lineitem: DataFrame, dealt: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """One sentence per customer; orders by key, parts by line number (then part and supplier: line numbers repeat
    within an order).

    A token's place is that of its order in the customer plus its rank in the order.  Orders are placed by a distributed running
    total of their sizes, so a customer holding a large share of all orders is no single task, and the lines, shuffled once by
    order, are ranked where they meet their order.  An order key that a customer has ``m`` times has its brackets and
    lines ``m`` times.  Both tables are dealt by order to as many tasks as their rows need, and their steps keep to that.
    ``dealt`` takes the tokens and their number (but for the four that frame a sentence), and gives them back materialised.
    """
    tasks = tasks_for(lineitem, lineitem.count() + orders.count())
    o = orders.select(F.col("o_orderkey").alias("okey"), F.col("o_custkey").cast("bigint").alias("sent_id")).where(
        "sent_id is not null").repartition(tasks, "okey").groupBy("sent_id", "okey").agg(F.count(F.lit(1)).alias("m"))
    li = lineitem.select(F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("ln"),
                         F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk")).where("okey is not null").repartition(tasks, "okey")
    lines = li.groupBy("okey").agg(F.count(F.lit(1)).alias("n"))
    sized = o.join(lines, "okey", "left").select(
        "sent_id", "okey", "m", (F.col("m") * F.coalesce("n", F.lit(0))).alias("inner"),
        (F.col("m") * (F.coalesce("n", F.lit(0)) + 2)).alias("size"))
    placed = cut_lineage(grouped_total(sized, ["sent_id"], [F.col("okey")], "size", tasks=tasks).select(
        "sent_id", "okey", "m", "inner", "size", (F.col("before") + 2).alias("at")))

    rank = F.row_number().over(Window.partitionBy("okey").orderBy("ln", "pk", "sk")) - 1
    leaves = li.select("okey", F.concat(F.lit("p"), F.col("pk")).alias("tok"), rank.alias("r")).join(
        placed.select("sent_id", "okey", "m", "at").repartition(tasks, "okey"), "okey")
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1)).alias("c")
    leaves = leaves.select("sent_id", "tok", (F.col("at") + F.col("m") * (F.col("r") + 1)).alias("at"), copy).select(
        "sent_id", (F.col("at") + F.col("c")).alias("pos"), "tok")
    first, last = F.col("at") + F.col("c"), F.col("at") + F.col("m") + F.col("inner") + F.col("c")
    brackets = placed.select("*", copy).select("sent_id", F.inline(F.array(
        F.struct(first.alias("pos"), F.lit("(O").alias("tok")), F.struct(last.alias("pos"), F.lit("O)").alias("tok")))))
    end = F.col("end")
    ends = placed.groupBy("sent_id").agg((F.sum("size") + 2).alias("end")).select("sent_id", F.inline(F.array(
        F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit(BOS).alias("tok")),
        F.struct(F.lit(1).cast("bigint").alias("pos"), F.lit("(C").alias("tok")),
        F.struct(end.alias("pos"), F.lit("C)").alias("tok")), F.struct((end + 1).alias("pos"), F.lit(EOS).alias("tok")))))
    tokens = leaves.unionByName(brackets).unionByName(ends).select("sent_id", F.col("pos").cast("int").alias("pos"), "tok")
    if dealt is None:
        return tokens
    tokens = dealt(tokens, placed.agg(F.sum("size")).first()[0] or 0)
    release(placed)
    return tokens


def broken_order_tree(acts: DataFrame) -> DataFrame:
    """Order trees of which every twelfth stays whole and the others are broken by the remainder of
    their id (see ``BREAKS``); remainder 9 keeps its first token only."""
    m, tok = F.col("sent_id") % 12, F.col("tok")
    for rest, (at, new) in BREAKS.items():
        here = F.col("pos") == at if isinstance(at, int) else F.col("tok") == at
        tok = F.when((m == rest) & here, F.lit(new)).otherwise(tok)
    return acts.where((m != 9) | (F.col("pos") == 0)).withColumn("tok", tok)


#: Remainder of the id by 12: (position or token replaced, token put there).
BREAKS = {1: ("C)", "end"), 2: ("C)", "X)"), 3: (3, ""), 4: (3, "(x)"), 5: (3, "("), 6: (3, " "), 7: (0, "x"), 8: (3, "<s>"),
          10: (1, "t"), 11: (3, "O)")}


def html_tokens(fragment: Column) -> Column:
    """Tag tree tokens of an HTML fragment: ``<x ..>`` -> ``(x``, ``</x>`` -> ``x)``, words as terminals.

    Parentheses inside words become square brackets so words never read as brackets.
    """
    pieces = F.regexp_extract_all(fragment, F.lit(PIECE_RE), F.lit(0))

    def one(p: Column) -> Column:
        words = F.filter(F.split(F.translate(p, "()", "[]"), r"\s+"), lambda w: w != "")
        return (
            F.when(p.startswith("</"), F.array(F.concat(F.regexp_extract(p, CLOSE_NAME_RE, 1), F.lit(")"))))
            .when(p.startswith("<"), F.array(F.concat(F.lit("("), F.regexp_extract(p, OPEN_NAME_RE, 1))))
            .otherwise(words)
        )

    return F.flatten(F.transform(pieces, one))


def _explode_actions(df: DataFrame, toks: Column) -> DataFrame:
    return df.select(
        F.col("page_id").cast("bigint").alias("sent_id"),
        F.posexplode(frame(toks)).alias("pos", "tok"),
    ).select("sent_id", F.col("pos").cast("int").alias("pos"), "tok")


def page_tree(pages: DataFrame) -> DataFrame:
    body = F.regexp_replace(F.col("html"), DROP_RE, "")
    return _explode_actions(pages, html_tokens(body))
