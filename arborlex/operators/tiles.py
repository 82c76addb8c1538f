"""Block-sparse attention masks (T10-T12, T14, B5, B6): tiles instead of n x n cells in a row.

A tile is a square of ``TILE`` rows and columns of one example's mask.  It is stored by its columns: for each
column with a set cell, the column's number in the tile and a bitmap of its rows, so a tile is at
most ``TILE`` small structs whatever the example's length.  Tiles without a set cell don't exist, and padding a mask
on both axes (B5) adds none.  The leading axis of an example's mask (``[1, n, n]``) and of a batch's
(``[B, 1, L, L]``) stands in its shape; a row of either refers to its tiles by the example's id.

Tiles are made from the live intervals of the keys, without edges: an interval that covers r tile rows gives r bitmaps.

The hash tree (T14) goes from tiles to rows of tiles, examples and the dataset.  A row of tiles also hashes the tokens,
labels and positions of its ``TILE`` places, an example its rows in order; examples are numbered by id and folded ``FAN`` at a
time, level by level.  Changing a cell changes one path, and an example is proved by its siblings on the way up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import dense_index
from ..session import cut_lineage
from .trees import packed_masks

TILE = 32   # a column's rows in one long, sign bit unused
FAN = 16    # children of a node above the examples


def _tile(at: Column) -> Column:
    return F.floor(at / F.lit(TILE)).cast("int")


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % TILE).cast("int"))


def _bits(first: Column, last: Column) -> Column:
    """Bits ``first`` to ``last`` (0 to TILE - 1)."""
    one = F.lit(1).cast("bigint")
    return F.call_function("shiftleft", one, (last + 1).cast("int")) - F.call_function("shiftleft", one, first.cast("int"))


def mask_tiles(inputs: DataFrame, intervals: DataFrame) -> DataFrame:
    """``(sent_id, tile_row, tile_col, columns array<struct<col, rows>>, ones)`` of every tile with a set cell.

    ``intervals`` are the live intervals of the keys of ``inputs``, the expanded tokens.  Rules as for the edges: a row but
    ``</s>`` sees itself, a closer what dies at it, any other row what lives at it.  The keys are shuffled once, to the rows of tiles
    that they live in; there a column's bits follow from its key and the closers' bits, and tiles are cut in place.
    """
    top, end, n = F.col("first"), F.col("end"), F.col("n_in")
    zero = F.lit(0).cast("bigint")
    place = lambda at: F.when((at >= top) & (at < end), _bit(at)).otherwise(zero)
    closers = F.aggregate("keys", zero, lambda acc, x: F.when(x["closer"], acc.bitwiseOR(place(x["ki"]))).otherwise(acc))
    rows = packed_masks(intervals, TILE).select("sent_id", F.col("span").alias("tile_row"), "first", "end", "n_in", "keys",
                                               F.bitwise_not(closers).alias("others"))
    x = F.col("x")
    rows = rows.select("sent_id", "tile_row", "first", "end", "n_in", "others", F.explode("keys").alias("x"))
    born, last = F.greatest(x["ki"] + 1, top), F.least(x["death"], n - 1, end) - 1
    lives = F.when(last >= born, _bits(born - top, last - top).bitwiseAND(F.col("others"))).otherwise(zero)
    dies = F.when(x["death"] < n, place(x["death"])).otherwise(zero)
    own = F.struct(x["ki"].alias("ki"), lives.bitwiseOR(dies).bitwiseOR(place(x["ki"])).alias("rows"))
    copy = F.struct((x["ki"] + 1).alias("ki"), place(x["ki"] + 1).alias("rows"))  # a closer's copy sees itself and is no key
    columns = rows.select("sent_id", "tile_row", F.inline(F.when(x["closer"], F.array(own, copy)).otherwise(F.array(own)))).where("rows != 0")
    cell = F.struct((F.col("ki") % TILE).cast("int").alias("col"), F.col("rows"))
    return columns.groupBy("sent_id", "tile_row", _tile(F.col("ki")).alias("tile_col")).agg(
        F.sort_array(F.collect_list(cell)).alias("columns"), F.sum(F.bit_count("rows")).cast("bigint").alias("ones"))


def tile_text(columns: Column) -> Column:
    """``col:rows`` of a tile's columns in order."""
    return F.array_join(F.transform(columns, lambda x: F.concat_ws(":", x["col"].cast("string"), x["rows"].cast("string"))), ",")


def tile_edges(tiles: DataFrame) -> DataFrame:
    """The set cells ``(sent_id, qi, ki)`` of the tiles."""
    cells = tiles.select("sent_id", "tile_row", "tile_col", F.explode("columns").alias("x"))
    rows = F.filter(F.sequence(F.lit(0), F.lit(TILE - 1)), lambda i: F.call_function("getbit", F.col("x.rows"), i) == 1)
    return cells.select("sent_id", F.explode(rows).alias("r"), "tile_row", "tile_col", "x").select(
        "sent_id", (F.col("tile_row") * TILE + F.col("r")).alias("qi"), (F.col("tile_col") * TILE + F.col("x.col")).alias("ki"))


def references(inputs: DataFrame, tiles: DataFrame) -> DataFrame:
    """``(sent_id, n, shape, n_tiles, ones)``: what an example's row holds of its mask ``[1, n, n]``."""
    sizes = inputs.groupBy("sent_id").agg(F.max("n_in").cast("int").alias("n"))
    held = tiles.groupBy("sent_id").agg(F.count(F.lit(1)).alias("n_tiles"), F.sum("ones").alias("ones"))
    shape = F.array(F.lit(1), F.col("n"), F.col("n"))
    return sizes.join(held, "sent_id", "left").select(
        "sent_id", "n", shape.alias("shape"), F.coalesce("n_tiles", F.lit(0)).cast("bigint").alias("n_tiles"),
        F.coalesce("ones", F.lit(0)).cast("bigint").alias("ones"))


def batch_masks(batches: DataFrame, refs: DataFrame) -> DataFrame:
    """One row per batch of ``batches(batch_id, sent_id, max_len)`` with the shape ``[B, 1, L, L]`` and its
    examples' references in order (as many as the batch has examples)."""
    ref = F.struct("sent_id", "n", "n_tiles", "ones")
    rows = batches.join(refs, "sent_id").groupBy("batch_id").agg(
        F.max("max_len").cast("int").alias("max_len"), F.sort_array(F.collect_list(ref)).alias("masks"))
    shape = F.array(F.size("masks"), F.lit(1), F.col("max_len"), F.col("max_len"))
    return rows.select("batch_id", shape.alias("shape"), "masks")


# hash tree -----------------------------------------------------------------------------------

def row_hashes(inputs: DataFrame, tiles: DataFrame) -> DataFrame:
    """``(sent_id, tile_row, hash)``: MD5 over the places of the row of tiles and over its tiles in order."""
    place = F.struct("idx", F.concat_ws("\t", "tok", "label", F.col("pid").cast("string")).alias("line"))
    places = inputs.groupBy("sent_id", _tile(F.col("idx")).alias("tile_row")).agg(
        F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(place)), lambda x: x["line"]), "\n")).alias("places"))
    leaf = F.struct("tile_col", F.md5(F.concat_ws("|", F.col("tile_col").cast("string"), tile_text(F.col("columns")))).alias("h"))
    held = tiles.groupBy("sent_id", "tile_row").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(leaf)), lambda x: x["h"]), "").alias("tiles"))
    return places.join(held, ["sent_id", "tile_row"], "left").select(
        "sent_id", "tile_row", F.md5(F.concat("places", F.coalesce("tiles", F.lit("")))).alias("hash"))


def example_hashes(rows: DataFrame) -> DataFrame:
    """``(sent_id, hash)``: MD5 over an example's row hashes in order."""
    return rows.groupBy("sent_id").agg(F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("tile_row", "hash"))), lambda x: x["hash"]), "")).alias("hash"))


def hash_tree(examples: DataFrame, fan: int = FAN) -> DataFrame:
    """``(level, i, sent_id, hash)``: the examples numbered by id on level 0, each level above with a node for ``fan`` below,
    up to the root.  The number of levels grows with the logarithm of the dataset; no examples give an empty table."""
    level = cut_lineage(dense_index(examples, [F.col("sent_id")], name="i").select("i", "sent_id", "hash"))
    out, number = level.select(F.lit(0).alias("level"), "i", "sent_id", "hash"), 0
    while level.limit(2).count() > 1:
        number += 1
        level = cut_lineage(level.groupBy(F.floor(F.col("i") / fan).cast("bigint").alias("parent")).agg(F.md5(F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("i", "hash"))), lambda x: x["hash"]), "")).alias("hash")).select(
            F.col("parent").alias("i"), F.lit(None).cast("bigint").alias("sent_id"), "hash"))
        out = out.unionByName(level.select(F.lit(number).alias("level"), "i", "sent_id", "hash"))
    return out


def proof(tree: DataFrame, sent_id: int, fan: int = FAN) -> list[list[str]]:
    """The siblings' hashes, the example's own included, on every level below the root: what proves the example."""
    at = tree.where((F.col("level") == 0) & (F.col("sent_id") == sent_id)).select("i").first()
    out, i = [], at.i
    top = tree.agg(F.max("level")).first()[0]
    for level in range(top):
        first = i // fan * fan
        rows = tree.where((F.col("level") == level) & F.col("i").between(first, first + fan - 1)).orderBy("i").collect()
        out.append([r.hash for r in rows])
        i //= fan
    return out
