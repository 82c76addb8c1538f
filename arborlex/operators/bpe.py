"""Byte-level BPE encoding of a corpus.

Plan: pre-tokenise with the JVM regex and run the merge loop in an Arrow-batched pandas UDF over
each row's array of pre-tokens, each distinct one merged once a batch.  Nothing is shuffled.  The
model is size-checked before it is broadcast.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Tp

# Fixed value: the GPT-2 pre-tokenisation pattern ((?U) makes \s Unicode-aware in Java).
PRETOKEN_RE = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_MODEL_ROWS = 2_000_000  # vocabulary + merge rows allowed in one broadcast


def byte_alphabet() -> list[str]:
    """Printable stand-in for every byte (the GPT-2 rule): printable Latin-1 bytes map to
    themselves, the other bytes to code points 256, 257, ... in byte order."""
    keep = set(range(ord("!"), ord("~") + 1)) | set(range(ord("¡"), ord("¬") + 1)) | set(range(ord("®"), ord("ÿ") + 1))
    out, extra = [], 0
    for b in range(256):
        if b in keep:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


def make_encoder(model):
    """The Arrow batch function ``pd.Series[str] -> pd.Series[list[str]]`` over a broadcast
    ``(vocab set, pair ranks, byte alphabet)``.  It is a closure made on the driver, so it
    is shipped to the Python workers by value (nothing to install on executors)."""

    def merge_word(symbols: list[str], ranks: dict) -> list[str]:
        # merge the lowest-ranked adjacent pair (leftmost on ties) until none is in the table: the pairs
        # wait in a heap, symbols are linked with their neighbours, and stale heap entries are passed over
        import heapq

        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1)
                if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        symbols = list(symbols)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j], after[i] = left + right, None, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n and (r := ranks.get((symbols[x], symbols[after[x]]))) is not None:
                    heapq.heappush(heap, (r, x, symbols[x], symbols[after[x]]))
        return [x for x in symbols if x is not None]

    def encode_word(pt: str) -> list[str]:
        # symbols missing from the vocabulary are dropped (no unknown token is configured)
        vocab, ranks, alphabet = model.value
        return merge_word([c for c in (alphabet[b] for b in pt.encode("utf-8")) if c in vocab], ranks)

    def encode_batch(lists: pd.Series) -> pd.Series:
        import pandas

        known: dict[str, list[str]] = {}  # words merged once a batch
        out = []
        for pts in lists:
            pieces = []
            for pt in pts if pts is not None else ():
                if pt not in known:
                    known[pt] = encode_word(pt)
                pieces.append(known[pt])
            out.append(pieces)
        return pandas.Series(out)

    return encode_batch


def _bounded_rows(df: DataFrame, what: str) -> list:
    rows = df.limit(MAX_MODEL_ROWS + 1).collect()
    if len(rows) > MAX_MODEL_ROWS:
        raise ValueError(f"BPE {what} has more than {MAX_MODEL_ROWS} rows; above the broadcast bound")
    return rows


def _model(vocab: DataFrame, merges: DataFrame) -> tuple[set[str], dict[tuple[str, str], int]]:
    """The model tables, size-checked, as driver-side lookups for one broadcast."""
    toks = {r.token for r in _bounded_rows(vocab.select("token"), "vocabulary")}
    ranks = {(r.a, r.b): int(r.rank) for r in _bounded_rows(merges.select("rank", "a", "b"), "merge list")}
    return toks, ranks


def pair_model(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """A model of the corpus itself, without a cap: every adjacent byte pair inside its pre-tokens is a
    merge, ranked by (count descending, bytes).  Returns ``vocab(token, id)`` and ``merges(rank, a, b)``.

    Pre-tokens are counted first (map-side partial), and there are 256 x 256 pairs at most, so the
    windows that number them and the broadcast of the model are bounded.
    """
    spark, alphabet = docs.sparkSession, byte_alphabet()
    words = docs.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(PRETOKEN_RE), F.lit(0))).alias("pt")).groupBy(
        "pt").agg(F.count(F.lit(1)).alias("n"))
    h = F.hex(F.encode("pt", "UTF-8"))
    pairs = words.select("n", h.alias("h")).where(F.length("h") >= 4).select("n", F.explode(F.transform(
        F.sequence(F.lit(1), (F.length("h") / 2 - 1).cast("int")), lambda i: F.substring(F.col("h"), 2 * i - 1, F.lit(4)))).alias("p"))
    pairs = pairs.groupBy("p").agg(F.sum("n").alias("n"))
    byte = lambda at: F.element_at(F.array(*map(F.lit, alphabet)), F.conv(F.substring("p", at, 2), 16, 10).cast("int") + 1)
    merges = pairs.select((F.row_number().over(Window.orderBy(F.col("n").desc(), "p")) - 1).cast("bigint").alias("rank"),
                          byte(1).alias("a"), byte(3).alias("b"))
    from ..session import cut_lineage

    merges = cut_lineage(merges)  # read by the cleanup and by the model
    tokens = spark.createDataFrame([(c,) for c in alphabet], "token string").unionByName(
        merges.select(F.concat("a", "b").alias("token"))).distinct()
    return tokens.select("token", (F.row_number().over(Window.orderBy("token")) - 1).cast("bigint").alias("id")), merges


def bpe_rows(docs: DataFrame, vocab: DataFrame, merges: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``(doc_id, pieces)``: for each pre-token of the text its pieces, in one narrow pass over the rows.
    Arrow batches are bounded in bytes, so a Python worker's memory follows neither the rows of a task nor their length."""
    spark = docs.sparkSession
    toks, ranks = _model(vocab, merges)
    bc = spark.sparkContext.broadcast((toks, ranks, byte_alphabet()))
    encode = F.pandas_udf(make_encoder(bc), returnType=Tp.ArrayType(Tp.ArrayType(Tp.StringType())))
    from ..session import bounded

    return bounded(docs).select(F.col(id_col).alias("doc_id"), encode(
        F.regexp_extract_all(F.col(text_col), F.lit(PRETOKEN_RE), F.lit(0))).alias("pieces"))


def bpe_encode(docs: DataFrame, vocab: DataFrame, merges: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Long form ``(doc_id, pt_pos, piece_pos, piece)``."""
    rows = bpe_rows(docs, vocab, merges, id_col, text_col)
    words = rows.select("doc_id", F.posexplode("pieces").alias("pt_pos", "ps"))
    return words.select("doc_id", "pt_pos", F.posexplode("ps").alias("piece_pos", "piece"))


def encoded_text(long_form: DataFrame) -> DataFrame:
    """``(doc_id, tokens)``: pieces space-joined in text order (the fixture output form)."""
    return long_form.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pt_pos", "piece_pos", "piece"))),
                                 lambda x: x["piece"]), " ").alias("tokens"))
