"""Training of byte-level BPE merges on a corpus (V14): merges of merges, in rounds of pair counts kept up to date.

The state is two tables: the distinct pre-tokens as sequences of symbols with their numbers, and the numbers of
adjacent symbol pairs.  A round takes a batch of merges that don't touch each other, rewrites the pre-tokens that
hold one of them, and changes the pair counts by what those pre-tokens lost and gained; no other
pre-token is counted again.  Texts are read once, for the pre-tokens' numbers.

The batch of a round: of the ``candidates`` first pairs by (number downwards, first symbol, second symbol), in this
order, each that shares no symbol with one already taken, ``batch`` at most.  The most frequent pair is always in it.  No
more than ``candidates`` rows reach the driver.

A sequence is one string with every symbol between two marks that no symbol has.  Merges are applied by their rank,
each from left to right.  Symbols compare by the bytes of their UTF-8.

Null texts have no pre-tokens.  Pairs seen less than ``least`` times are never taken; rounds end early when none is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bpe import PRETOKEN_RE, byte_alphabet

OPEN, CLOSE = "\x01", "\x02"
ROUNDS, BATCH, CANDIDATES, LEAST = 6, 64, 256, 2


def pretokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(pt, n): the distinct pre-tokens of all texts."""
    return docs.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(PRETOKEN_RE), F.lit(0))).alias("pt")).groupBy(
        "pt").agg(F.count(F.lit(1)).alias("n"))


def byte_symbols(text: Column) -> Column:
    """The text's UTF-8 bytes as a sequence of symbols."""
    latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")  # one character a byte
    moved = [(chr(b), c) for b, c in enumerate(byte_alphabet()) if chr(b) != c]
    shown = F.translate(latin, "".join(a for a, _ in moved), "".join(c for _, c in moved))
    return F.regexp_replace(shown, "(?s)(.)", f"{OPEN}$1{CLOSE}")


def symbols(seq: Column) -> Column:
    """The array of a sequence's symbols; an empty sequence has none."""
    return F.when(F.length(seq) > 0, F.split(F.substr(seq, F.lit(2), F.length(seq) - 2), CLOSE + OPEN)).otherwise(
        F.array().cast("array<string>"))


def _pairs(words: DataFrame, seq: str, times: Column) -> DataFrame:
    rows = words.select(symbols(F.col(seq)).alias("s"), times.alias("n")).where(F.size("s") > 1)
    pair = F.transform(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.struct(
        F.element_at("s", i).alias("a"), F.element_at("s", i + 1).alias("b")))
    return rows.select(F.explode(pair).alias("p"), "n").select("p.a", "p.b", "n")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("a", "b").agg(F.sum("n").alias("n")).where("n > 0")


def next_merges(pairs: DataFrame, batch: int = BATCH, least: int = LEAST, candidates: int = CANDIDATES) -> list:
    """The round's merges (a, b, n), at most ``batch``, by rank."""
    taken, used = [], set()
    for m in pairs.where(F.col("n") >= least).orderBy(F.col("n").desc(), "a", "b").limit(candidates).collect():
        if len(taken) < batch and not {m.a, m.b} & used:
            taken.append(m)
            used |= {m.a, m.b}
    return taken


def apply_merges(seq: Column, merges: list) -> Column:
    """The sequence with the merges done in their order."""
    marked = [f"{OPEN}{m.a}{CLOSE}{OPEN}{m.b}{CLOSE}" for m in merges]
    steps = F.array(*[F.struct(F.lit(x).alias("old"), F.lit(x.replace(CLOSE + OPEN, "")).alias("new")) for x in marked])
    return F.aggregate(steps, seq, lambda s, m: F.replace(s, m["old"], m["new"]))


def holds_any(seq: Column, merges: list) -> Column:
    marked = F.array(*[F.lit(f"{OPEN}{m.a}{CLOSE}{OPEN}{m.b}{CLOSE}") for m in merges])
    return F.exists(marked, lambda x: F.contains(seq, x))


def train(docs: DataFrame, rounds: int = ROUNDS, batch: int = BATCH, least: int = LEAST, text_col: str = "text") -> DataFrame:
    """(rank, a, b, n): the merges in order, with the pair's number when it was taken."""
    spark = docs.sparkSession
    words = cut_lineage(pretokens(docs, text_col).select(byte_symbols(F.col("pt")).alias("w"), "n"))
    pairs = cut_lineage(_summed(_pairs(words, "w", F.col("n"))))
    out: list[tuple] = []
    for step in range(rounds):
        chosen = next_merges(pairs, batch, least)
        if not chosen:
            break
        out += [(len(out) + i, m.a, m.b, m.n) for i, m in enumerate(chosen)]
        if step + 1 == rounds:
            break
        hit = holds_any(F.col("w"), chosen)
        both = cut_lineage(words.select("n", F.col("w").alias("old"), F.when(hit, apply_merges(F.col("w"), chosen)).alias("new")))
        changed = both.where("new is not null")
        pairs = cut_lineage(_summed(pairs.unionByName(_pairs(changed, "old", -F.col("n"))).unionByName(
            _pairs(changed, "new", F.col("n")))))
        words = both.select(F.coalesce("new", "old").alias("w"), "n")
    return spark.createDataFrame(out, "rank bigint, a string, b string, n bigint")


def model(merges: DataFrame) -> DataFrame:
    """(token, id): the byte symbols and what each merge makes, by rank; a token that two merges make has one id."""
    alphabet = merges.sparkSession.createDataFrame([(i, c) for i, c in enumerate(byte_alphabet())], "id bigint, token string")
    made = merges.groupBy(F.concat("a", "b").alias("token")).agg((F.min("rank") + len(byte_alphabet())).alias("id"))
    return alphabet.unionByName(made).groupBy("token").agg(F.min("id").alias("id"))
