"""Operator 9: quality rules by weak supervision (DataFrame functions only).

Each rule looks at one figure of a text and votes good (1), votes bad (-1) or abstains (0).  Instead of a text
having to pass all rules, the rules' error rates are estimated without labels: a latent class
model gives each rule a chance of each vote for good and for bad texts, and expectation-
maximisation alternates between the posterior of each *vote pattern* and these chances.  Texts are counted by
pattern first, so EM runs on at most 3**rules rows whatever the number of texts.  A text is kept
if its posterior chance of being good reaches ``KEEP``.  Texts that fail the base rules are never kept.

Repeated three-word windows are found within the row: each window's hash and position make one
64-bit key, the keys are sorted, and neighbours with equal hashes are compared word by word.

Edge cases.  Null and empty texts have no words and fail the base rules.  Texts of fewer than three
words have no windows.  Columns besides doc_id and text are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, WS_CLASS, written

SYMBOLS = "#*$%&|<>"
#: A plain word: letters (with inner marks), then at most one mark of a clause's or sentence's end.
PLAIN = r"^\p{L}[\p{L}\p{M}'’-]*[.,;:!?]?$"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEEP = 0.5
ROUNDS = 15

#: Rule: (figure, bad below, bad above, good from, good to); None where a side has no limit.
RULES = {
    "symbols": ("n_symbols / n_words", None, 0.2, 0.0, 0.02),
    "plain": ("n_plain / n_words", 0.7, None, 0.9, 1.0),
    "repeats": ("n_repeat_words / n_words", None, 0.4, 0.0, 0.15),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", None, 0.5, 0.0, 0.0),
    "distinct": ("n_distinct / n_words", 0.15, None, 0.3, 1.0),
    "word_length": ("word_chars / n_words", 2.0, 15.0, 3.0, 10.0),
    "capitals": ("n_upper / greatest(word_chars, 1)", None, 0.4, 0.0, 0.15),
    "shouting": ("n_bang / n_words", None, 0.3, 0.0, 0.05),
    "length": ("n_words", 50.0, None, 50.0, None),
}


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeated(words: Column, keys: Column, bits: Column) -> Column:
    """Sorted places of the windows that the text has twice or more; ``keys`` are sorted."""
    at = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1)
    hashed = lambda x: F.call_function("shiftrightunsigned", x, bits)

    def same(x, y):
        p, q = at(x).cast("int"), at(y).cast("int")
        equal = hashed(x) == hashed(y)
        for i in range(3):
            equal = equal & (F.get(words, p + i) == F.get(words, q + i))
        return F.coalesce(equal, F.lit(False))

    twice = F.filter(keys, lambda x, k: same(x, F.get(keys, k + 1)) | same(x, F.get(keys, k - 1)))
    return F.sort_array(F.transform(twice, at))


def figures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct,
    n_plain, n_upper, n_bang)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{WS_CLASS}]"))
    rows = rows.select(
        "doc_id", F.array_remove(F.split("text", f"[{WS_CLASS}]+", -1), "").alias("words"), lines.alias("lines"),
        F.length(F.translate("text", WS_CHARS, "")).alias("word_chars"), _without(F.col("text"), SYMBOLS).alias("n_symbols"),
        _without(F.col("text"), UPPER).alias("n_upper"), _without(F.col("text"), "!").alias("n_bang"))
    rows = rows.select("*", F.size("words").alias("n_words"), F.size("lines").alias("n_lines"),
                       F.size(F.array_distinct("lines")).alias("n_line_texts"),
                       F.size(F.array_distinct("words")).alias("n_distinct"),
                       F.size(F.filter("words", lambda w: w.rlike(PLAIN))).alias("n_plain"),
                       F.length(F.bin(F.size("words"))).cast("int").alias("bits")).drop("lines")
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    keys = F.transform(F.sequence(F.lit(0), F.col("n_words") - 3), lambda i: F.call_function(
        "shiftleft", window(i), F.col("bits")) + i)
    rows = rows.withColumn("keys", F.when(F.col("n_words") >= 3, F.sort_array(keys)))
    rows = rows.withColumn("at", _repeated(F.col("words"), F.col("keys"), F.col("bits")))
    covered = F.transform("at", lambda p, k: F.least(F.lit(3).cast("bigint"), F.coalesce(F.get("at", k + 1) - p, F.lit(3).cast("bigint"))))
    repeat = F.coalesce(F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0))
    return rows.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("n_words", "word_chars", "n_symbols")],
                       (F.col("n_lines") - F.col("n_line_texts")).cast("bigint").alias("n_dup_lines"),
                       repeat.cast("bigint").alias("n_repeat_words"), "n_lines", "n_distinct", "n_plain", "n_upper", "n_bang")


def _vote(rule: str) -> Column:
    figure, low, high, first, last = RULES[rule]
    x = F.expr(figure.replace("n_words", "greatest(n_words, 1)") if "/ n_words" in figure else figure)
    bad, good = F.lit(False), F.lit(True)
    if low is not None:
        bad = bad | (x < low)
    if high is not None:
        bad = bad | (x > high)
    if first is not None:
        good = good & (x >= first)
    if last is not None:
        good = good & (x <= last)
    return F.when(bad, -1).when(good, 1).otherwise(0).alias(f"v_{rule}")


class Chances:
    """The share of bad texts, and each rule's chance of each vote for bad and good texts."""

    def __init__(self, bad: float, votes: dict[str, dict[int, tuple[float, float]]]):
        self.bad, self.votes = bad, votes

    def good(self) -> Column:
        """Posterior chance of good, of a row with vote columns."""
        odds = F.lit(math.log((1 - self.bad) / self.bad))
        for rule, chance in self.votes.items():
            ratio = {v: math.log(g / b) for v, (b, g) in chance.items()}
            v = F.col(f"v_{rule}")
            odds = odds + F.when(v == -1, ratio[-1]).when(v == 1, ratio[1]).otherwise(ratio[0])
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Chances:
    """EM over ``patterns`` (a v_ column for each rule, and their number of texts n).

    It starts from all-must-pass: a pattern with a bad vote is bad with chance 0.9, another one
    with chance 0.05.  Sums are smoothed by one text a vote, and a rule's bad votes are held to be
    likelier for bad texts than for good ones, which fixes which class is which.
    """
    names = list(RULES)
    good = F.when(F.least(*[F.col(f"v_{r}") for r in names]) < 0, 0.1).otherwise(0.95)
    chances = Chances(0.5, {})
    for _ in range(rounds):
        sums = [F.sum(F.col("n") * (1 - good)).alias("b"), F.sum(F.col("n") * good).alias("g")]
        for r in names:
            for v in (-1, 0, 1):
                here = F.when(F.col(f"v_{r}") == v, F.col("n")).otherwise(0)
                sums += [F.sum(here * (1 - good)).alias(f"b{v}{r}"), F.sum(here * good).alias(f"g{v}{r}")]
        s = patterns.agg(*sums).first().asDict()
        b, g = s["b"] or 0.0, s["g"] or 0.0
        votes = {}
        for r in names:
            votes[r] = {v: (((s[f"b{v}{r}"] or 0.0) + 1) / (b + 3), ((s[f"g{v}{r}"] or 0.0) + 1) / (g + 3)) for v in (-1, 0, 1)}
            if votes[r][-1][0] < votes[r][-1][1]:
                votes[r] = {v: (1 / 3, 1 / 3) for v in (-1, 0, 1)}
        chances = Chances((b + 1) / (b + g + 2), votes)
        good = chances.good()
    return chances


def judged(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """The figures, ``base_failed``, ``p_good`` and ``kept`` of every row of ``docs``."""
    rows = figures(docs)
    rows = written(rows.select("*", *[_vote(r) for r in RULES]), "rule-votes")
    patterns = written(rows.groupBy(*[f"v_{r}" for r in RULES]).agg(F.count(F.lit(1)).alias("n")), "patterns")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("p_good", estimate(patterns).good()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= keep))
