"""Many keywords at once (C4, C5): an Aho-Corasick automaton goes over each text a single time.

Matching is containment without regard to case, as for one keyword: keywords and texts are lower-cased by Spark, and
overlapping keywords are all found.  Automata are built inside the tasks.

``keyword_hits`` takes one list for all texts.  A list of at most ``MAX_CHARS`` characters is broadcast whole; a longer one
is dealt to blocks of that size and each block goes over the texts, so any list is used to its end.
``own_keyword_hits`` takes a list for each row, for instance the words of a conversation's question.

Null texts hold nothing.  A null keyword is no keyword; the empty one stands in every text that isn't null.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import running_total

MAX_CHARS = 8 << 20


def _automaton(words: list[str]):
    import ahocorasick
    made = ahocorasick.Automaton()
    for i, w in enumerate(words):
        if w:
            made.add_word(w, i)
    made.make_automaton()
    return made


def _found(automaton, text: str) -> list[int]:
    return sorted({i for _, i in automaton.iter(text)}) if len(automaton) else []


def keyword_hits(texts: DataFrame, keywords: DataFrame, id_col: str, text_col: str = "text", max_chars: int = MAX_CHARS) -> DataFrame:
    """``(id, keyword)`` for every distinct keyword of ``keywords(keyword)`` in a text, lower-cased."""
    spark = texts.sparkSession
    words = keywords.select(F.lower("keyword").alias("keyword")).where(F.col("keyword").isNotNull()).distinct()
    sized = running_total(words.withColumn("size", F.length("keyword").cast("bigint") + 1), [F.col("keyword")], "size")
    sized = sized.select("keyword", F.floor((F.col("cum") - F.col("size")) / F.lit(max_chars)).cast("bigint").alias("block"))
    out = None
    for block in [r.block for r in sized.select("block").distinct().orderBy("block").collect()]:
        held = spark.sparkContext.broadcast([r.keyword for r in sized.where(F.col("block") == block).orderBy("keyword").collect()])

        def scan(batches, held=held):
            words_ = held.value
            automaton = _automaton(words_)
            empty = [i for i, w in enumerate(words_) if not w]
            for batch in batches:
                ids, found = [], []
                for key, text in zip(batch[id_col], batch["text"], strict=True):
                    if text is not None:
                        hits = [*empty, *_found(automaton, text)]
                        ids += [key] * len(hits)
                        found += [words_[i] for i in hits]
                yield pd.DataFrame({id_col: pd.Series(ids, dtype=object), "keyword": pd.Series(found, dtype=object)})

        rows = texts.select(F.col(id_col).cast("string").alias(id_col), F.lower(text_col).alias("text")).mapInPandas(
            scan, f"`{id_col}` string, keyword string")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], f"`{id_col}` string, keyword string")
    return out.select(F.col(id_col).cast(texts.schema[id_col].dataType).alias(id_col), "keyword")


def own_keyword_hits(keywords: Column, text: Column) -> Column:
    """The places (from 0) of the keywords that the text holds; equal keywords next to each other share an automaton."""
    @F.pandas_udf("array<int>")
    def hits(lists: pd.Series, texts: pd.Series) -> pd.Series:
        out, held, automaton = [], None, None
        for words, value in zip(lists, texts, strict=True):
            if words is None or value is None:
                out.append([])
                continue
            words = tuple(words)
            if words != held:
                held, automaton = words, None
                groups: dict[str, list[int]] = {}
                for i, w in enumerate(words):
                    if w is not None:
                        groups.setdefault(w, []).append(i)
                kinds = list(groups)
                automaton = _automaton(kinds)
            found = [i for k in _found(automaton, value) for i in groups[kinds[k]]]
            out.append(sorted(found + groups.get("", [])))
        return pd.Series(out, dtype=object)

    return hits(F.transform(keywords, F.lower), F.lower(text))
