"""Word-level vocabularies, encoding and the digit-merge cleanup.

Tables:
  vocab   (token STRING, id BIGINT)
  merges  (rank BIGINT, a STRING, b STRING)     -- rank = order in the merge list
  corpus  (sent_id BIGINT, text STRING)
  actions (sent_id BIGINT, pos INT, tok STRING) -- long token form used by trees
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import dense_index
from .trees import BOS, EOS, PAD, UNK, frame

# Special tokens in id order, and the ignored-label id.
SPECIALS = (UNK, BOS, EOS, PAD)
IGNORE_ID = -100
# Characters for which Python's str.isdigit() is true in a byte-level alphabet.
DIGIT_CLASS = "[0-9²³¹]"
MULTI_DIGIT = DIGIT_CLASS + "{2}"


def split_words(text: Column) -> Column:
    """V1: whitespace split (Unicode whitespace, empty pieces dropped)."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_counts(corpus: DataFrame, text_col: str = "text", repeated: bool = False) -> DataFrame:
    """Token frequencies; the partial aggregate runs map-side before the shuffle.  With ``repeated``, equal texts are counted first and each
    is split once (for short texts that come often)."""
    if repeated:
        texts = corpus.groupBy(F.col(text_col).alias("_text")).agg(F.count(F.lit(1)).alias("_n"))
        return texts.select(F.explode(split_words(F.col("_text"))).alias("token"), "_n").groupBy("token").agg(F.sum("_n").alias("count"))
    return (
        corpus.select(F.explode(split_words(F.col(text_col))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def train_word_vocab(corpus: DataFrame, text_col: str = "text", vocab_size: int | None = None,
                     specials: tuple[str, ...] = SPECIALS, repeated: bool = False) -> DataFrame:
    """V2/V3: specials get ids 0..k-1, learned words follow by (count desc, token asc).

    ``vocab_size`` is an optional size limit (specials included); with a limit the learned
    part is a top-k, without one (the default) it is numbered by a distributed sort.
    """
    spark = corpus.sparkSession
    counts = word_counts(corpus, text_col, repeated).where(~F.col("token").isin(*specials))
    order = [F.col("count").desc(), F.col("token").asc()]
    k = len(specials)
    if vocab_size is not None:
        # a top-k: at most vocab_size rows, so one window numbers them (bounded)
        top = counts.orderBy(*order).limit(max(vocab_size - k, 0))
        learned = top.select("token", (F.row_number().over(Window.orderBy(*order)) - 1 + k).cast("bigint").alias("id"))
    else:
        learned = dense_index(counts, order, start=k).select("token", "id")
    spec = spark.createDataFrame([(t, i) for i, t in enumerate(specials)], "token string, id bigint")
    return spec.unionByName(learned)


def vocab_size(vocab: DataFrame) -> DataFrame:
    """V4."""
    return vocab.agg(F.count(F.lit(1)).cast("bigint").alias("vocab_size"))


def special_ids(vocab: DataFrame) -> DataFrame:
    """V3: one row with pad/bos/eos/unk ids."""
    roles = {"pad_id": PAD, "bos_id": BOS, "eos_id": EOS, "unk_id": UNK}
    return vocab.agg(*[F.max(F.when(F.col("token") == t, F.col("id"))).alias(r) for r, t in roles.items()])


def _lookup(vocab: DataFrame) -> DataFrame:
    """The vocabulary as a join side; the join strategy is left to the adaptive plan."""
    return vocab.select(F.col("token").alias("_tok"), F.col("id").alias("_id"))


def tokenize(corpus: DataFrame, vocab: DataFrame, text_col: str = "text", id_col: str = "sent_id") -> DataFrame:
    """V6 (+V5): text -> framed actions in long form; unknown words become ``<unk>``.

    The join is left to the adaptive plan (skew join is on): the vocabulary has no size bound.
    """
    words = corpus.select(
        F.col(id_col).cast("bigint").alias("sent_id"),
        F.posexplode(frame(split_words(F.col(text_col)))).alias("pos", "tok"),
    )
    j = words.join(_lookup(vocab), words.tok == F.col("_tok"), "left")
    return j.select(
        "sent_id", F.col("pos").cast("int").alias("pos"),
        F.when(F.col("_tok").isNull(), F.lit(UNK)).otherwise(F.col("tok")).alias("tok"),
    )


def tokenize_ids(corpus: DataFrame, vocab: DataFrame, text_col: str = "text", id_col: str = "sent_id",
                 unk_id: int = 0) -> DataFrame:
    """V6 + V7 in one lookup: framed tokens with ``<unk>`` mapping and their ids."""
    words = corpus.select(
        F.col(id_col).cast("bigint").alias("sent_id"),
        F.posexplode(frame(split_words(F.col(text_col)))).alias("pos", "tok"),
    )
    j = words.join(_lookup(vocab), words.tok == F.col("_tok"), "left")
    return j.select(
        "sent_id", F.col("pos").cast("int").alias("pos"),
        F.when(F.col("_tok").isNull(), F.lit(UNK)).otherwise(F.col("tok")).alias("tok"),
        F.coalesce(F.col("_id"), F.lit(unk_id)).cast("bigint").alias("token_id"),
    )


def encode(tokens: DataFrame, vocab: DataFrame, tok_col: str = "tok",
           unk_id: int = 0) -> DataFrame:
    """V7: token column -> id column (unknown -> the ``<unk>`` id)."""
    j = tokens.join(_lookup(vocab), tokens[tok_col] == F.col("_tok"), "left")
    return j.withColumn("token_id", F.coalesce(F.col("_id"), F.lit(unk_id)).cast("bigint")).drop("_tok", "_id")


def one_row(*frames: DataFrame) -> DataFrame:
    """Side-by-side join of single-row aggregates on a constant key."""
    out = frames[0].withColumn("_k", F.lit(1))
    for f in frames[1:]:
        out = out.join(F.broadcast(f.withColumn("_k", F.lit(1))), "_k")
    return out.drop("_k")


def mask_labels(label_ids: Column, pad_id: int | Column) -> Column:
    """V8: pad id -> -100 in an array of label ids."""
    p = F.lit(pad_id) if isinstance(pad_id, int) else pad_id
    return F.transform(label_ids, lambda x: F.when(x == p, F.lit(IGNORE_ID)).otherwise(x))


def decode(ids: DataFrame, vocab: DataFrame, group_col: str = "sent_id", order_col: str = "pos",
           id_col: str = "token_id") -> DataFrame:
    """V9: ids -> space-joined text per group, skipping special tokens."""
    v = vocab.where(~F.col("token").isin(*SPECIALS))
    j = ids.join(_lookup(v), ids[id_col] == F.col("_id"), "inner")
    return j.groupBy(group_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order_col, "_tok"))), lambda x: x["_tok"]),
                     " ").alias("text")
    )


def clean_vocab(vocab: DataFrame) -> DataFrame:
    """Drop tokens with two adjacent digits; renumber densely in old id order."""
    kept = vocab.where(~F.col("token").rlike(MULTI_DIGIT)).withColumnRenamed("id", "old_id")
    return dense_index(kept, [F.col("old_id").asc()], start=0, name="id").select("token", "id")


def clean_merges(merges: DataFrame, cleaned_vocab: DataFrame) -> DataFrame:
    """Keep (a, b) when a+b has no adjacent digits and both parts survive; rank order kept."""
    v = cleaned_vocab.select("token")
    m = merges.where(~F.concat("a", "b").rlike(MULTI_DIGIT))
    m = m.join(v.withColumnRenamed("token", "a"), "a", "left_semi")
    m = m.join(v.withColumnRenamed("token", "b"), "b", "left_semi")
    return m.select("rank", "a", "b")


def audit_vocab(old: DataFrame, new: DataFrame) -> DataFrame:
    """Ids are 0..n-1, every token was in the old vocabulary, old relative order kept."""
    j = new.alias("n").join(old.alias("o"), F.col("n.token") == F.col("o.token"), "left")
    stats = j.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("n.id").alias("min_id"),
        F.max("n.id").alias("max_id"),
        F.countDistinct("n.id").alias("distinct_ids"),
        F.count_if(F.col("o.token").isNull()).alias("not_in_old"),
    )
    # order kept <=> numbering the kept rows by old id reproduces the new ids
    inv = dense_index(j.select(F.col("n.id").alias("nid"), F.col("o.id").alias("oid")).where(F.col("oid").isNotNull()),
                      [F.col("oid").asc(), F.col("nid").asc()], name="r")
    moved = inv.agg(F.count_if(F.col("r") != F.col("nid")).alias("out_of_order"))
    s = one_row(stats, moved)
    return s.select(
        ((F.col("n") == 0) | ((F.col("min_id") == 0) & (F.col("max_id") == F.col("n") - 1)
                              & (F.col("distinct_ids") == F.col("n")))).alias("dense_ids"),
        (F.col("not_in_old") == 0).alias("subset_of_old"),
        (F.col("out_of_order") == 0).alias("order_kept"),
    )


def audit_merges(old: DataFrame, new: DataFrame) -> DataFrame:
    """No repeated pair, every pair in the old list, old relative order kept."""
    dup = new.groupBy("a", "b").count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("dups"))
    missing = new.join(old.select("a", "b"), ["a", "b"], "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    j = new.select(F.col("rank").alias("nr"), "a", "b").join(old.select(F.col("rank").alias("orank"), "a", "b"),
                                                            ["a", "b"])
    inv = dense_index(j, [F.col("orank").asc(), F.col("nr").asc()], name="r1")
    inv = dense_index(inv, [F.col("nr").asc(), F.col("orank").asc()], name="r2")
    moved = inv.agg(F.count_if(F.col("r1") != F.col("r2")).alias("moved"))
    s = one_row(dup, missing, moved)
    return s.select((F.col("dups") == 0).alias("no_repeats"), (F.col("missing") == 0).alias("subset_of_old"),
                    (F.col("moved") == 0).alias("order_kept"))
