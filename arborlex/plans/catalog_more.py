"""Registered queries: vocabulary, batching, metrics, chat, counts and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import manhattan, nearest_int, sign
from ..operators import batching as B
from ..operators import chat as C
from ..operators import counts as K
from ..operators import metrics as M
from ..operators import sampling as S
from ..operators import trees as T
from ..operators import vocab as V
from ..session import release
from .catalog import _t, order_actions, order_inputs, query

N_TOPICS = 10
SAMPLE_K = 83          # size of the seeded evaluation sample
SEED = "42"
TOPK = 5
BERNOULLI_P = 0.1
OWN_KEYWORDS = ("ths", "heit", "ment", "ciones")  # for C4 with a list of the caller's own


# ------------------------------------------------------------------ vocabulary

def docs_corpus(spark, d) -> DataFrame:
    return _t(spark, d, "documents").select(F.col("doc_id").alias("sent_id"), "text")


def docs_vocab(spark, d) -> DataFrame:
    return V.train_word_vocab(docs_corpus(spark, d))


@query("text_lines")
def text_lines(spark, d):
    """Every line of every document as its own row (the line-per-row text source)."""
    from ..sources.text import split_lines
    return split_lines(_t(spark, d, "documents").select("doc_id", "text"), "doc_id")


@query("vocab_json")
def vocab_json(spark, d):
    """The entries of every event's JSON object of names and numbers."""
    from ..sources.text import vocab_entries
    return vocab_entries(_t(spark, d, "events"), "props", "event_id")


@query("vocab_train")
def vocab_train(spark, d):
    """V1-V3: word vocabulary of the documents (specials first, no size limit)."""
    return docs_vocab(spark, d)


@query("vocab_size")
def vocab_size(spark, d):
    """V4."""
    return V.vocab_size(docs_vocab(spark, d))


@query("vocab_specials")
def vocab_specials(spark, d):
    """V3: ids of the pad/bos/eos/unk roles."""
    return V.special_ids(docs_vocab(spark, d))


@query("vocab_encode")
def vocab_encode(spark, d):
    """V5-V7: framed documents -> ids; per document token count, unknown count and an id checksum."""
    ids = V.tokenize_ids(docs_corpus(spark, d), docs_vocab(spark, d))
    return ids.groupBy(F.col("sent_id").alias("doc_id")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_tokens"),
        F.count_if(F.col("token_id") == 0).cast("bigint").alias("n_unk"),
        F.sum(F.col("token_id") * (F.col("pos") + 1)).cast("bigint").alias("id_checksum"),
    )


def bench_ids(spark, d) -> DataFrame:
    bench = _t(spark, d, "benchmark").select(F.col("item_id").alias("sent_id"), "text")
    return V.tokenize_ids(bench, docs_vocab(spark, d))


@query("vocab_decode")
def vocab_decode(spark, d):
    """V9: benchmark passages encoded with the document vocabulary, decoded without specials."""
    return V.decode(bench_ids(spark, d), docs_vocab(spark, d)).select(
        F.col("sent_id").alias("item_id"), "text")


@query("vocab_unk")
def vocab_unk(spark, d):
    """V6: unknown-word counts of the benchmark passages under the document vocabulary."""
    ids = bench_ids(spark, d).where(F.col("tok") != T.BOS).where(F.col("tok") != T.EOS)
    return ids.groupBy(F.col("sent_id").alias("item_id")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_words"),
        F.count_if(F.col("token_id") == 0).cast("bigint").alias("n_unk"))


def prefix_merges(vocab: DataFrame) -> DataFrame:
    """A merge list derived from a vocabulary: each token of 2+ characters is its prefix + last
    character, ranked by token id (used to exercise the merge cleanup on real tables)."""
    n = F.length("token")
    return vocab.where(n >= 2).select(
        F.col("id").alias("rank"), F.expr("substring(token, 1, length(token) - 1)").alias("a"),
        F.expr("substring(token, length(token), 1)").alias("b"))


@query("vocab_clean")
def vocab_clean(spark, d):
    """Document vocabulary without multi-digit tokens, renumbered in old order."""
    return V.clean_vocab(docs_vocab(spark, d))


@query("merge_clean")
def merge_clean(spark, d):
    """V11 on the prefix merge list of the document vocabulary."""
    vocab = docs_vocab(spark, d)
    return V.clean_merges(prefix_merges(vocab), V.clean_vocab(vocab))


@query("vocab_audit")
def vocab_audit(spark, d):
    """V12."""
    vocab = docs_vocab(spark, d)
    return V.audit_vocab(vocab, V.clean_vocab(vocab))


@query("merge_audit")
def merge_audit(spark, d):
    """V13."""
    vocab = docs_vocab(spark, d)
    m = prefix_merges(vocab)
    return V.audit_merges(m, V.clean_merges(m, V.clean_vocab(vocab)))


# ------------------------------------------------------------------ batching

def order_examples(spark, d) -> DataFrame:
    """Order trees as id sequences: vocabulary trained on the tree tokens themselves."""
    acts = order_actions(spark, d)
    return examples_of(acts, T.expand(acts))


def examples_of(acts: DataFrame, inp: DataFrame) -> DataFrame:
    vocab = V.train_word_vocab(acts.select(F.col("tok").alias("text")), repeated=True)  # tokens hold no white space
    pad_id = V.SPECIALS.index(T.PAD)
    # a label is its token, or the pad token of a closer's copy: one lookup gives both ids
    ids = V.encode(inp, vocab, tok_col="tok").select("sent_id", "idx", F.col("token_id").alias("input_id"), (F.col("kind") == "D").alias("copy"), "pid")
    seq = ids.repartition("sent_id").groupBy("sent_id").agg(F.sort_array(F.collect_list(F.struct("idx", "input_id", "copy", "pid")))
                                                            .alias("s"))
    label = lambda x: F.when(x["copy"], F.lit(pad_id).cast("bigint")).otherwise(x["input_id"])
    return seq.select(
        "sent_id",
        F.transform("s", lambda x: x["input_id"]).alias("input_ids"),
        V.mask_labels(F.transform("s", label), pad_id).alias("labels"),
        F.transform("s", lambda x: x["pid"].cast("bigint")).alias("position_ids"),
    )


def order_masks(spark, d, together: bool = True) -> DataFrame:
    """The padded examples of the order trees with their masks, packed by sentence, from one set of expanded tokens.  A mask meets its
    example before the examples get their batches, so that both are moved once."""
    acts = order_actions(spark, d)
    inp = T.materialize(T.expand(acts).drop("label"), dealt=True)  # the label's id follows from kind
    examples = examples_of(acts, inp)
    release(acts)
    masks = T.mask_edges(inp, packed=True, span=None).select("sent_id", "n_in", "keys")
    padded = B.pad_batches(examples.join(masks, "sent_id"), V.SPECIALS.index(T.PAD), cells=True, together=together)
    release(inp)
    return padded


@query("pad_batches")
def pad_batches(spark, d):
    """B1-B4 (+V7/V8): order-tree examples padded per batch of 16."""
    pad_id = V.SPECIALS.index(T.PAD)
    p = B.pad_batches(order_examples(spark, d), pad_id)

    def txt(c):
        return F.array_join(F.col(c).cast("array<string>"), " ").alias(c)
    return p.select("batch_id", "sent_id", F.col("max_len").cast("int").alias("max_len"),
                    txt("input_ids"), txt("labels"), txt("position_ids"))


@query("batch_stack")
def batch_stack(spark, d):
    """One row per batch with its examples in order."""
    pad_id = V.SPECIALS.index(T.PAD)
    st = B.stack_batches(B.pad_batches(order_examples(spark, d), pad_id))
    return st.select(
        "batch_id", F.array_join(F.col("sent_ids").cast("array<string>"), " ").alias("sent_ids"),
        F.size("sent_ids").cast("int").alias("n_rows"), F.col("max_len").cast("int").alias("max_len"))


@query("batch_mask_padded")
def batch_mask_padded(spark, d):
    """Dense order-tree masks zero-padded on both axes to their batch length."""
    return B.padded_mask_rows(order_masks(spark, d, together=False))


# ------------------------------------------------------------------ metrics

def topic_scores(spark, d) -> DataFrame:
    """(vec_id, gold, scores): for each topic the share of exp(-squared distance to its centroid)
    over all floats of the vector."""
    emb = _t(spark, d, "embeddings").select("vec_id", "embedding", F.col("label").alias("gold"))
    return M.centroid_scores(emb, "embedding", "gold", N_TOPICS)


def topic_top(spark, d) -> DataFrame:
    return M.top1_of_array(topic_scores(spark, d))


def topic_pairs(spark, d) -> DataFrame:
    return topic_top(spark, d).select(F.col("vec_id").alias("item_id"), F.col("label").alias("pred"), "gold", "score")


@query("top1_label")
def top1_label(spark, d):
    """E1 over softmax scores of the distances to the topic centroids."""
    t = topic_top(spark, d)
    return t.select("vec_id", "label", F.round("score", 6).alias("score"))


@query("label_names")
def label_names(spark, d):
    """E4."""
    t = topic_top(spark, d)
    return M.label_names(t).select("vec_id", "label", "label_name")


@query("prediction_contract")
def prediction_contract(spark, d):
    """E3."""
    return M.prediction_contract(M.label_names(topic_top(spark, d)))


@query("accuracy")
def accuracy(spark, d):
    """E5."""
    a = M.accuracy(topic_pairs(spark, d))
    return a.select("n", "n_correct", F.round("accuracy", 6).alias("accuracy"))


@query("macro_f1")
def macro_f1(spark, d):
    """E6."""
    return M.macro_f1(topic_pairs(spark, d)).select(F.round("macro_f1", 6).alias("macro_f1"))


@query("per_class_f1")
def per_class_f1(spark, d):
    """E6 detail: per-class counts and F1 over the label union."""
    f = M.per_class_f1(topic_pairs(spark, d))
    return f.select(F.col("label").cast("int").alias("label"), F.col("tp").cast("bigint").alias("tp"),
                    F.col("np").cast("bigint").alias("np"), F.col("ng").cast("bigint").alias("ng"),
                    F.round("f1", 6).alias("f1"))


@query("threshold_points")
def threshold_points(spark, d):
    """One point per accuracy threshold met."""
    a = M.accuracy(topic_pairs(spark, d))
    return a.select(F.round("accuracy", 6).alias("accuracy"),
                    M.threshold_points(F.col("accuracy"), M.ACCURACY_THRESHOLDS).alias("points"))


@query("loss_points")
def loss_points(spark, d):
    """Two points per loss threshold met; loss = mean negative log-probability of the gold label."""
    p = topic_scores(spark, d).agg(F.avg(-F.log(F.get("scores", F.col("gold")))).alias("loss"))
    return p.select(F.round("loss", 6).alias("loss"),
                    M.threshold_points(F.col("loss"), M.LOSS_THRESHOLDS, higher_is_better=False, weight=2)
                    .alias("points"))


@query("failure_example")
def failure_example(spark, d):
    """E10."""
    return M.failure_example(topic_pairs(spark, d)).select(F.col("item_id").alias("vec_id"), "pred", "gold")


@query("tolerance")
def tolerance(spark, d):
    """Per-class F1 on even vs odd ids, compared within 1e-3."""
    p = topic_pairs(spark, d).withColumn("half", F.when(F.col("item_id") % 2 == 0, "even").otherwise("odd"))
    f = M.per_class_f1(p, by=["half"])
    e = f.where(F.col("half") == "even").select("label", F.col("f1").alias("f1_even"))
    o = f.where(F.col("half") == "odd").select("label", F.col("f1").alias("f1_odd"))
    j = e.join(o, "label", "full").select(
        F.col("label").cast("int").alias("label"),
        F.coalesce("f1_even", F.lit(0.0)).alias("a"), F.coalesce("f1_odd", F.lit(0.0)).alias("b"))
    return j.select("label", F.round("a", 6).alias("f1_even"), F.round("b", 6).alias("f1_odd"),
                    M.within_tolerance(F.col("a"), F.col("b")).alias("within"))


@query("rounded_report")
def rounded_report(spark, d):
    """Accuracy to 2 places, macro F1 to 4."""
    pairs = topic_pairs(spark, d)
    a = M.accuracy(pairs).select(M.rounded(F.col("accuracy"), 2).alias("accuracy_2"))
    f = M.macro_f1(pairs).select(M.rounded(F.col("macro_f1"), 4).alias("macro_f1_4"))
    return V.one_row(a, f)


@query("seeded_sample")
def seeded_sample(spark, d):
    """83 documents drawn without replacement with seed "42"."""
    return M.seeded_sample(_t(spark, d, "documents"), "doc_id", SAMPLE_K, SEED).select("doc_id", "u")


# ------------------------------------------------------------------ chat

def turns(spark, d) -> DataFrame:
    return _t(spark, d, "conversations").select("conv_id", "turn", "role", "text")


@query("chat_render")
def chat_render(spark, d):
    """C1 with the assistant generation prompt."""
    return C.render(turns(spark, d))


@query("chat_audit")
def chat_audit(spark, d):
    """C2."""
    t = turns(spark, d)
    return C.audit(C.render(t), t)


@query("chat_last")
def chat_last(spark, d):
    """C3."""
    return C.last_reply(turns(spark, d))


@query("chat_refusal")
def chat_refusal(spark, d):
    """C4 on every assistant turn: the fixed keywords, and a list of the caller's own."""
    t = turns(spark, d).where(F.col("role") == "assistant")
    return t.select("conv_id", "turn", C.is_refusal(F.col("text")).alias("is_refusal"),
                    C.is_refusal(F.col("text"), OWN_KEYWORDS).alias("has_own"))


@query("chat_keyword")
def chat_keyword(spark, d):
    """Does any assistant reply mention a word of the first user message, for each of its words?"""
    from ..operators.keywords import own_keyword_hits
    t = turns(spark, d)
    asked = t.where(F.col("role") == "user").groupBy("conv_id").agg(F.min_by("text", "turn").alias("q")).select(
        "conv_id", F.array_distinct(V.split_words(F.col("q"))).alias("keywords"))
    # one pass over each reply for all words of its conversation
    replies = t.where(F.col("role") == "assistant").select("conv_id", "text").join(asked, "conv_id")
    hits = replies.select("conv_id", F.explode(own_keyword_hits(F.col("keywords"), F.col("text"))).alias("i")).distinct()
    words = asked.select("conv_id", F.posexplode("keywords").alias("i", "keyword"))
    return words.join(hits.withColumn("found", F.lit(True)), ["conv_id", "i"], "left").select(
        "conv_id", "keyword", F.coalesce("found", F.lit(False)).alias("found"))


@query("chat_append")
def chat_append(spark, d):
    """Append a user follow-up to every conversation."""
    t = turns(spark, d)
    msgs = t.select("conv_id").distinct().select("conv_id", F.lit("user").alias("role"),
                                                 F.lit("Please continue.").alias("text"))
    return C.append_turn(t, msgs)


@query("chat_strip")
def chat_strip(spark, d):
    """C7 on every conversation: what its last turn adds to the rendered turns before it (the prompt),
    cut at the prompt's real length in tokens, 128 new tokens at most.  Tokens are the words of the
    rendered text (a block ends with a line break, so the prompt's words begin the output's)."""
    t = turns(spark, d)
    last = t.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    t = t.join(last, "conv_id")
    prompt = C.render(t.where(F.col("turn") < F.col("last_turn")).drop("last_turn"), add_generation_prompt=False)
    full = C.render(t.drop("last_turn"), add_generation_prompt=False).withColumnRenamed("prompt", "full")
    j = full.join(prompt, "conv_id", "left")
    n_prompt = F.coalesce(F.size(V.split_words(F.col("prompt"))), F.lit(0))
    kept = C.strip_prompt(V.split_words(F.col("full")), F.when(F.col("prompt").isNull(), F.lit(0)).otherwise(n_prompt))
    return j.select("conv_id", F.array_join(kept, " ").alias("reply"), F.size(kept).alias("n_new"))


# ------------------------------------------------------------------ counts

def lang_counts(spark, d) -> DataFrame:
    docs = _t(spark, d, "documents").select("lang", V.split_words(F.col("text")).alias("w"))
    return K.increment_all(docs, "lang", "w")


def doc_counts(spark, d) -> DataFrame:
    docs = _t(spark, d, "documents").select("doc_id", V.split_words(F.col("text")).alias("w"))
    return K.increment_all(docs, "doc_id", "w")


def bench_counts(spark, d, grp: str = "benchmark") -> DataFrame:
    b = _t(spark, d, "benchmark").select(F.lit(grp).alias("g"), V.split_words(F.col("text")).alias("w"))
    return K.increment_all(b, "g", "w")


@query("count_increment")
def count_increment(spark, d):
    """K1: word counts per language."""
    return lang_counts(spark, d)


@query("count_argmax")
def count_argmax(spark, d):
    """K2: most frequent word of each document."""
    return K.argmax(doc_counts(spark, d)).select(F.col("grp").alias("doc_id"), "key")


@query("count_topk")
def count_topk(spark, d):
    """K3: five most frequent words per language."""
    return K.top_k(lang_counts(spark, d), TOPK)


@query("count_sorted")
def count_sorted(spark, d):
    """K3: every word of every language ranked by count."""
    return K.sorted_keys(lang_counts(spark, d))


@query("count_total")
def count_total(spark, d):
    """K4."""
    return K.total(lang_counts(spark, d))


@query("count_norm")
def count_norm(spark, d):
    """K5."""
    return K.normalize(lang_counts(spark, d)).select("grp", "key", F.round("value", 9).alias("value"))


@query("count_scale")
def count_scale(spark, d):
    """K6."""
    return K.divide_all(lang_counts(spark, d), 2.0)


@query("count_dot")
def count_dot(spark, d):
    """K7: each language's counts . the benchmark's counts."""
    return K.dot(lang_counts(spark, d), bench_counts(spark, d)).select("grp_a", "grp_b", "dot")


def _all_docs(spark, d) -> DataFrame:
    docs = _t(spark, d, "documents").select(F.lit("corpus").alias("g"), V.split_words(F.col("text")).alias("w"))
    return K.increment_all(docs, "g", "w")


@query("count_add")
def count_add(spark, d):
    """K8: corpus counts + benchmark counts."""
    return K.add(_all_docs(spark, d), bench_counts(spark, d, "corpus"))


@query("count_sub")
def count_sub(spark, d):
    """K9: corpus counts - benchmark counts (zeros kept)."""
    return K.subtract(_all_docs(spark, d), bench_counts(spark, d, "corpus"))


# ------------------------------------------------------------------ sampling and helpers

def event_dist(spark, d) -> DataFrame:
    return _t(spark, d, "events").select(F.col("event_type").alias("value"), F.col("value").alias("weight"))


@query("weighted_draw")
def weighted_draw(spark, d):
    """One event type per user, drawn by total event value."""
    users = _t(spark, d, "events").select("user_id").distinct()
    r = S.weighted_draw(users, "user_id", event_dist(spark, d), seed=SEED)
    return r.select("user_id", F.col("value").alias("event_type"))


@query("weighted_draw_inclusive")
def weighted_draw_inclusive(spark, d):
    """K10, the single-draw rule: the first value whose cumulative weight reaches the draw (u <= cdf)."""
    users = _t(spark, d, "events").select("user_id").distinct()
    r = S.weighted_draw(users, "user_id", event_dist(spark, d), seed=SEED, inclusive_upper=True)
    return r.select("user_id", F.col("value").alias("event_type"))


@query("value_probability")
def value_probability(spark, d):
    """K11."""
    p = S.value_probability(event_dist(spark, d))
    return p.select(F.col("value").alias("event_type"), F.round("probability", 9).alias("probability"))


@query("bernoulli")
def bernoulli(spark, d):
    """Events kept with probability 0.1."""
    return S.bernoulli(_t(spark, d, "events"), "event_id", BERNOULLI_P, SEED).select("event_id")


@query("transpose")
def transpose(spark, d):
    """K13 + K14: the order-tree masks' ones are kept as coordinates (the edges), transposed."""
    inp = order_inputs(spark, d)
    return S.transpose(T.mask_edges(inp).select("sent_id", F.col("qi").alias("row"), F.col("ki").alias("col")))


@query("scalar_helpers")
def scalar_helpers(spark, d):
    """K16 over lineitem."""
    li = _t(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(manhattan(F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"), F.lit(0.0)), 6).alias("l1"),
        nearest_int(F.col("l_extendedprice") / 1000).alias("nearest"),
        sign(F.col("l_quantity") - 25).alias("sgn"),
    )


# ------------------------------------------------------------------ model-backed (rows-only checks)

@query("bpe_encode")
def bpe_encode(spark, d):
    """V14 (+V10/V11): clean the corpus's own pair model, then byte-level BPE over every document: numbers
    of pieces and pre-tokens, and the digest of the ordered pieces."""
    from ..operators import bpe as P
    docs = _t(spark, d, "documents")
    vocab, merges = P.pair_model(docs)
    cv = V.clean_vocab(vocab)
    enc = P.bpe_rows(docs, cv, V.clean_merges(merges, cv))
    pieces = F.flatten("pieces")
    return enc.select("doc_id", F.size(pieces).cast("bigint").alias("n_tokens"), F.size("pieces").cast("bigint").alias("n_pretokens"),
                      F.md5(F.array_join(pieces, " ")).alias("pieces_md5"))


@query("batch_full")
def batch_full(spark, d):
    """B6 with T11: one row per batch with all four columns, the mask of each example padded on both axes."""
    ex = order_masks(spark, d)

    def txt(c):
        return F.array_join(F.col(c).cast("array<string>"), " ").alias(c)

    def stacked(c):
        return F.array_join(F.transform("r", lambda x: x[c]), ";")
    ex = ex.select("batch_id", "sent_id", "max_len", txt("input_ids"), txt("labels"), txt("position_ids"), "n_in", "keys")
    st = ex.groupBy("batch_id").agg(F.max("max_len").alias("max_len"), F.sort_array(F.collect_list(F.struct(
        "sent_id", "input_ids", "labels", "position_ids", "n_in", "keys"))).alias("r"))
    # the dense masks are made beside their batch: what is shuffled are their keys
    return B.padded_masks_md5(st.select(
        "batch_id", F.size("r").alias("n_rows"), stacked("input_ids").alias("input_ids"), stacked("labels").alias("labels"),
        stacked("position_ids").alias("position_ids"), "max_len", F.transform("r", lambda x: F.struct(x["n_in"], x["keys"])).alias("masks")))


@query("text_classifier")
def text_classifier(spark, d):
    """Quality classifier trained on the labelled documents, scored on all documents."""
    from ..operators import classify as CL
    docs = _t(spark, d, "documents").select("doc_id", "text")
    model = CL.fit_text_classifier(docs, _t(spark, d, "labels"), "quality")
    s = CL.score(docs, model)
    return s.select("doc_id", "label", F.round("score", 6).alias("score"))


def nb_pairs(spark, d) -> DataFrame:
    """(item_id, pred, gold) of the exact classifier on the labelled documents."""
    gold = _t(spark, d, "labels").select(F.col("doc_id").alias("item_id"), F.col("quality").alias("gold"))
    pred = nb_classifier(spark, d).select(F.col("doc_id").alias("item_id"), F.col("label").alias("pred"))
    return pred.join(gold, "item_id")


@query("nb_classifier")
def nb_classifier(spark, d):
    """A word-count classifier of quality, fitted on all labelled documents, over all documents."""
    from ..operators import classify as CL
    docs = _t(spark, d, "documents").select("doc_id", "text")
    odds = CL.naive_bayes_log_odds(docs, CL.naive_bayes_weights(docs, _t(spark, d, "labels"), "quality"))
    return odds.select("doc_id", (F.col("log_odds") > 0).cast("int").alias("label"), F.round("log_odds", 4).alias("log_odds"))


@query("nb_report")
def nb_report(spark, d):
    """E5, E6, E8 on the classifier of E2."""
    from ..session import cut_lineage
    pairs = cut_lineage(nb_pairs(spark, d))
    acc = M.accuracy(pairs).select("n", "n_correct", F.round("accuracy", 6).alias("accuracy"), M.threshold_points(
        F.col("accuracy"), M.ACCURACY_THRESHOLDS).alias("points"))
    return V.one_row(acc, M.macro_f1(pairs).select(F.round("macro_f1", 6).alias("macro_f1")))


@query("nb_failure")
def nb_failure(spark, d):
    """E10 on the classifier of E2: one misjudged document with its text."""
    f = M.failure_example(nb_pairs(spark, d)).select(F.col("item_id").alias("doc_id"), "pred", "gold")
    return _t(spark, d, "documents").select("doc_id", "text").join(F.broadcast(f), "doc_id").select(
        "doc_id", "pred", "gold", "text")
