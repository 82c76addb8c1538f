"""Vocabulary, encoding, digit cleanup and byte-level BPE."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from arborlex.operators import bpe as P
from arborlex.operators import vocab as V
from arborlex.sources import text as S

from . import golden_values as GV


def _vocab_df(spark, d):
    return spark.createDataFrame(list(d.items()), "token string, id bigint")


def _merges_df(spark, m):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(m)], "rank bigint, a string, b string")


def test_clean_example(spark):
    vocab = {'Ġ': 0, '1': 1, '2': 2, 'Ġ1': 3, 'Ġ2': 4, '12': 5, 'Ġ12': 6}
    merges = [('Ġ', '1'), ('Ġ', '2'), ('1', '2'), ('Ġ1', '2')]
    cv = V.clean_vocab(_vocab_df(spark, vocab))
    assert sorted((r.token, r.id) for r in cv.collect()) == sorted({'Ġ': 0, '1': 1, '2': 2, 'Ġ1': 3, 'Ġ2': 4}.items())
    cm = V.clean_merges(_merges_df(spark, merges), cv).orderBy("rank")
    assert [(r.a, r.b) for r in cm.collect()] == [('Ġ', '1'), ('Ġ', '2')]


def test_vocab_order_golden(spark):
    cv = V.clean_vocab(_vocab_df(spark, GV.ORDER_VOCAB)).orderBy("id")
    assert [(r.token, r.id) for r in cv.collect()] == GV.ORDER_VOCAB_CLEANED


@pytest.mark.parametrize("case", range(len(GV.BPE_CASES)))
def test_bpe_goldens(spark, case):
    c = GV.BPE_CASES[case]
    vocab, merges, sentences, expect = c["vocab"], c["merges"], c["sentences"], c["results"]
    cv = V.clean_vocab(_vocab_df(spark, vocab))
    cm = V.clean_merges(_merges_df(spark, merges), cv)
    audit = V.audit_vocab(_vocab_df(spark, vocab), cv).first()
    assert audit.dense_ids and audit.subset_of_old and audit.order_kept
    ma = V.audit_merges(_merges_df(spark, merges), cm).first()
    assert ma.no_repeats and ma.subset_of_old and ma.order_kept
    docs = spark.createDataFrame(list(enumerate(sentences)), "doc_id bigint, text string")
    out = P.encoded_text(P.bpe_encode(docs, cv, cm)).orderBy("doc_id").collect()
    assert [r.tokens for r in out] == expect


def test_audits_catch_damage(spark):
    old = _vocab_df(spark, {'a': 0, 'b': 1, 'c': 2})
    assert not V.audit_vocab(old, _vocab_df(spark, {'a': 0, 'c': 2})).first().dense_ids
    assert not V.audit_vocab(old, _vocab_df(spark, {'a': 0, 'z': 1})).first().subset_of_old
    assert not V.audit_vocab(old, _vocab_df(spark, {'b': 0, 'a': 1})).first().order_kept
    om = _merges_df(spark, [('a', 'b'), ('b', 'c')])
    assert not V.audit_merges(om, _merges_df(spark, [('b', 'c'), ('a', 'b')])).first().order_kept
    assert not V.audit_merges(om, _merges_df(spark, [('a', 'b'), ('a', 'b')])).first().no_repeats


def test_word_vocab_tokenize_encode_decode(spark):
    corpus = spark.createDataFrame([(0, "b a b"), (1, "c b  a")], "sent_id bigint, text string")
    vocab = V.train_word_vocab(corpus)
    got = {r.token: r.id for r in vocab.collect()}
    assert got == {'<unk>': 0, '<s>': 1, '</s>': 2, '<pad>': 3, 'b': 4, 'a': 5, 'c': 6}
    small = V.train_word_vocab(corpus, vocab_size=5)
    assert {r.token for r in small.collect()} == {'<unk>', '<s>', '</s>', '<pad>', 'b'}
    other = spark.createDataFrame([(7, "a zz c")], "sent_id bigint, text string")
    acts = V.tokenize(other, vocab).orderBy("pos").collect()
    assert [r.tok for r in acts] == ['<s>', 'a', '<unk>', 'c', '</s>']
    ids = V.encode(V.tokenize(other, vocab), vocab)
    assert [r.token_id for r in ids.orderBy("pos").collect()] == [1, 5, 0, 6, 2]
    assert V.decode(ids, vocab).first().text == "a c"
    assert V.vocab_size(vocab).first().vocab_size == 7
    assert V.special_ids(vocab).first().asDict() == {"pad_id": 3, "bos_id": 1, "eos_id": 2, "unk_id": 0}
    lab = spark.createDataFrame([([1, 3, 5, 3],)], "l array<int>")
    assert lab.select(V.mask_labels(F.col("l"), 3).alias("m")).first().m == [1, -100, 5, -100]


def test_sources_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="arborlex-src-")
    with open(os.path.join(d, "vocab.json"), "w", encoding="utf-8") as f:
        json.dump({"Ġ": 0, "a": 1, "Ġa": 2}, f)
    with open(os.path.join(d, "merges.txt"), "w", encoding="utf-8") as f:
        f.write("#version: 0.2\nĠ a\na a\n")
    with open(os.path.join(d, "corpus.txt"), "w", encoding="utf-8") as f:
        f.write("first line\nsecond line\nthird\n")
    v = S.read_vocab_json(spark, os.path.join(d, "vocab.json"))
    assert {r.token: r.id for r in v.collect()} == {"Ġ": 0, "a": 1, "Ġa": 2}
    m = S.read_merges(spark, os.path.join(d, "merges.txt")).orderBy("rank").collect()
    assert [(r.rank, r.a, r.b) for r in m] == [(0, "Ġ", "a"), (1, "a", "a")]
    lines = S.read_lines(spark, os.path.join(d, "corpus.txt")).orderBy("sent_id").collect()
    assert [(r.sent_id, r.text) for r in lines] == [(0, "first line"), (1, "second line"), (2, "third")]
    out = os.path.join(d, "ds")
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert S.write_dataset(rows.where("k = 1"), out, partition_by=["k"]) == 1
    assert S.write_dataset(rows, out, partition_by=["k"]) == 2
    assert S.write_dataset(rows, out, partition_by=["k"]) == 3  # a repeated write leaves one copy
    assert sorted((r.k, r.v) for r in S.read_dataset(spark, out).collect()) == [(1, "x"), (2, "y")]
    assert S.read_dataset(spark, out, 1).count() == 1
    assert S.write_dataset(rows.limit(0), out) == 4 and S.read_dataset(spark, out).count() == 0
    S.write_lines(spark.createDataFrame([(i, f"l{i}" if i % 7 else None) for i in range(500)], "i int, text string").repartition(6),
                  os.path.join(d, "lines"), ["i"])
    back = S.read_lines(spark, os.path.join(d, "lines")).orderBy("sent_id").collect()
    assert [r.text for r in back] == [f"l{i}" if i % 7 else "" for i in range(500)]
    with open(os.path.join(d, "metrics.json"), "w") as f:
        json.dump({"eval_loss": 2.5}, f)
    assert S.read_metrics(spark, os.path.join(d, "metrics.json")).first().eval_loss == 2.5
