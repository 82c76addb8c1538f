"""Metrics (E1-E12) and conversations (C1-C7) against the golden fixtures."""

import pytest
from pyspark.sql import functions as F

from arborlex.operators import chat as C
from arborlex.operators import metrics as M

from . import golden_values as GV


def _pairs(spark, cases):
    rows = [(c, i, p, g) for c, (ps, gs) in enumerate(cases) for i, (p, g) in enumerate(zip(ps, gs))]
    return spark.createDataFrame(rows, "case_id bigint, item_id bigint, pred int, gold int")


def test_macro_f1_docstring(spark):
    f = M.macro_f1(_pairs(spark, [([0, 2, 1, 0, 0, 2], [0, 1, 2, 0, 1, 2])]), by=["case_id"]).first()
    assert abs(f.macro_f1 - 0.43333333333333335) < 1e-12


def test_macro_f1_goldens(spark):
    cases = [([0, 2, 1, 0, 0, 2], [0, 1, 2, 0, 1, 2])] + [(c["preds"], c["golds"]) for c in GV.F1_CASES]
    expect = [0.4333] + GV.F1_EXPECTED
    exp_df = spark.createDataFrame(list(enumerate(expect)), "case_id bigint, expected double")
    res = M.macro_f1(_pairs(spark, cases), by=["case_id"]).join(exp_df, "case_id")
    ok = res.select(M.within_tolerance(F.col("macro_f1"), F.col("expected")).alias("ok")).collect()
    assert len(ok) == len(expect) and all(r.ok for r in ok)


def test_accuracy_points_failure(spark):
    pairs = _pairs(spark, [([1, 2, 3, 4], [1, 2, 0, 0])])
    a = M.accuracy(pairs).first()
    assert (a.n, a.n_correct, a.accuracy) == (4, 2, 0.5)
    pts = M.accuracy(pairs).select(M.threshold_points(F.col("accuracy"), M.ACCURACY_THRESHOLDS).alias("p")).first().p
    assert pts == 3
    loss = spark.createDataFrame([(3.0,), (3.5,)], "loss double")
    got = [r.p for r in loss.select(M.threshold_points(F.col("loss"), M.LOSS_THRESHOLDS, False, 2).alias("p"))
           .orderBy("p").collect()]
    assert got == [0, 2]
    f = M.failure_example(pairs).first()
    assert (f.item_id, f.pred, f.gold) == (3, 4, 0)


def test_top1_and_contract(spark):
    s = spark.createDataFrame([(1, 0, 0.2), (1, 1, 0.8), (2, 0, 0.5), (2, 1, 0.5)],
                              "item_id bigint, label int, score double")
    t = {r.item_id: (r.label, r.score) for r in M.top1(s).collect()}
    assert t == {1: (1, 0.8), 2: (0, 0.5)}
    named = M.label_names(M.top1(s))
    c = M.prediction_contract(named).first()
    assert (c.n, c.bad_label, c.bad_score) == (2, 0, 0)


def test_seeded_sample_is_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r.k for r in M.seeded_sample(df, "k", 83).collect()]
    b = [r.k for r in M.seeded_sample(df.repartition(7), "k", 83).collect()]
    assert a == b and len(set(a)) == 83


README_PROMPT = ("<|im_start|>system\nYou are a helpful AI assistant named SmolLM, trained by Hugging Face<|im_end|>\n"
                 "<|im_start|>user\nWhat is the capital of France?<|im_end|>\n<|im_start|>assistant\n")


def _turns(spark, dialogs):
    rows = [(c, t, m["role"], m["content"]) for c, d in enumerate(dialogs) for t, m in enumerate(d)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_render_readme_example(spark):
    t = _turns(spark, [[{"role": "user", "content": "What is the capital of France?"}]])
    assert C.render(t).first().prompt == README_PROMPT
    pieces = C.render_pieces(t).orderBy("turn").collect()
    assert "".join(p.piece for p in pieces) + "<|im_start|>assistant\n" == README_PROMPT


def test_chat_audit_goldens(spark):
    t = _turns(spark, GV.DIALOGS)
    a = C.audit(C.render(t), t).collect()
    assert len(a) == len(GV.DIALOGS)
    assert all(r.starts_with_system and r.one_system_block and r.all_contained for r in a)


def test_refusal_keyword_last_append_strip(spark):
    d = [[{"role": "user", "content": "What is the size of earth?"},
          {"role": "assistant", "content": "I'm sorry, but as an AI, I don't have the ability."}],
         [{"role": "user", "content": "Colour of the sky?"},
          {"role": "assistant", "content": "It is Blue."}]]
    t = _turns(spark, d)
    flags = {r.conv_id: r.f for r in t.where("role = 'assistant'").select("conv_id", C.is_refusal(F.col("text"))
                                                                            .alias("f")).collect()}
    assert flags == {0: True, 1: False}
    kw = t.where("conv_id = 1 AND role = 'assistant'").select(C.has_keyword(F.col("text"), F.lit("blue")).alias("k"))
    assert kw.first().k
    last = {r.conv_id: r.last_text for r in C.last_reply(t).collect()}
    assert last[1] == "It is Blue."
    msg = spark.createDataFrame([(1, "user", "Thanks")], "conv_id bigint, role string, text string")
    app = C.append_turn(t, msg).where("conv_id = 1").orderBy("turn").collect()
    assert [(r.turn, r.text) for r in app][-1] == (2, "Thanks")
    ids = spark.createDataFrame([([5, 6, 7, 8, 9],)], "o array<int>")
    assert ids.select(C.strip_prompt(F.col("o"), F.lit(2), 2).alias("s")).first().s == [7, 8]
