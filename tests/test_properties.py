"""Property tests: random valid trees vs a direct stack simulation; counts and sampling laws."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pyarrow as pa
from pyspark.sql import functions as F

from arborlex.operators import batching as B
from arborlex.operators import counts as K
from arborlex.operators import sampling as S
from arborlex.operators import trees as T

from .treesim import simulate

NTS = ["S", "NP", "VP", "PP"]
WORDS = ["a", "b", "it's", 'q"x', "c\\d"]


def random_tree(rng, depth=0):
    nt = rng.choice(NTS)
    kids = []
    for _ in range(rng.randint(1, 3)):
        if depth < 3 and rng.random() < 0.4:
            kids += random_tree(rng, depth + 1)
        else:
            kids.append(rng.choice(WORDS))
    return [f"({nt}"] + kids + [f"{nt})"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(min_value=0, max_value=10_000), st.sampled_from([T.DEFAULT_CHUNK, 2, 5]))
def test_trees_match_stack_simulation(spark, seed, chunk):
    rng = random.Random(seed)
    seqs = []
    for _ in range(12):
        roots = [t for _ in range(rng.randint(1, 2)) for t in random_tree(rng)]
        seqs.append(["<s>"] + roots + ["</s>"])
    df = spark.createDataFrame(list(enumerate(seqs)), "sent_id bigint, actions array<string>")
    acts = T.from_arrays(df)
    assert T.validate(acts, chunk).count() == 0
    inp = T.expand(acts, chunk=chunk)
    edges = T.mask_edges(inp)
    ex = {r.sent_id: r for r in T.examples(inp, edges).collect()}
    deg = {}
    for r in T.mask_degree(inp, chunk=chunk).collect():
        deg.setdefault(r.sent_id, {})[r.qi] = r.degree
    for sid, seq in enumerate(seqs):
        inputs, labels, pos, rows = simulate(seq)
        got = ex[sid]
        assert got.inputs == inputs and got.labels == labels and got.position_ids == pos
        dense = [{k for k, v in enumerate(row) if v == 1.0} for row in got.attention_mask[0]]
        assert dense == rows
        assert [deg[sid][q] for q in range(len(inputs))] == [len(r) for r in rows]
        assert [t for t in labels if t != "<pad>"] == seq
        assert all(k <= q for q, r in enumerate(rows) for k in r)


def test_single_mutation_codes(spark):
    base = ["<s>", "(S", "(NP", "a", "NP)", "b", "S)", "</s>"]
    muts = {
        "mismatch": base[:4] + ["VP)"] + base[5:],
        "unclosed": base[:6] + base[7:],
        "empty_production": base[:3] + ["NP)"] + base[5:6] + base[6:],
        "outside": ["<s>", "x"] + base[1:],
    }
    df = spark.createDataFrame(list(enumerate(muts.values())), "sent_id bigint, actions array<string>")
    got = {r.sent_id: r.code for r in T.validate(T.from_arrays(df)).collect()}
    assert got == dict(enumerate(muts))


def _counts(spark, rows):
    return spark.createDataFrame(rows, "grp string, key string, value double")


def test_counter_docstrings(spark):
    a = _counts(spark, [("a", "first", -2.0), ("a", "second", 4.0), ("a", "third", 1.5), ("a", "fourth", 2.5)])
    b = _counts(spark, [("b", "first", 3.0), ("b", "second", 5.0)])
    assert K.dot(a, b).first().dot == 14.0
    s = {r.key: r.value for r in K.add(a, b.withColumn("grp", F.lit("a"))).collect()}
    assert s == {"first": 1.0, "second": 9.0, "third": 1.5, "fourth": 2.5}
    d = {r.key: r.value for r in K.subtract(a, b.withColumn("grp", F.lit("a"))).collect()}
    assert d == {"first": -5.0, "second": -1.0, "third": 1.5, "fourth": 2.5}
    assert K.argmax(a).first().key == "second"
    assert [r.key for r in K.sorted_keys(a).orderBy("rank").collect()] == ["second", "fourth", "third", "first"]
    assert [r.key for r in K.top_k(a, 2, salts=3).orderBy("rank").collect()] == ["second", "fourth"]
    assert K.total(a).first().total == 6.0
    n = {r.key: r.value for r in K.normalize(a).collect()}
    assert abs(sum(n.values()) - 1.0) < 1e-12
    z = K.normalize(_counts(spark, [("z", "k", 0.0)])).first().value
    assert z == 0.0
    pairs = spark.createDataFrame([("a", "b")], "grp_a string, grp_b string")
    assert K.dot_pairs(a.unionByName(b), pairs).first().dot == 14.0
    inc = spark.createDataFrame([("g", ["x", "y", "x"])], "g string, ks array<string>")
    assert {r.key: r.value for r in K.increment_all(inc, "g", "ks", 2.0).collect()} == {"x": 4.0, "y": 2.0}


def test_weighted_draw_matches_cdf(spark):
    dist = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 0.0), ("d", 4.0)], "value string, weight double")
    draws = spark.range(4000).withColumnRenamed("id", "k")
    got = S.weighted_draw(draws, "k", dist, buckets=7)
    assert got.count() == 4000
    rows = got.collect()
    for r in rows[:200]:
        if r.u < 1 / 8:
            assert r.value == "a"
        elif r.u < 4 / 8:
            assert r.value == "b"
        else:
            assert r.value == "d"
    share = {r.value: r["count"] for r in got.groupBy("value").count().collect()}
    assert abs(share["d"] / 4000 - 0.5) < 0.05 and "c" not in share
    p = {r.value: r.probability for r in S.value_probability(dist).collect()}
    assert p == {"a": 0.125, "b": 0.375, "c": 0.0, "d": 0.5}
    kept = S.bernoulli(draws, "k", 0.25).count()
    assert 850 < kept < 1150


def test_coordinates_transpose_and_padding(spark):
    m = spark.createDataFrame([(1, [[1.0, 0.0, 0.0], [1.0, 1.0, 0.0]])], "id int, m array<array<double>>")
    c = S.to_coordinates(m, "id", "m", 1.0)
    assert sorted((r.row, r.col) for r in c.collect()) == [(0, 0), (1, 0), (1, 1)]
    assert sorted((r.row, r.col) for r in S.transpose(c).collect()) == [(0, 0), (0, 1), (1, 1)]
    ex = spark.createDataFrame([(i, list(range(i + 1)), [5] * (i + 1), [0] * (i + 1)) for i in range(5)],
                               "sent_id bigint, input_ids array<int>, labels array<int>, position_ids array<int>")
    p = B.pad_batches(ex, pad_id=3, batch_size=2).orderBy("sent_id").collect()
    assert [r.batch_id for r in p] == [0, 0, 1, 1, 2]
    assert p[0].input_ids == [0, 3] and p[0].labels == [5, -100] and p[2].max_len == 4
    st_ = B.stack_batches(B.pad_batches(ex, pad_id=3, batch_size=2)).orderBy("batch_id").collect()
    assert st_[1].sent_ids == [2, 3]
    dm = spark.createDataFrame([([[1.0, 0.0], [1.0, 1.0]],)], "m array<array<float>>")
    out = dm.select(B.padded_dense_mask(F.col("m"), F.lit(3)).alias("p")).first().p
    assert out == [[1.0, 0.0, 0.0], [1.0, 1.0, 0.0], [0.0, 0.0, 0.0]]


def test_packed_masks_are_the_edges(spark):
    """Rows, texts and padded lines made in place from packed keys equal those made from shuffled edges."""
    rng = random.Random(4)
    seqs = [["<s>"] + [t for _ in range(3) for t in random_tree(rng)] + ["</s>"] for _ in range(8)] + [["<s>", "</s>"]]
    acts = T.from_arrays(spark.createDataFrame(list(enumerate(seqs)), "sent_id bigint, actions array<string>"))
    inp = T.materialize(T.expand(acts))
    edges = T.mask_edges(inp)
    assert {tuple(r) for r in edges.collect()} == {
        (i, q, k) for i, seq in enumerate(seqs) for q, row in enumerate(simulate(seq)[3]) for k in row}
    lines = {tuple(r) for r in T.dense_mask_text(inp, edges).collect()}
    for span in (None, 3, 256):
        packed = T.mask_edges(inp, packed=True, span=span)
        assert {tuple(r) for r in T.dense_mask_text(inp, packed).collect()} == lines
    whole = T.mask_edges(inp, packed=True, span=None)
    assert set(T.row_texts(inp, whole).collect()) == set(T.row_texts(inp, edges).collect())
    masks = T.dense_mask(inp, edges).join(whole, "sent_id").select(
        F.transform(B.padded_dense_mask(F.col("mask"), F.col("n_in") + 4), lambda r: F.array_join(r.cast("array<string>"), " ")).alias("a"),
        B.padded_mask_lines(T.packed_rows(F.lit(0), F.col("end"), F.col("n_in"), F.col("keys")), F.col("n_in") + 4).alias("b"))
    assert all(r.a == r.b for r in masks.collect())


def test_order_trees_of_repeated_and_missing_keys(spark):
    from arborlex.plans import inputs as I

    orders = [(1, 7), (2, 7), (2, 7), (3, 8), (None, 8), (4, None), (5, 9), (2, 9)]
    lines = [(1, 2, 20, 5), (1, 1, 21, 5), (2, 1, 30, 1), (2, 1, 30, 0), (2, None, 31, 4), (2, 3, None, 4), (4, 1, 1, 1), (None, 1, 2, 2), (6, 1, 1, 1)]
    got = I.order_tree(spark.createDataFrame(orders, "o_orderkey long, o_custkey long"), spark.createDataFrame(
        lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")).collect()
    low = lambda t: [(x is not None, x or 0) for x in t]
    for cust in {c for _, c in orders if c is not None}:
        want = ["<s>", "(C"]
        for key in sorted({k for k, c in orders if c == cust}, key=lambda k: (k is not None, k or 0)):
            m = orders.count((key, cust))
            parts = sorted(((n, p, s) for k, n, p, s in lines if k == key and k is not None for _ in range(m)), key=low)
            want += ["(O"] * m + [None if p is None else f"p{p}" for _, p, _ in parts] + ["O)"] * m
        want += ["C)", "</s>"]
        rows = sorted(((r.pos, r.tok) for r in got if r.sent_id == cust), key=lambda x: x[0])
        assert [p for p, _ in rows] == list(range(len(want))) and [t for _, t in rows] == want
    assert {r.sent_id for r in got} == {7, 8, 9}


def test_tasks_follow_the_rows(spark, monkeypatch):
    """The rows of a task stay the same however many there are."""
    monkeypatch.setattr(T, "ROWS_PER_TASK", 10)
    acts = T.spread(T.materialize(T.from_arrays(spark.createDataFrame(
        [(i, ["<s>", "(S", "a", "S)", "</s>"]) for i in range(100)], "sent_id bigint, actions array<string>"))))
    assert acts.rdd.getNumPartitions() == 50
    assert T.expand(acts).count() == 600


def test_dealt_tokens_are_scanned_where_they_lie(spark):
    """Checkpoints keep their partitioning: what scans sentences by their chunks shuffles nothing; long sentences are whole."""
    seqs = [["<s>", "(S", *(f"w{i}" for i in range(n)), "(T", "x", "T)", "S)", "</s>"] for n in (1, 40, 300)]
    acts = T.spread(T.from_arrays(spark.createDataFrame(list(enumerate(seqs)), "sent_id bigint, actions array<string>")), rows=400)
    inp = T.materialize(T.expand(acts), dealt=True)
    plan = T._next_closers(inp)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    for chunk in (T.DEFAULT_CHUNK, 16):
        assert {tuple(r) for r in T.mask_edges(T.expand(acts, chunk=chunk)).collect()} == {
            (i, q, k) for i, seq in enumerate(seqs) for q, row in enumerate(simulate(seq)[3]) for k in row}


def test_released_cuts_leave_no_files(spark):
    import os

    from arborlex.session import cut_lineage, release
    a = cut_lineage(spark.range(100))
    file = a._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get().removeprefix("file:")
    b = cut_lineage(a.where("id > 4"))
    release(a)
    assert not os.path.exists(file) and b.count() == 95


def test_masks_by_blocks_are_the_lines(spark, monkeypatch):
    """Padded lines and digests made in blocks equal those of the row functions, also where a mask takes several blocks."""
    import hashlib
    rng = random.Random(6)
    seqs = [["<s>"] + [t for _ in range(1 + i % 3) for t in random_tree(rng)] + ["</s>"] for i in range(7)] + [["<s>", "</s>"]]
    inp = T.materialize(T.expand(T.from_arrays(spark.createDataFrame(list(enumerate(seqs)), "sent_id bigint, actions array<string>"))))
    longest = inp.agg(F.max("n_in")).first()[0] + 3
    padded = T.mask_edges(inp, packed=True, span=None).select("sent_id", "n_in", "keys", F.lit(longest).alias("max_len")).cache()
    want = {r.sent_id: r.lines for r in padded.select("sent_id", B.padded_mask_lines(
        T.packed_rows(F.lit(0), F.col("n_in"), F.col("n_in"), F.col("keys")), F.col("max_len")).alias("lines")).collect()}
    batches = padded.groupBy(F.lit(5).alias("batch_id")).agg(F.max("max_len").alias("max_len"), F.sort_array(F.collect_list(
        F.struct("sent_id", "n_in", "keys"))).alias("r")).select("batch_id", "max_len", F.transform("r", lambda x: F.struct(x["n_in"], x["keys"])).alias("masks"))
    text = ";".join("|".join(want[i]) for i in sorted(want))
    for block in (B.BLOCK, 1000):
        monkeypatch.setattr(B, "BLOCK", block)
        rows = pa.Table.from_batches(B._mask_batches(padded.select("sent_id", "max_len", "n_in", "keys.ki", "keys.death", "keys.closer").toArrow().to_batches()))
        assert {(s, q): x for s, q, x in zip(*(rows[c].to_pylist() for c in rows.column_names), strict=True)} == {
            (s, q): x for s, lines in want.items() for q, x in enumerate(lines)}
    assert {(r.sent_id, r.qi, r.row_text) for r in B.padded_mask_rows(padded).collect()} == {
        (s, q, x) for s, lines in want.items() for q, x in enumerate(lines)}
    assert [(r.batch_id, r.attention_mask_md5) for r in B.padded_masks_md5(batches).collect()] == [(5, hashlib.md5(text.encode()).hexdigest())]
