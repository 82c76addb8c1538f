"""Distributed numbering helpers: exact ranks with a hot group spread over partitions."""

from pyspark.sql import functions as F

from arborlex.functions.ranking import dense_index, grouped_index, running_total


def test_grouped_index_hot_group(spark):
    rows = [(0 if i % 3 else i % 7, (i * 7919) % 10007, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g int, v int, u int").repartition(8)
    got = grouped_index(df, ["g"], [F.col("v"), F.col("u")], name="r").collect()
    expect = {}
    for g in sorted({r[0] for r in rows}):
        grp = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(grp):
            expect[r[2]] = i
    assert {r.u: r.r for r in got} == expect


def test_dense_index_and_running_total(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(3000)], "k int, w double").repartition(8)
    ix = {r.k: r.id for r in dense_index(df, [F.col("w").desc(), F.col("k")]).collect()}
    order = sorted(range(3000), key=lambda k: (-(k % 5), k))
    assert ix == {k: i for i, k in enumerate(order)}
    cum = {r.k: r.cum for r in running_total(df, [F.col("k")], "w").collect()}
    acc, ref = 0.0, {}
    for k in range(3000):
        acc += k % 5
        ref[k] = acc
    assert cum == ref


def test_tasks_follow_rows_whatever_the_blocks_size(spark, monkeypatch):
    from arborlex.functions import ranking
    from arborlex.operators.batching import assign_batches
    from arborlex.plans.inputs import order_tree
    monkeypatch.setattr(ranking, "ROWS_PER_TASK", 40)
    rows = spark.range(600).select((F.col("id") * 7 % 600).alias("sent_id"), (F.col("id") % 5 + 1).alias("n"))
    got = assign_batches(rows, [F.col("sent_id")])
    assert got.rdd.getNumPartitions() >= 600 * 3 // 40
    assert {(r.sent_id, r.batch_id) for r in got.collect()} == {(i, i // 16) for i in range(600)}
    orders = spark.range(300).select(F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"))
    lines = spark.range(900).select((F.col("id") % 300).alias("l_orderkey"), (F.col("id") / 300).cast("int").alias("l_linenumber"),
                                    F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"))
    tree = order_tree(orders, lines)
    assert max(len(p) for p in tree.rdd.glom().collect()) <= 300 and tree.count() == 900 + 600 + 9 * 4
    per = {r.sent_id: (r.n, r.m) for r in tree.groupBy("sent_id").agg(F.count("pos").alias("n"), F.max("pos").alias("m")).collect()}
    assert all(n == m + 1 for n, m in per.values()) and len(per) == 9
