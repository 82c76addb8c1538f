"""The streaming driver prepares each new file once and keeps replays idempotent."""

import tempfile

from arborlex.streaming import tree_stream as TS


def test_stream_two_files(spark):
    src = tempfile.mkdtemp(prefix="arborlex-src-")
    out = tempfile.mkdtemp(prefix="arborlex-out-")
    ck = tempfile.mkdtemp(prefix="arborlex-ck-")
    good = ['<s>', '(S', '(NP', 'the', 'bird', 'NP)', 'S)', '</s>']
    bad = ['<s>', '(S', 'x', '</s>']
    spark.createDataFrame([(1, good), (2, bad)], TS.ARRAY_SCHEMA).write.mode("append").parquet(src)
    q = TS.start(spark, src, out, ck)
    q.awaitTermination(120)
    spark.createDataFrame([(3, good)], TS.ARRAY_SCHEMA).write.mode("append").parquet(src)
    q = TS.start(spark, src, out, ck)
    q.awaitTermination(120)
    inputs = spark.read.parquet(f"{out}/inputs")
    rejects = spark.read.parquet(f"{out}/rejects")
    assert sorted(r.sent_id for r in inputs.select("sent_id").distinct().collect()) == [1, 3]
    assert [(r.sent_id, r.code) for r in rejects.collect()] == [(2, "unclosed")]
    assert inputs.where("sent_id = 1").count() == 10
