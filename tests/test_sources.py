"""Line splitting (S1) and named parquet splits."""

import tempfile

from arborlex.sources.tables import read_split, spread_small_scan
from arborlex.sources.text import split_lines


def test_split_lines_keeps_order_and_empty_lines(spark):
    df = spark.createDataFrame([(1, "a b\n\nc"), (2, "one")], "doc_id bigint, text string")
    got = [(r.doc_id, r.line_no, r.text) for r in split_lines(df, "doc_id").orderBy("doc_id", "line_no").collect()]
    assert got == [(1, 0, "a b"), (1, 1, ""), (1, 2, "c"), (2, 0, "one")]


def test_read_split_and_spread(spark):
    d = tempfile.mkdtemp(prefix="arborlex-split-") + "/data"
    rows = [(i, "train" if i % 4 else "test", f"t{i}") for i in range(40)]
    spark.createDataFrame(rows, "id int, split string, text string").write.partitionBy("split").parquet(d)
    test = read_split(spark, d, "test")
    assert sorted(r.id for r in test.collect()) == [i for i in range(40) if i % 4 == 0]
    assert read_split(spark, d).count() == 40
    one = spark.createDataFrame(rows, "id int, split string, text string").coalesce(1)
    assert spread_small_scan(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
