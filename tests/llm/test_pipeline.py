"""The pipeline's stages on the smallest tables, each held against its operator or brute force."""

from __future__ import annotations

import hashlib
import os
import re

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def rows_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_near_copies_keep_their_lines(spark):
    """A crowd of near copies over 2 % of its source keeps its text; a line of unlike pages goes."""
    import corpus_pipeline as P

    crowd = [" ".join(f"w{i}x{j}" for j in range(10)) for i in range(8)]
    rows = [(i, "\n".join([*crowd, f"the one line of copy {i}"]), "a") for i in range(10)]
    rows += [(100 + i, "Read more here\n" + " ".join(f"own{i}x{j}" for j in range(30)), "a") for i in range(30)]
    out = {r.doc_id: r.text for r in P.line_deduplication(spark, rows_of(spark, rows), SF).collect()}
    assert all(out[d] == (t if d < 100 else t.split("\n")[1]) for d, t, _ in rows)


def test_one_row_of_each_group_stays(spark):
    """Null and repeated ids: each group keeps exactly one row, rows without words all stay."""
    import corpus_pipeline as P

    text = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(4)]
    near = [t + " changed" for t in text]
    rows = [(None, text[0], "a"), (None, near[0], "a"), (None, "", "a"), (None, None, "b"), (None, text[1], "a"), (7, near[1], "a"),
            (5, text[2], "a"), (5, near[2], "a"), (5, text[2], "b"), (9, near[2], "a"), (6, text[3], "c"), (6, text[3], "c"),
            (None, "a unique text with no id at all", "a")]
    got = [(r.doc_id, r.text, r.source) for r in P.near_deduplication(spark, rows_of(spark, rows), SF).collect()]
    smallest = lambda *ts: min(ts, key=lambda t: hashlib.md5(t.encode()).digest())
    low = smallest(text[2], near[2])
    expected = [(None, smallest(text[0], near[0]), "a"), (None, "", "a"), (None, None, "b"), (7, near[1], "a"), (5, low, "a"),
                (6, text[3], "c"), (None, "a unique text with no id at all", "a")]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_stages(spark):
    import corpus_pipeline as P
    from arborlex.llm import common, near_dedup

    docs = common.table(spark, SF, "documents").cache()
    seen = [docs]
    for name, stage in P.STAGES:
        seen.append(common.written(stage(spark, seen[-1], SF), f"test-{name}"))
    start, judged, lines, near, mixed, pieces = seen
    for x in seen[1:-1]:
        assert x.columns == P.COLUMNS
    quality = {r.doc_id: r.quality for r in common.table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in judged.collect()}
    good = [d for d, q in quality.items() if q == 1]
    assert sum(d in kept for d in good) / len(good) > 0.9
    assert lines.count() == judged.count() and all(r.n_chars == len(r.text) for r in lines.collect())
    one = {r.component_id for r in near_dedup.near_duplicates(lines).collect()}
    assert {r.doc_id for r in near.collect()} == one
    texts = {r.doc_id: r.text for r in near.collect()}
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts.values())
    taken = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed.collect())
    assert abs(taken - 1.5 * words) < 0.1 * words
    for r in pieces.collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert pieces.count() == mixed.count()
