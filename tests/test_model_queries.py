"""Rows-only queries checked against brute force on the smallest driver tables."""

import hashlib
import os
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
import regex

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")

GPT2_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _alphabet():
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in printable]
    table = {b: chr(b) for b in printable}
    table.update({b: chr(256 + i) for i, b in enumerate(rest)})
    return table


def _bpe_all_occurrences(syms, ranks):
    """Classic formulation: merge every occurrence of the best pair per round."""
    while len(syms) > 1:
        pairs = {(a, b) for a, b in zip(syms, syms[1:]) if (a, b) in ranks}
        if not pairs:
            break
        best = min(pairs, key=ranks.get)
        out, i = [], 0
        while i < len(syms):
            if i + 1 < len(syms) and (syms[i], syms[i + 1]) == best:
                out.append(syms[i] + syms[i + 1])
                i += 2
            else:
                out.append(syms[i])
                i += 1
        syms = out
    return syms


@needs_data
def test_bpe_encode_query_brute_force(spark):
    from arborlex.plans.catalog_more import bpe_encode

    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    alpha = _alphabet()
    counts = Counter()
    for d in docs:
        for pt in regex.findall(GPT2_PRETOKEN, d["text"]):
            raw = pt.encode("utf-8")
            counts.update(zip(raw, raw[1:]))
    best = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    ranks = {(alpha[a], alpha[b]): i for i, ((a, b), _) in enumerate(best)}
    vocab = set(alpha.values()) | {a + b for a, b in ranks}
    multi = re.compile("[0-9²³¹]{2}")
    vocab = {t for t in vocab if not multi.search(t)}
    kept = {p: r for p, r in ranks.items() if not multi.search(p[0] + p[1]) and p[0] in vocab and p[1] in vocab}
    expect = {}
    for d in docs:
        pts = regex.findall(GPT2_PRETOKEN, d["text"])
        pieces = []
        for pt in pts:
            syms = [alpha[b] for b in pt.encode("utf-8") if alpha[b] in vocab]
            pieces += _bpe_all_occurrences(syms, kept)
        expect[d["doc_id"]] = (len(pieces), len(pts), hashlib.md5(" ".join(pieces).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.n_pretokens, r.pieces_md5) for r in bpe_encode(spark, SF).collect()}
    assert got == expect


@needs_data
def test_text_classifier_query(spark):
    from arborlex.plans.catalog_more import text_classifier

    rows = text_classifier(spark, SF).collect()
    n_docs = pq.read_metadata(f"{SF}/documents.parquet").num_rows
    assert len(rows) == n_docs
    assert all(r.label in (0, 1) and 0.5 <= r.score <= 1.0 for r in rows)


@needs_data
def test_chunked_plan_equals_single_chunk_on_driver_tables(spark):
    """Hot-sentence path on real sentences: tiny chunks force carries across many chunk borders."""
    from arborlex.operators import trees as T
    from arborlex.plans import catalog as C

    acts = C.order_actions(spark, SF)
    pages = C.page_actions(spark, SF)

    def run(chunk):
        inp = T.materialize(T.expand(acts, chunk=chunk))
        return (
            set(map(tuple, inp.select("sent_id", "idx", "kind", "tok", "label", "pid").collect())),
            set(map(tuple, T.mask_intervals(inp).select("sent_id", "ki", "death").collect())),
            set(map(tuple, T.mask_degree(inp, chunk=chunk).collect())),
            set(map(tuple, T.validate(pages, chunk).collect())),
        )

    assert run(T.DEFAULT_CHUNK) == run(7)
