"""BPE training, block-sparse masks with their hash tree, and many keywords, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from arborlex.operators import bpe, bpe_train, keywords, tiles
from arborlex.operators import trees as T


# BPE ------------------------------------------------------------------------------------------
def brute_train(counts, rounds, batch, least, candidates):
    """The rounds over lists of symbols, every pair counted anew each time."""
    alphabet = bpe.byte_alphabet()
    held = [([alphabet[b] for b in pt.encode()], n) for pt, n in counts.items()]
    out = []
    for _ in range(rounds):
        pairs = Counter()
        for s, n in held:
            for p in zip(s, s[1:], strict=False):
                pairs[p] += n
        order = sorted(((-n, a.encode(), b.encode(), a, b) for (a, b), n in pairs.items() if n >= least))[:candidates]
        used, chosen = set(), []
        for k, _, _, a, b in order:
            if len(chosen) < batch and not {a, b} & used:
                chosen.append((a, b))
                used |= {a, b}
                out.append((len(out), a, b, -k))
        for s, _ in held:
            for a, b in chosen:
                i = 0
                while i < len(s) - 1:
                    if s[i] == a and s[i + 1] == b:
                        s[i:i + 2] = [a + b]
                    i += 1
    return out


TEXTS = ["banana bandana banana", "aaaa aaa aa a", None, "", "the theme of the thesis is there", "ünïcödé ünï  \n\tünï", "a\x00b a\x00b",
         "1234 12 34 1234", "the theme of the thesis is there"]


def test_trained_merges_are_those_of_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    counts = {r.pt: r.n for r in bpe_train.pretokens(docs).collect()}
    for rounds, batch, candidates in ((1, 4, 64), (5, 3, 256), (4, 64, 256)):
        want = brute_train(counts, rounds, batch, 2, 256)
        got = sorted(tuple(r) for r in bpe_train.train(docs, rounds, batch, 2).collect())
        assert got == want and len(got) > 2
    assert max(len(a + b) for _, a, b, _ in want) >= 3  # merges of merges


def test_trained_model_encodes_its_own_words(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    merges = bpe_train.train(docs, 6, 8)
    rows = {r.doc_id: r.pieces for r in bpe.bpe_rows(docs, bpe_train.model(merges), merges).collect()}
    alphabet = bpe.byte_alphabet()
    for i, text in enumerate(TEXTS):
        joined = "".join(itertools.chain.from_iterable(rows[i]))
        assert joined == "".join(alphabet[b] for b in (text or "").encode())
    assert max(len(p) for p in itertools.chain.from_iterable(rows[4])) >= 3
    assert rows[2] == [] and rows[3] == []


def test_training_without_pairs(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a")], "doc_id int, text string")
    assert bpe_train.train(docs).count() == 0


# tiles ----------------------------------------------------------------------------------------
def trees(rng, n, size):
    out = []
    for i in range(n):
        acts, open_ = ["<s>", "(S"], ["S"]
        for _ in range(rng.randrange(size)):
            if rng.random() < 0.3:
                open_.append(f"N{rng.randrange(4)}")
                acts += [f"({open_[-1]}", "w"]
            elif rng.random() < 0.4 and len(open_) > 1:
                acts.append(f"{open_.pop()})")
            else:
                acts.append("w")
        acts += ["w", *[f"{x})" for x in reversed(open_)], "</s>"]
        out += [(i, p, t) for p, t in enumerate(acts)]
    return out


@pytest.fixture(scope="module")
def masks(spark):
    acts = spark.createDataFrame(trees(random.Random(3), 12, 90), "sent_id bigint, pos int, tok string")
    inp = T.materialize(T.expand(acts))
    return inp, T.materialize(tiles.mask_tiles(inp, T.materialize(T.mask_intervals(inp))))


def test_tiles_hold_the_edges(masks):
    inp, held = masks
    edges = {tuple(r) for r in T.mask_edges(inp).select("sent_id", "qi", "ki").collect()}
    assert {tuple(r) for r in tiles.tile_edges(held).select("sent_id", "qi", "ki").collect()} == edges
    assert held.agg(F.sum("ones")).first()[0] == len(edges)
    assert held.groupBy("sent_id", "tile_row", "tile_col").count().where("count > 1").isEmpty()


def test_references_and_batches(masks):
    inp, held = masks
    refs = {r.sent_id: r for r in tiles.references(inp, held).collect()}
    n = {r.sent_id: r.n_in for r in inp.select("sent_id", "n_in").distinct().collect()}
    assert all(refs[i].shape == [1, n[i], n[i]] for i in n)
    batches = inp.select("sent_id").distinct().select((F.col("sent_id") % 2).alias("batch_id"), "sent_id", F.lit(500).alias("max_len"))
    rows = tiles.batch_masks(batches, tiles.references(inp, held)).collect()
    assert [(r.shape, [x.sent_id for x in r.masks]) for r in sorted(rows)] == [([6, 1, 500, 500], list(range(b, 12, 2))) for b in (0, 1)]


def test_a_long_flat_example_has_no_large_cell(spark):
    """An example of 20,000 places: no row of any table grows with the square of its length."""
    acts = [(0, 0, "<s>"), (0, 1, "(S")] + [(0, 2 + i, "(A" if i % 2 == 0 else "A)") for i in range(0)]
    acts += [(0, 2 + i, t) for i, t in enumerate(t for _ in range(5000) for t in ("(A", "w", "A)"))]
    acts += [(0, len(acts), "S)"), (0, len(acts) + 1, "</s>")]
    inp = T.materialize(T.expand(spark.createDataFrame(acts, "sent_id bigint, pos int, tok string")))
    iv = T.materialize(T.mask_intervals(inp))
    held = tiles.mask_tiles(inp, iv).withColumn("size", F.length(tiles.tile_text(F.col("columns"))))
    got = held.agg(F.max("size"), F.sum("ones")).first()
    assert got[0] < 32 * 16 and got[1] == T.mask_degree(inp, iv).agg(F.sum("degree")).first()[0]


def test_hash_tree_changes_on_one_path(masks):
    inp, held = masks
    rows = tiles.row_hashes(inp, held)
    tree = tiles.hash_tree(tiles.example_hashes(rows), fan=3)
    nodes = {(r.level, r.i): r.hash for r in tree.collect()}
    assert sum(level == 0 for level, _ in nodes) == 12 and max(level for level, _ in nodes) == 3
    some = held.where("sent_id = 7").orderBy("tile_row", "tile_col").first()
    bent = held.withColumn("columns", F.when((F.col("sent_id") == 7) & (F.col("tile_row") == some.tile_row) & (F.col("tile_col") == some.tile_col),
                                             F.transform("columns", lambda x: F.struct(x["col"], x["rows"].bitwiseXOR(F.lit(1)).alias("rows")))).otherwise(F.col("columns")))
    other = {(r.level, r.i): r.hash for r in tiles.hash_tree(tiles.example_hashes(tiles.row_hashes(inp, bent)), fan=3).collect()}
    assert {k for k in nodes if nodes[k] != other[k]} == {(0, 7), (1, 2), (2, 0), (3, 0)}
    changed = rows.join(tiles.row_hashes(inp, bent).withColumnRenamed("hash", "h2"), ["sent_id", "tile_row"]).where("hash <> h2")
    assert [(r.sent_id, r.tile_row) for r in changed.collect()] == [(7, some.tile_row)]
    # the proof leads from the example to the root
    steps, at = tiles.proof(tree, 7, fan=3), nodes[(0, 7)]
    for siblings in steps:
        assert at in siblings
        at = hashlib.md5("".join(siblings).encode()).hexdigest()
    assert at == nodes[(3, 0)]


def test_hash_tree_of_nothing(spark):
    none = spark.createDataFrame([], "sent_id bigint, hash string")
    assert tiles.hash_tree(none).count() == 0


def test_depth_beyond_a_chunk_takes_linear_time(spark):
    """A tree 70,000 deep: every closer and key finds its partner beyond many chunk borders."""
    deep = 70_000
    ids = spark.range(2 * deep + 2)
    tok = (F.when(F.col("id") == 0, "<s>").when(F.col("id") == 2 * deep + 1, "</s>").when(F.col("id") == deep + 1, "w")
           .when(F.col("id") <= deep, F.concat(F.lit("(N"), (F.col("id") % 7).cast("string")))
           .otherwise(F.concat(F.lit("N"), ((2 * deep + 2 - F.col("id")) % 7).cast("string"), F.lit(")"))))
    # places: <s>, deep openers, one word, deep - 1 closers that match in reverse, then the outermost opener stays open
    acts = ids.select(F.lit(1).cast("bigint").alias("sent_id"), F.col("id").cast("int").alias("pos"), tok.alias("tok"))
    bad = {tuple(r) for r in T.validate(acts, 4096).collect()}
    assert bad == {(1, 2 * deep + 1, "unclosed")}
    closed = acts.where(F.col("pos") <= 2 * deep).unionByName(
        spark.createDataFrame([(1, 2 * deep + 1, "N1)"), (1, 2 * deep + 2, "</s>")], acts.schema))
    inp = T.materialize(T.expand(closed, chunk=4096))
    got = T.mask_intervals(inp).where("kind = 'O'").agg(F.count(F.lit(1)), F.sum("death").cast("bigint")).first()
    # an opener of level l dies at its own closer, which stands at l from the end; every closer before it is doubled
    last = 1 + deep + 1 + 2 * deep
    assert tuple(got) == (deep, sum(last - 2 - 2 * level for level in range(deep)))


# keywords -------------------------------------------------------------------------------------
KEYS = ["he", "she", "his", "hers", "HE", "ab", "abab", "", None, "Ünï", "never there"]
BODY = ["ushers", "SHE said: his", "ababab", None, "", "ünïon", "nothing"]


@pytest.mark.parametrize("most", [6, keywords.MAX_CHARS])
def test_keyword_hits(spark, most):
    texts = spark.createDataFrame(list(enumerate(BODY)), "doc_id bigint, text string")
    words = spark.createDataFrame([(k,) for k in KEYS], "keyword string")
    got = sorted(tuple(r) for r in keywords.keyword_hits(texts, words, "doc_id", max_chars=most).collect())
    low = {k.lower() for k in KEYS if k is not None}
    assert got == sorted((i, k) for i, t in enumerate(BODY) if t is not None for k in low if k in t.lower())
    assert keywords.keyword_hits(texts, words.limit(0), "doc_id").count() == 0


def test_own_keyword_hits(spark):
    rng = random.Random(1)
    rows = [(i, rng.sample(KEYS, 5), rng.choice(BODY)) for i in range(60)] + [(100, None, "x"), (101, [], "x")]
    df = spark.createDataFrame(rows, "id int, keywords array<string>, text string")
    got = {r.id: list(r.h) for r in df.select("id", keywords.own_keyword_hits(F.col("keywords"), F.col("text")).alias("h")).collect()}
    for i, ks, t in rows:
        assert got[i] == [j for j, k in enumerate(ks or []) if t is not None and k is not None and k.lower() in t.lower()]


# draws, functions of the caller, products ------------------------------------------------------
def test_as_of_carry_over_partitions(spark):
    from arborlex.functions.ranking import carried_last
    rng = random.Random(2)
    rows = [(i, rng.randrange(99) if rng.random() < 0.02 or i == 3 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "at int, v int").repartition(16)
    got = {r.at: r.last for r in carried_last(df, ["at"], "v", "last").collect()}
    last = None
    for i, v in rows:
        last = v if v is not None else last
        assert got[i] == last


@pytest.mark.parametrize("n", [1, 7, 5000])
@pytest.mark.parametrize("inclusive", [False, True])
def test_weighted_draw_of_any_number_of_values(spark, n, inclusive):
    """One value, and more bands than a partition holds: each draw gets the band it falls into."""
    from arborlex.operators import sampling
    rng = random.Random(n)
    weights = {f"v{i:05d}": rng.randrange(0, 5) for i in range(n)}
    weights["v00000"] = 3
    dist = spark.createDataFrame(list(weights.items()), "value string, weight int")
    got = sampling.weighted_draw(spark.range(3000).withColumnRenamed("id", "k"), "k", dist, inclusive_upper=inclusive).collect()
    total, at, edges = sum(weights.values()), 0, []
    for v in sorted(weights):
        if weights[v]:
            edges.append((at / total, (at + weights[v]) / total, v))
        at += weights[v]
    assert sorted(r.k for r in got) == list(range(3000))
    import bisect
    his = [hi for _, hi, _ in edges]
    for r in got:
        place = bisect.bisect_left(his, r.u) if inclusive else bisect.bisect_right(his, r.u)
        assert r.value == edges[place][2]


def test_nothing_to_draw(spark):
    from arborlex.operators import sampling
    none = spark.createDataFrame([("a", 0)], "value string, weight int")
    assert sampling.weighted_draw(spark.range(5), "id", none).count() == 0
    assert sampling.weighted_draw(spark.range(5), "id", none.limit(0)).count() == 0


def test_map_batches(spark):
    from arborlex.operators.batch_map import map_batches

    def seen(rows):
        return {"id": rows["id"], "size": [len(rows["id"])] * len(rows["id"])}

    got = map_batches(spark.range(0, 1000, 1, 1), seen, "id bigint, size int", 300).collect()
    assert [r.size for r in got] == [300] * 900 + [100] * 100 and [r.id for r in got] == list(range(1000))
    doubled = map_batches(spark.range(10), lambda rows: {"id": [i for x in rows["id"] for i in (x, x)]}, "id bigint", 4)
    assert doubled.count() == 20
    assert map_batches(spark.range(0), seen, "id bigint, size int").count() == 0


def test_collate(spark):
    from arborlex.operators.batch_map import collate
    df = spark.createDataFrame([(i % 3, i, None if i == 4 else f"t{i}") for i in range(20)], "batch_id int, i int, t string").repartition(5)
    got = collate(df, lambda rows: [{"b": rows[0]["batch_id"], "ts": [r["t"] for r in rows]}], "b int, ts array<string>", order=["i"]).collect()
    assert {r.b: r.ts for r in got} == {b: [None if i == 4 else f"t{i}" for i in range(b, 20, 3)] for b in range(3)}


@pytest.mark.parametrize("block", [2, 1024])
def test_dot_top(spark, block):
    from arborlex.operators import counts
    rng = random.Random(5)
    left = [(g, f"k{k}", float(rng.randrange(1, 9))) for g in range(120) for k in rng.sample(range(30), rng.randrange(1, 9))]
    right = [(g, f"k{k}", float(rng.randrange(1, 9))) for g in "abcde" for k in rng.sample(range(40), 6)] + [("z", "nothing", 1.0)]
    got = counts.dot_top(*(spark.createDataFrame(x, f"grp {t}, key string, value double") for x, t in ((left, "int"), (right, "string"))), 4, block)
    want = []
    for b in "abcde":
        dots = Counter()
        for g, k, v in left:
            dots[g] += sum(v * w for h, j, w in right if h == b and j == k)
        order = sorted(((-d, g) for g, d in dots.items() if d))[:4]
        want += [(b, i, g, -d) for i, (d, g) in enumerate(order, 1)]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_encoding_bounds_its_batches(spark):
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("ab", 2)], "token string, id long")
    merges = spark.createDataFrame([(0, "a", "b")], "rank long, a string, b string")
    rows = bpe.bpe_rows(spark.createDataFrame([(1, "ab ba"), (2, None)], "doc_id long, text string"), vocab, merges).collect()
    assert {r.doc_id: r.pieces for r in rows} == {1: [["ab"], ["b", "a"]], 2: []}
    assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_tiles_shuffle_keys_once(masks):
    """Tiles come from the keys of their row: one exchange of keys, none of cells or closers."""
    inp = masks[0]
    plan = tiles.mask_tiles(inp, T.materialize(T.mask_intervals(inp)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
