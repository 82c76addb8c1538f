"""Bracketed action sequences -> validated trees -> training examples.

Long form throughout: ``actions(sent_id, pos, tok)`` with ``pos`` dense from 0.
Every step is a window, aggregate or generator over rows hash-partitioned by
``(sent_id, chunk)`` with ``chunk = pos div DEFAULT_CHUNK``; windows over
``(sent_id, level, chunk)`` reuse that partitioning, and small per-chunk carry
tables join back on the same keys, so the token table is shuffled once and a
long sentence is spread over tasks.  The mask is kept compact as one ``death``
value per key (a live interval); rows, edges and dense cells are made from the intervals in place, so
neither edges nor cells are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import py_list, py_str, salted_md5
from ..functions.ranking import ROWS_PER_TASK, tasks_for

# Fixed values (reserved tokens and the ignored-label marker).
BOS, EOS, PAD, UNK = "<s>", "</s>", "<pad>", "<unk>"
# Positions per scan chunk: sentences up to this length are one chunk (carries are empty).
DEFAULT_CHUNK = 1 << 16
# Mask rows that are made together from the keys that live there.
EDGE_SPAN = 256


# Codes in order of test (first error wins); `reserved` is our own last check.
CODES = (
    "short", "frame", "empty_token", "both", "empty_name", "empty_production",
    "mismatch", "outside", "blank_terminal", "unclosed", "reserved",
)


def from_arrays(df: DataFrame, id_col: str = "sent_id", arr_col: str = "actions") -> DataFrame:
    """Array form ``(id, actions ARRAY<STRING>)`` -> long form ``(sent_id, pos, tok)``."""
    return df.select(
        F.col(id_col).cast("bigint").alias("sent_id"),
        F.posexplode(arr_col).alias("pos", "tok"),
    ).select("sent_id", F.col("pos").cast("int").alias("pos"), "tok")


def frame(tokens: Column) -> Column:
    """V5: wrap an array of tokens as ``<s> ... </s>``."""
    return F.concat(F.array(F.lit(BOS)), tokens, F.array(F.lit(EOS)))


def annotate(actions: DataFrame, chunk: int = DEFAULT_CHUNK, long: DataFrame | None = None) -> DataFrame:
    """T1 + T4 + T5: token kind, running depth, position id and the open name a closer must match.

    Two-level scans: windows run inside ``(sent_id, chunk)`` with ``chunk = pos div chunk``;
    per-chunk summaries carry depth, closer counts, the next chunk's first token and the
    latest opener of every level across chunk borders.  All carries are joined on
    ``(sent_id, chunk)``, the partitioning the windows already use, so a sentence of any
    length is split over tasks and the token table is shuffled once.  What only passes chunk borders is
    gathered from the sentences that have some (``long``, if the caller has made them).  Every input takes this plan.
    """
    long = _of_long(actions, chunk) if long is None else long
    tok = F.col("tok")
    opens = tok.startswith("(") & ~tok.endswith(")")
    closes = tok.endswith(")") & ~tok.startswith("(")
    a, long = (x.select(
        "sent_id", "pos", "tok", (F.col("pos") / F.lit(chunk)).cast("int").alias("chunk"),
        F.when(opens, 1).when(closes, -1).otherwise(0).alias("delta"), F.when(closes, 1).otherwise(0).alias("is_c"),
    ) for x in (actions, long))
    # carry table: one row per chunk
    cs = a.groupBy("sent_id", "chunk").agg(
        F.sum("delta").alias("d_tot"), F.sum("is_c").alias("c_tot"), F.count(F.lit(1)).alias("n_ch"))
    firsts = long.groupBy("sent_id", "chunk").agg(F.min_by("tok", "pos").alias("first_tok"))
    wc = Window.partitionBy("sent_id").orderBy("chunk")
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    every = wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = cs.select(
        "sent_id", "chunk",
        F.coalesce(F.sum("d_tot").over(before), F.lit(0)).alias("d_off"),
        F.coalesce(F.sum("c_tot").over(before), F.lit(0)).alias("c_off"),
        F.sum("c_tot").over(every).alias("c_total"),
        F.sum("n_ch").over(every).alias("n"),
    )
    nexts = firsts.select("sent_id", "chunk", F.lead("first_tok").over(wc).alias("next_first"))
    carry = carry.join(nexts, ["sent_id", "chunk"], "left")
    last_o = _levels(_scanned(long, carry)).groupBy("sent_id", "pid", "chunk").agg(
        F.max("opener").alias("last_o"), F.bool_or("wants").alias("wants"))
    w_prev = Window.partitionBy("sent_id", "pid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    stack = _stacked(last_o.select("sent_id", "pid", "chunk", "wants", F.last("last_o", ignorenulls=True).over(w_prev).alias("v")), "pid")
    a = _levels(_scanned(a, carry)).join(stack, ["sent_id", "chunk"], "left")
    op = F.coalesce(F.col("loc_open"), F.when(F.col("wants"), _at_level(F.col("pid"))))
    return a.withColumn("open_name", op["nm"]).withColumn("open_pos", op["p"]).drop("loc_open", "opener", "wants", "top", "stack")


def _of_long(rows: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """The rows of sentences with more than one chunk, made once.  Each such sentence holds a position ``chunk`` or above and there is
    one id at most for as many tokens, so the broadcast is bounded."""
    ids = rows.where(F.col("chunk") > 0 if "chunk" in rows.columns else F.col("pos") >= chunk).select("sent_id").distinct()
    return _renewed(materialize(_renewed(rows).join(F.broadcast(ids), "sent_id", "left_semi"), dealt=True))


def _renewed(rows: DataFrame) -> DataFrame:
    """The same columns as attributes of their own: a checkpoint keeps those of its plan, and a join with what they came from
    can't tell the two apart."""
    return rows.select(*(F.col(c).alias(c, metadata={}) for c in rows.columns))


def _scanned(a: DataFrame, carry: DataFrame) -> DataFrame:
    """Depths, closers before and next tokens: scans inside the chunk shifted by what the chunks before carry."""
    w_loc = Window.partitionBy("sent_id", "chunk").orderBy("pos")
    run = w_loc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = a.select(
        "*",
        F.sum("delta").over(run).alias("loc_d"),
        F.sum("is_c").over(run).alias("loc_c"),
        F.lead("tok").over(w_loc).alias("loc_next"),
        F.lead("pos").over(w_loc).isNull().alias("chunk_end"),
    )
    return a.join(carry, ["sent_id", "chunk"]).select(
        "sent_id", "pos", "tok", "chunk", "delta", "is_c",
        (F.col("d_off") + F.col("loc_d")).alias("d_after"),
        (F.col("c_off") + F.col("loc_c") - F.col("is_c")).alias("c_before"),
        "c_total", "n",
        F.when(F.col("chunk_end"), F.col("next_first")).otherwise(F.col("loc_next")).alias("next_tok"),
    )


def _levels(a: DataFrame) -> DataFrame:
    """Kinds, names, position ids and the latest opener of the token's level in its chunk."""
    tok = F.col("tok")
    pos, n = F.col("pos"), F.col("n")
    kind = (
        F.when(tok.isNull() | (tok == ""), "X")
        .when(tok == BOS, F.when(pos == 0, "B").otherwise("R"))
        .when(tok == EOS, F.when(pos == n - 1, "E").otherwise("R"))
        .when(tok.startswith("(") & tok.endswith(")"), "BOTH")
        .when(tok.startswith("("), "O")
        .when(tok.endswith(")"), "C")
        .otherwise("T")
    )
    a = a.withColumn("kind", kind).withColumn("d_before", F.col("d_after") - F.col("delta"))
    k = F.col("kind")
    a = a.withColumn(
        "name",
        F.when(k == "O", F.expr("substring(tok, 2)"))
        .when(k == "C", F.expr("substring(tok, 1, length(tok) - 1)")),
    ).withColumn(
        "pid",
        F.when(k.isin("B", "E"), 0).when(k == "O", F.col("d_before")).otherwise(F.col("d_after")),
    )
    # The stack top for a closer is the latest opener on the closer's level: first inside the chunk, else
    # carried from earlier chunks.  A closer without an opener in its chunk takes the depth below all that the chunk
    # has seen, so such closers stand on consecutive levels downwards, one each: what they need is a stack, and a
    # closer finds its opener in it by its place.
    opener = F.when(k == "O", F.struct(F.col("pos").alias("p"), F.col("name").alias("nm")))
    # sorted by chunk first: what follows per chunk needs no other sort
    w_lvl = Window.partitionBy("sent_id", "chunk", "pid").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    a = a.withColumn("opener", opener).withColumn("loc_open", F.last("opener", ignorenulls=True).over(w_lvl))
    return a.withColumn("wants", (k == "C") & F.col("loc_open").isNull())


def _stacked(carried: DataFrame, level: str) -> DataFrame:
    """``(sent_id, chunk, top, stack)``: the carried values ``v`` of the levels that want one, from the highest level
    ``top`` down.  These levels are consecutive, so a stack is as long as its chunk at most, however deep the tree is."""
    return carried.where("wants").groupBy("sent_id", "chunk").agg(
        F.max(level).alias("top"), F.sort_array(F.collect_list(F.struct((-F.col(level)).alias("down"), "v"))).alias("stack"))


def _at_level(level: Column) -> Column:
    return F.get("stack", F.col("top") - level)["v"]


def _error(a: DataFrame) -> Column:
    """Per-row error candidate ``struct(prio, pos, code)``; null when the row is fine."""
    tok, k, pos, n = F.col("tok"), F.col("kind"), F.col("pos"), F.col("n")
    name, d_before = F.col("name"), F.col("d_before")
    nxt = F.col("next_tok")
    inner = (pos > 0) & (pos < n - 1)
    loop_code = (
        F.when(k == "X", "empty_token")
        .when(k == "BOTH", "both")
        .when(k.isin("O", "C") & (name == ""), "empty_name")
        .when((k == "O") & (nxt == F.concat(name, F.lit(")"))) & ~nxt.startswith("("), "empty_production")
        .when((k == "C") & (F.col("open_name").isNull() | (F.col("open_name") != name) | (d_before <= 0)),
              "mismatch")
        .when(k.isin("T", "R") & (d_before == 0), "outside")
        .when((k == "T") & tok.rlike(r"(?U)^\s*$"), "blank_terminal")
    )

    def cand(prio: int, code) -> Column:
        c = F.lit(code) if isinstance(code, str) else code
        return F.struct(F.lit(prio).alias("prio"), pos.alias("pos"), c.alias("code"))

    bad_first = (pos == 0) & ~F.coalesce(tok == BOS, F.lit(False))
    bad_last = (pos == n - 1) & ~F.coalesce(tok == EOS, F.lit(False))
    return (
        F.when(n < 2, cand(0, "short"))
        .when(bad_first | bad_last, cand(1, "frame"))
        .when(inner & loop_code.isNotNull(), cand(2, loop_code))
        .when((pos == n - 1) & (F.col("d_after") != 0), cand(3, "unclosed"))
        .when(k == "R", cand(4, "reserved"))
    )


def with_errors(actions: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Annotated rows plus ``err`` (row candidate) and ``n_err`` (errors in the sentence).

    Errors are counted inside ``(sent_id, chunk)``; sentences with more chunks take the sum of theirs, one
    row a sentence, so no window spans a whole sentence.
    """
    of_long = _of_long(actions, chunk)
    a = annotate(actions, chunk, of_long)
    a = a.withColumn("err", _error(a))
    long = annotate(of_long, chunk, of_long)
    tot = long.withColumn("err", _error(long)).groupBy("sent_id").agg(F.count("err").alias("_e"))
    a = a.withColumn("n_err", F.count("err").over(Window.partitionBy("sent_id", "chunk")))
    return a.where("sent_id is not null").join(F.broadcast(tot), "sent_id", "left").withColumn(
        "n_err", F.coalesce("_e", "n_err")).drop("_e")


def validate(actions: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """T2/T3 reject table: one row ``(sent_id, pos, code)`` per invalid sentence, first error wins."""
    a = annotate(actions, chunk)
    a = a.withColumn("err", _error(a))
    return (
        a.where(F.col("err").isNotNull())
        .groupBy("sent_id")
        .agg(F.min("err").alias("e"))
        .select("sent_id", F.col("e.pos").alias("pos"), F.col("e.code").alias("code"))
    )


def accepted(actions: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """T3 accept side: annotated rows of sentences without any error."""
    return with_errors(actions, chunk).where(F.col("n_err") == 0).drop("err", "n_err")


def matches(actions: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """T5: each closer of a valid sentence with the position of its opener."""
    a = accepted(actions, chunk)
    return a.where(F.col("kind") == "C").select(
        "sent_id", F.col("pos").alias("close_pos"), F.col("open_pos").cast("int").alias("open_pos"), "name")


def expand(actions: DataFrame, annotated: bool = False, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Duplicate closers, emit ``inputs``/``labels``/``position_ids`` in long form.

    Output ``(sent_id, idx, kind, tok, label, pid, n_in, chunk)``; kind ``D`` marks the copy,
    ``chunk`` is the scan chunk of the source position (chunks are contiguous in ``idx``).
    ``idx = pos + closers before + copy`` needs no second sort.
    """
    a = actions if annotated else accepted(actions, chunk)
    copies = F.when(F.col("kind") == "C", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = a.select(
        "sent_id", "pos", "tok", "kind", "pid", "c_before", "chunk",
        (F.col("n") + F.col("c_total")).alias("n_in"),
        F.explode(copies).alias("copy"),
    )
    dup = F.col("copy") == 1
    return e.select(
        "sent_id",
        (F.col("pos") + F.col("c_before") + F.col("copy")).cast("int").alias("idx"),
        F.when(dup, "D").otherwise(F.col("kind")).alias("kind"),
        "tok",
        F.when(dup, PAD).otherwise(F.col("tok")).alias("label"),
        F.col("pid").cast("int").alias("pid"),
        F.col("n_in").cast("int").alias("n_in"),
        "chunk",
    )


def mask_intervals(inputs: DataFrame) -> DataFrame:
    """T9 compact form: every key ``ki`` with the index ``death`` at which it leaves the stack.

    <s> lives to the end; an opener dies at its own closer; a terminal or closer dies
    at the closer of its parent (next closer one level up).  ``death = n_in`` means never.
    The "next closer on a level" scan runs inside ``(sent_id, level, chunk)``; keys without one there
    stand on the consecutive levels that are open at the chunk's end (each has an opener, or is the lowest), so the first
    closers of later chunks are carried back as a stack for each chunk.  The carry is made of the sentences that have later chunks.
    """
    r, long = _next_closers(inputs), _next_closers(_of_long(inputs.select("sent_id", "idx", "kind", "pid", "n_in", "chunk")))
    first_c = long.groupBy("sent_id", "level", "chunk").agg(F.min("closer_idx").alias("first_c"), F.bool_or("wants").alias("wants"))
    w_next = Window.partitionBy("sent_id", "level").orderBy("chunk").rowsBetween(1, Window.unboundedFollowing)
    stack = _stacked(first_c.select("sent_id", "level", "chunk", "wants", F.min("first_c").over(w_next).alias("v")), "level")
    r = r.where(F.col("probe")).join(stack, ["sent_id", "chunk"], "left")
    death = F.coalesce(F.col("loc_nxt"), F.when(F.col("wants"), _at_level(F.col("level"))), F.col("n_in"))
    return r.select("sent_id", F.col("idx").alias("ki"), "kind", death.cast("int").alias("death"), "n_in")


def _next_closers(inputs: DataFrame) -> DataFrame:
    """Keys (``probe``) and closers by the level they wait for or close, each with the next closer of its level and chunk."""
    k, pid = F.col("kind"), F.col("pid")
    probe = lambda lvl: F.struct(lvl.alias("level"), F.lit(True).alias("probe"))
    closer = F.struct(pid.alias("level"), F.lit(False).alias("probe"))
    parts = (
        F.when(k == "B", F.array(probe(F.lit(-1))))
        .when(k == "O", F.array(probe(pid)))
        .when(k == "T", F.array(probe(pid - 1)))
        .when(k == "C", F.array(probe(pid - 1), closer))
    )
    r = inputs.where(k.isin("B", "O", "T", "C")).select(
        "sent_id", "idx", "kind", "n_in", "chunk", F.explode(parts).alias("p")
    ).select("sent_id", "idx", "kind", "n_in", "chunk", F.col("p.level").alias("level"),
             F.col("p.probe").alias("probe"))
    r = r.withColumn("closer_idx", F.when(~F.col("probe"), F.col("idx")))
    # from the last place back, so that a row's frame is what was read so far
    w = Window.partitionBy("sent_id", "chunk", "level").orderBy(F.col("idx").desc()).rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("loc_nxt", F.last("closer_idx", ignorenulls=True).over(w))
    return r.withColumn("wants", F.col("probe") & F.col("loc_nxt").isNull())


def packed_masks(intervals: DataFrame, span: int | None = None) -> DataFrame:
    """The mask's rows as the keys they may see: ``(sent_id, first, end, n_in, keys array<struct<ki, death, closer>>)``.

    One row per sentence, or one per ``span`` rows of it with the keys that live there, so a long sentence is spread
    over its spans.  The rows themselves follow in place by :func:`packed_rows`; no edge is shuffled.
    """
    end = F.least(F.col("death"), F.col("n_in") - 1)
    at = lambda c: F.floor(c / F.lit(span)).cast("int")
    keys = intervals.select(
        "sent_id", "n_in", F.struct("ki", "death", (F.col("kind") == "C").alias("closer")).alias("key"),
        (F.lit(0) if span is None else F.explode(F.sequence(at(F.col("ki")), at(end)))).alias("span"))
    by = ["sent_id"] if span is None else ["sent_id", "span"]
    packed = keys.groupBy(*by).agg(F.max("n_in").alias("n_in"), F.sort_array(F.collect_list("key")).alias("keys"))
    first = F.lit(0) if span is None else F.col("span") * span
    last = F.col("n_in") if span is None else F.least(F.col("n_in"), first + span)
    return packed.select("sent_id", *by[1:], first.cast("int").alias("first"), last.cast("int").alias("end"), "n_in", "keys")


def packed_rows(first: Column, end: Column, n: Column, keys: Column) -> Column:
    """Rows ``first`` to ``end - 1`` of a packed mask: ``array<struct<qi, ks>>`` with sorted columns ``ks``.

    self:    every row but </s>
    COMPOSE: a closer sees the keys that die at it
    STACK:   any other row sees the keys live at it (k < q < death)
    """
    closers = F.transform(F.filter(keys, lambda x: x["closer"]), lambda x: x["ki"])

    def row(q):
        dies = F.filter(keys, lambda x: x["death"] == q)
        lives = F.filter(keys, lambda x: (x["ki"] < q) & (x["death"] > q))
        seen = F.transform(F.when(F.array_contains(closers, q), dies).otherwise(lives), lambda x: x["ki"])
        return F.struct(q.alias("qi"), F.when(q == n - 1, F.array().cast("array<int>")).otherwise(
            F.concat(seen, F.array(q))).alias("ks"))

    return F.transform(F.sequence(first, end - 1), row)


def mask_edges(inputs: DataFrame, intervals: DataFrame | None = None, packed: bool = False, span: int | None = EDGE_SPAN) -> DataFrame:
    """T9 edges ``(sent_id, qi, ki)``: row ``qi`` may attend to column ``ki`` (rules at :func:`packed_rows`).

    With ``packed``, the edges stay as the keys of ``span`` rows each (None: of a whole sentence), the form of
    :func:`packed_masks` that the dense forms read as well.
    """
    p = packed_masks(intervals if intervals is not None else mask_intervals(inputs), span)
    if packed:
        return p
    rows = p.select("sent_id", F.explode(packed_rows(F.col("first"), F.col("end"), F.col("n_in"), F.col("keys"))).alias("r"))
    return rows.select("sent_id", F.col("r.qi").alias("qi"), F.explode("r.ks").alias("ki"))


def materialize(df: DataFrame, dealt: bool = False) -> DataFrame:
    """Cut lineage once for a table read by several branches (reliable checkpoint); with ``dealt``, readers know by what its rows
    are partitioned."""
    from ..session import cut_lineage
    return cut_lineage(df, dealt)


def spread(tokens: DataFrame, rows: int | None = None, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """A token table dealt by ``(sent_id, chunk)`` to as many tasks as its rows need, sorted, and materialised so: what scans
    it by these keys shuffles nothing.  ``rows`` is their number, if known; else the table is counted, so it should be materialised.

    Sorted tokens take some fifty times the bytes of their shuffle blocks, see :func:`tasks_for`.
    """
    tasks = tasks_for(tokens, tokens.count() if rows is None else rows, ROWS_PER_TASK)
    at = F.col("chunk") if "chunk" in tokens.columns else (F.col("pos") / F.lit(chunk)).cast("int")
    return materialize(tokens.repartition(tasks, "sent_id", at).sortWithinPartitions(
        "sent_id", at, "idx" if "idx" in tokens.columns else "pos"), dealt=True)


def mask_degree(inputs: DataFrame, intervals: DataFrame | None = None, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Row sums of the mask ``(sent_id, qi, degree)`` without materialising edges.

    Deaths are counted per index first (partial sums, so a closer at which very many keys die is no
    hot key; keys that never die are left out).  The keys born before ``q`` less those dead by ``q`` are
    live at ``q``; deaths at ``q`` count a closer's COMPOSE keys.  The running sums are a two-level
    scan over ``(sent_id, at div chunk)``, which holds at most two rows for each index.
    """
    iv = intervals if intervals is not None else mask_intervals(inputs)
    dead = iv.where(F.col("death") < F.col("n_in")).groupBy("sent_id", F.col("death").alias("at")).agg(
        F.count(F.lit(1)).alias("dies")).select(
        "sent_id", "at", F.lit(None).cast("string").alias("kind"), F.lit(0).alias("born"), "dies")
    rows = inputs.select("sent_id", F.col("idx").alias("at"), "kind",
                         F.col("kind").isin("B", "O", "T", "C").cast("int").alias("born"), F.lit(0).cast("bigint").alias("dies"))
    s = rows.unionByName(dead).withColumn("dc", F.floor(F.col("at") / F.lit(chunk)).cast("int"))
    w = Window.partitionBy("sent_id", "dc").orderBy("at", F.col("kind").isNotNull())
    s = s.select(
        "sent_id", "dc", "at", "kind", "born", "dies",
        F.coalesce(F.sum("born").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("loc_born"),
        F.sum("dies").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("loc_dead"),
        F.when(F.lag("at").over(w) == F.col("at"), F.lag("dies").over(w)).otherwise(0).alias("composed"))
    tot = s.groupBy("sent_id", "dc").agg((F.sum("born") - F.sum("dies")).alias("d_tot"))
    off = tot.select("sent_id", "dc", F.coalesce(F.sum("d_tot").over(
        Window.partitionBy("sent_id").orderBy("dc").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    s = s.where(F.col("kind").isNotNull()).join(off, ["sent_id", "dc"])
    k = F.col("kind")
    live = F.col("off") + F.col("loc_born") - F.col("loc_dead")
    deg = F.when(k == "E", 0).when(k == "C", F.col("composed") + 1).otherwise(live + 1)
    return s.select("sent_id", F.col("at").alias("qi"), deg.cast("int").alias("degree"))


def _row_parts(ks: Column, n: Column, one: Column, zero: Column, gap) -> Column:
    """Pieces of a dense row from sorted distinct column indexes ``ks``: O(n) per row."""
    def seg(k, i):
        prev = F.when(i == 0, F.lit(-1)).otherwise(F.element_at(ks, i))
        return gap(zero, k - prev - 1, one)
    last = F.coalesce(F.try_element_at(ks, F.lit(-1)), F.lit(-1))
    return F.transform(ks, seg), n - 1 - last


def dense_row_text(ks: Column, n: Column, sep: str = ", ") -> Column:
    """``[1.0, 0.0, ...]`` text of one mask row (Python float list)."""
    return F.concat(F.lit("["), dense_row_line(ks, n, sep), F.lit("]"))


def dense_row_line(ks: Column, n: Column, sep: str = " ") -> Column:
    """The cells of one mask row, joined by ``sep``."""
    def gap(zero, cnt, one):
        return F.concat(F.repeat(zero, cnt), one)
    segs, tail = _row_parts(ks, n, F.lit("1.0"), F.lit(f"0.0{sep}"), gap)
    body = F.concat(F.array_join(segs, sep), F.repeat(F.lit(f"{sep}0.0"), tail))
    all_zero = F.when(n > 0, F.concat(F.repeat(F.lit(f"0.0{sep}"), n - 1), F.lit("0.0"))).otherwise("")
    return F.when(F.size(ks) == 0, all_zero).otherwise(body)


def dense_row(ks: Column, n: Column) -> Column:
    """One mask row as ``ARRAY<FLOAT>``."""
    def gap(zero, cnt, one):
        return F.concat(F.array_repeat(zero, cnt), F.array(one))
    segs, tail = _row_parts(ks, n, F.lit(1.0).cast("float"), F.lit(0.0).cast("float"), gap)
    return F.concat(F.flatten(segs), F.array_repeat(F.lit(0.0).cast("float"), tail))


def _mask_rows(inputs: DataFrame, edges: DataFrame) -> DataFrame:
    """``(sent_id, qi, n_in, ks)`` of edges, packed or not."""
    if "keys" in edges.columns:
        rows = packed_rows(F.col("first"), F.col("end"), F.col("n_in"), F.col("keys"))
        return edges.select("sent_id", "n_in", F.explode(rows).alias("r")).select("sent_id", "r.qi", "n_in", "r.ks")
    rows = edges.groupBy("sent_id", "qi").agg(F.array_sort(F.collect_set("ki")).alias("ks"))
    cells = inputs.select("sent_id", F.col("idx").alias("qi"), "n_in").join(rows, ["sent_id", "qi"], "left")
    return cells.withColumn("ks", F.coalesce(F.col("ks"), F.array().cast("array<int>")))


def _sentence_rows(inputs: DataFrame, edges: DataFrame) -> DataFrame:
    """``(sent_id, n_in, rows array<struct<qi, ks>>)``: the sorted columns of every row, dense cells only where they are used.
    Edges packed by sentence have no further shuffle."""
    if "keys" in edges.columns:
        return edges.select("sent_id", "n_in", packed_rows(F.col("first"), F.col("end"), F.col("n_in"), F.col("keys")).alias("rows"))
    return _mask_rows(inputs, edges).groupBy("sent_id").agg(
        F.max("n_in").alias("n_in"), F.array_sort(F.collect_list(F.struct("qi", "ks"))).alias("rows"))


def dense_mask(inputs: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per sentence with the n x n float mask (export only; n^2 per sentence)."""
    return _sentence_rows(inputs, edges).select(
        "sent_id", F.transform("rows", lambda x: dense_row(x["ks"], F.col("n_in"))).alias("mask"))


def dense_mask_text(inputs: DataFrame, edges: DataFrame) -> DataFrame:
    """Each dense row as Python-style float-list text ``(sent_id, qi, row_text)``."""
    return _mask_rows(inputs, edges).select(
        "sent_id", "qi", dense_row_text(F.col("ks"), F.col("n_in")).alias("row_text"))


def examples(inputs: DataFrame, edges: DataFrame) -> DataFrame:
    """``(sent_id, inputs, labels, position_ids, attention_mask[1][n][n])``."""
    seqs = inputs.groupBy("sent_id").agg(F.array_sort(F.collect_list(F.struct("idx", "tok", "label", "pid"))).alias("s"))
    seqs = seqs.select(
        "sent_id",
        F.transform("s", lambda x: x["tok"]).alias("inputs"),
        F.transform("s", lambda x: x["label"]).alias("labels"),
        F.transform("s", lambda x: x["pid"]).alias("position_ids"),
    )
    m = dense_mask(inputs, edges)
    return seqs.join(m, "sent_id").select(
        "sent_id", "inputs", "labels", "position_ids", F.array("mask").alias("attention_mask")
    )


def row_texts(inputs: DataFrame, edges: DataFrame) -> DataFrame:
    """Python-style text of the four example columns, one row per sentence.

    ``text`` is ``str(inputs)\\nstr(labels)\\nstr(position_ids)\\nstr(mask)``; the salted
    MD5 of these lines joined in sentence order is the reference's dataset hash.  What is shuffled of a mask are its
    packed keys or the columns of its rows: its text is made last, beside the sentence's other texts.
    """
    seqs = inputs.groupBy("sent_id").agg(
        F.sort_array(F.collect_list(F.struct("idx", "tok", "label", "pid"))).alias("s"))
    packed = "keys" in edges.columns
    masks = edges.drop("first") if packed else _sentence_rows(inputs, edges)
    out = seqs.join(masks, "sent_id")
    rows = packed_rows(F.lit(0), F.col("end"), F.col("n_in"), F.col("keys")) if packed else F.col("rows")
    return out.select(
        "sent_id",
        F.concat_ws(
            "\n",
            py_list(F.transform("s", lambda x: py_str(x["tok"]))),
            py_list(F.transform("s", lambda x: py_str(x["label"]))),
            py_list(F.transform("s", lambda x: x["pid"].cast("string"))),
            py_list(F.transform(rows, lambda x: dense_row_text(x["ks"], F.col("n_in")))),
        ).alias("text"),
    )


def sentence_fingerprints(texts: DataFrame) -> DataFrame:
    """T14 at scale: salted MD5 per sentence (order-free, fully parallel)."""
    return texts.select("sent_id", salted_md5(F.col("text")).alias("fingerprint"))


def ordered_digest(fingerprints: DataFrame, bucket: int = 1024) -> DataFrame:
    """Number of examples and MD5 over (sent_id, fingerprint) in id order, folded per bucket of
    ``bucket`` consecutive ids and then over the buckets' digests in order.

    A bucket is bounded by its width; the last fold holds one digest for each bucket.
    """
    def fold(order: str, line: str) -> Column:
        lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.expr(line).alias("line")))), lambda x: x["line"])
        return F.md5(F.concat_ws("\n", lines))

    per = fingerprints.withColumn("_b", F.floor(F.col("sent_id") / bucket)).groupBy("_b").agg(
        fold("sent_id", "concat(sent_id, ':', fingerprint)").alias("_d"), F.count(F.lit(1)).alias("_n"))
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_sentences"),
                   fold("_b", "concat(_b, ':', _d)").alias("digest"))
