"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark plans: straightforward (often brute-force)
SQL over the pre-registered views, for the correctness gate at small scale.
"""

from __future__ import annotations

from .inputs import BREAKS, CLOSE_NAME_RE, DROP_RE, OPEN_NAME_RE, PIECE_RE

SQL: dict[str, str] = {}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --------------------------------------------------------------- derived trees

ORDER_ACTS = """
ot_o AS (SELECT o_orderkey AS okey, o_custkey AS sent_id FROM orders),
ot_t AS (
  SELECT ot_o.sent_id, 2 AS k1, ot_o.okey AS k2, 1 AS k3, l_linenumber::BIGINT AS k4, l_partkey AS k5,
         l_suppkey AS k6, 'p' || l_partkey AS tok
    FROM lineitem JOIN ot_o ON l_orderkey = ot_o.okey
  UNION ALL SELECT sent_id, 2, okey, 0, 0, 0, 0, '(O' FROM ot_o
  UNION ALL SELECT sent_id, 2, okey, 2, 0, 0, 0, 'O)' FROM ot_o
  UNION ALL SELECT sent_id, 0, 0, 0, 0, 0, 0, '<s>' FROM (SELECT DISTINCT sent_id FROM ot_o)
  UNION ALL SELECT sent_id, 1, 0, 0, 0, 0, 0, '(C' FROM (SELECT DISTINCT sent_id FROM ot_o)
  UNION ALL SELECT sent_id, 3, 0, 0, 0, 0, 0, 'C)' FROM (SELECT DISTINCT sent_id FROM ot_o)
  UNION ALL SELECT sent_id, 4, 0, 0, 0, 0, 0, '</s>' FROM (SELECT DISTINCT sent_id FROM ot_o)
),
acts AS (
  SELECT sent_id::BIGINT AS sent_id,
         (row_number() OVER (PARTITION BY sent_id ORDER BY k1, k2, k3, k4, k5, k6) - 1)::INT AS pos, tok
  FROM ot_t
)"""


def _html_acts(fragment_sql: str) -> str:
    return f"""
h_p AS (SELECT page_id, regexp_extract_all({fragment_sql}, {_q(PIECE_RE)}, 0) AS pieces FROM pages),
h_t AS (
  SELECT page_id, ['<s>'] || flatten(list_transform(pieces, lambda p:
      CASE WHEN starts_with(p, '</') THEN [regexp_extract(p, {_q(CLOSE_NAME_RE)}, 1) || ')']
           WHEN starts_with(p, '<') THEN ['(' || regexp_extract(p, {_q(OPEN_NAME_RE)}, 1)]
           ELSE list_filter(string_split_regex(translate(p, '()', '[]'), '\\s+'), lambda w: w <> '') END))
      || ['</s>'] AS a
  FROM h_p
),
acts AS (
  SELECT page_id::BIGINT AS sent_id, (generate_subscripts(a, 1) - 1)::INT AS pos, unnest(a) AS tok FROM h_t
)"""


_BREAK = " ".join(f"WHEN sent_id % 12 = {m} AND " + (f"pos = {at}" if isinstance(at, int) else f"tok = '{at}'") + f" THEN '{new}'"
                  for m, (at, new) in BREAKS.items())
BROKEN_ACTS = ORDER_ACTS.replace("acts AS (", "acts0 AS (") + f""",
acts AS (SELECT sent_id, pos, CASE {_BREAK} ELSE tok END AS tok FROM acts0 WHERE sent_id % 12 <> 9 OR pos = 0)"""
PAGE_ACTS = _html_acts(f"regexp_replace(html, {_q(DROP_RE)}, '', 'g')")

# annotate -> errors -> accepted -> inputs -> intervals -> edges
TREE_CHAIN = """
a1 AS (
  SELECT sent_id, pos, tok,
    CASE WHEN starts_with(tok, '(') AND NOT ends_with(tok, ')') THEN 1
         WHEN ends_with(tok, ')') AND NOT starts_with(tok, '(') THEN -1 ELSE 0 END AS delta,
    CASE WHEN ends_with(tok, ')') AND NOT starts_with(tok, '(') THEN 1 ELSE 0 END AS is_c
  FROM acts
),
a2 AS (
  SELECT *,
    sum(delta) OVER w_run AS d_after,
    sum(is_c) OVER w_run - is_c AS c_before,
    sum(is_c) OVER (PARTITION BY sent_id) AS c_total,
    count(*) OVER (PARTITION BY sent_id) AS n,
    lead(tok) OVER (PARTITION BY sent_id ORDER BY pos) AS next_tok
  FROM a1
  WINDOW w_run AS (PARTITION BY sent_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
a3 AS (
  SELECT *, d_after - delta AS d_before,
    CASE WHEN tok IS NULL OR tok = '' THEN 'X'
         WHEN tok = '<s>' THEN CASE WHEN pos = 0 THEN 'B' ELSE 'R' END
         WHEN tok = '</s>' THEN CASE WHEN pos = n - 1 THEN 'E' ELSE 'R' END
         WHEN starts_with(tok, '(') AND ends_with(tok, ')') THEN 'BOTH'
         WHEN starts_with(tok, '(') THEN 'O'
         WHEN ends_with(tok, ')') THEN 'C'
         ELSE 'T' END AS kind
  FROM a2
),
a4 AS (
  SELECT *,
    CASE WHEN kind = 'O' THEN substr(tok, 2) WHEN kind = 'C' THEN substr(tok, 1, length(tok) - 1) END AS name,
    CASE WHEN kind IN ('B', 'E') THEN 0 WHEN kind = 'O' THEN d_before ELSE d_after END AS pid
  FROM a3
),
a5 AS (
  SELECT *,
    last_value(CASE WHEN kind = 'O' THEN name END IGNORE NULLS) OVER w_lvl AS open_name,
    last_value(CASE WHEN kind = 'O' THEN pos END IGNORE NULLS) OVER w_lvl AS open_pos
  FROM a4
  WINDOW w_lvl AS (PARTITION BY sent_id, pid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
a6 AS (
  SELECT *,
    CASE WHEN kind = 'X' THEN 'empty_token'
         WHEN kind = 'BOTH' THEN 'both'
         WHEN kind IN ('O', 'C') AND name = '' THEN 'empty_name'
         WHEN kind = 'O' AND next_tok = name || ')' AND NOT starts_with(next_tok, '(') THEN 'empty_production'
         WHEN kind = 'C' AND (open_name IS NULL OR open_name <> name OR d_before <= 0) THEN 'mismatch'
         WHEN kind IN ('T', 'R') AND d_before = 0 THEN 'outside'
         WHEN kind = 'T' AND regexp_matches(tok, '^\\s*$') THEN 'blank_terminal' END AS loop_code
  FROM a5
),
errs AS (
  SELECT sent_id, pos, code, prio FROM (
    SELECT sent_id, pos,
      CASE WHEN n < 2 THEN 'short'
           WHEN (pos = 0 AND coalesce(tok <> '<s>', true)) OR (pos = n - 1 AND coalesce(tok <> '</s>', true)) THEN 'frame'
           WHEN pos > 0 AND pos < n - 1 AND loop_code IS NOT NULL THEN loop_code
           WHEN pos = n - 1 AND d_after <> 0 THEN 'unclosed'
           WHEN kind = 'R' THEN 'reserved' END AS code,
      CASE WHEN n < 2 THEN 0
           WHEN (pos = 0 AND coalesce(tok <> '<s>', true)) OR (pos = n - 1 AND coalesce(tok <> '</s>', true)) THEN 1
           WHEN pos > 0 AND pos < n - 1 AND loop_code IS NOT NULL THEN 2
           WHEN pos = n - 1 AND d_after <> 0 THEN 3
           WHEN kind = 'R' THEN 4 END AS prio
    FROM a6) WHERE code IS NOT NULL
),
rejects AS (
  SELECT sent_id, arg_min(pos, prio::BIGINT * 1000000000 + pos) AS pos, arg_min(code, prio::BIGINT * 1000000000 + pos) AS code
  FROM errs GROUP BY sent_id
),
acc AS (SELECT * FROM a6 WHERE sent_id NOT IN (SELECT sent_id FROM rejects)),
inp AS (
  SELECT sent_id, (pos + c_before + c)::INT AS idx,
         CASE WHEN c = 1 THEN 'D' ELSE kind END AS kind, tok,
         CASE WHEN c = 1 THEN '<pad>' ELSE tok END AS label, pid::INT AS pid, (n + c_total)::INT AS n_in
  FROM acc, (SELECT unnest([0, 1]) AS c) cp
  WHERE c = 0 OR kind = 'C'
),
pr AS (
  SELECT sent_id, idx, n_in, -1 AS level, true AS probe FROM inp WHERE kind = 'B'
  UNION ALL SELECT sent_id, idx, n_in, pid, true FROM inp WHERE kind = 'O'
  UNION ALL SELECT sent_id, idx, n_in, pid - 1, true FROM inp WHERE kind IN ('T', 'C')
  UNION ALL SELECT sent_id, idx, n_in, pid, false FROM inp WHERE kind = 'C'
),
pr2 AS (
  SELECT *, min(CASE WHEN NOT probe THEN idx END) OVER (PARTITION BY sent_id, level ORDER BY idx
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
  FROM pr
),
iv AS (SELECT sent_id, idx AS ki, coalesce(nxt, n_in)::INT AS death, n_in FROM pr2 WHERE probe),
edges AS (
  SELECT sent_id, idx AS qi, idx AS ki FROM inp WHERE kind <> 'E'
  UNION ALL SELECT sent_id, death AS qi, ki FROM iv WHERE death < n_in
  UNION ALL SELECT iv.sent_id, q.idx AS qi, iv.ki FROM iv JOIN inp q
      ON q.sent_id = iv.sent_id AND q.idx > iv.ki AND q.idx < iv.death AND q.kind NOT IN ('C', 'E')
)"""

PY_STR = """CASE WHEN contains({x}, '''') AND NOT contains({x}, '"') THEN '"' || replace({x}, '\\', '\\\\') || '"'
  ELSE '''' || replace(replace({x}, '\\', '\\\\'), '''', '\\''') || '''' END"""

ROW_TEXTS = f"""
grid AS (SELECT sent_id, idx AS qi, unnest(range(n_in)) AS kk FROM inp),
cells AS (
  SELECT g.sent_id, g.qi, g.kk, e.ki IS NOT NULL AS on_
  FROM grid g LEFT JOIN edges e ON e.sent_id = g.sent_id AND e.qi = g.qi AND e.ki = g.kk
),
mrows AS (
  SELECT sent_id, qi, '[' || string_agg(CASE WHEN on_ THEN '1.0' ELSE '0.0' END, ', ' ORDER BY kk) || ']' AS r
  FROM cells GROUP BY sent_id, qi
),
mtext AS (SELECT sent_id, '[' || string_agg(r, ', ' ORDER BY qi) || ']' AS mask_text FROM mrows GROUP BY sent_id),
stext AS (
  SELECT sent_id,
    '[' || string_agg({PY_STR.format(x='tok')}, ', ' ORDER BY idx) || ']' AS inputs_text,
    '[' || string_agg({PY_STR.format(x='label')}, ', ' ORDER BY idx) || ']' AS labels_text,
    '[' || string_agg(pid::VARCHAR, ', ' ORDER BY idx) || ']' AS positions_text
  FROM inp GROUP BY sent_id
),
texts AS (
  SELECT s.sent_id, inputs_text || chr(10) || labels_text || chr(10) || positions_text || chr(10) || mask_text AS text
  FROM stext s JOIN mtext m USING (sent_id)
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


SQL["tree_rejects"] = _with(BROKEN_ACTS, TREE_CHAIN) + "\nSELECT sent_id, pos, code FROM rejects"
SQL["tree_rejects_pages"] = _with(PAGE_ACTS, TREE_CHAIN) + "\nSELECT sent_id, pos, code FROM rejects"
SQL["tree_validate"] = _with(BROKEN_ACTS, TREE_CHAIN) + """
SELECT s.sent_id, coalesce(r.code, 'ok') AS code, r.pos AS err_pos
FROM (SELECT DISTINCT sent_id FROM acts) s LEFT JOIN rejects r USING (sent_id)"""
SQL["tree_expand"] = _with(ORDER_ACTS, TREE_CHAIN) + \
    "\nSELECT sent_id, idx, kind, tok, label, pid AS position_id FROM inp"
SQL["tree_labels"] = _with(ORDER_ACTS, TREE_CHAIN) + \
    "\nSELECT sent_id, string_agg(label, ' ' ORDER BY idx) AS labels FROM inp GROUP BY sent_id"
SQL["tree_positions"] = _with(ORDER_ACTS, TREE_CHAIN) + \
    "\nSELECT sent_id, string_agg(pid::VARCHAR, ' ' ORDER BY idx) AS position_ids FROM inp GROUP BY sent_id"
SQL["tree_match"] = _with(ORDER_ACTS, TREE_CHAIN) + \
    "\nSELECT sent_id, pos AS close_pos, open_pos::INT AS open_pos, name FROM acc WHERE kind = 'C'"
SQL["tree_mask_intervals"] = _with(ORDER_ACTS, TREE_CHAIN) + "\nSELECT sent_id, ki, death FROM iv"
SQL["tree_mask_edges"] = _with(ORDER_ACTS, TREE_CHAIN) + "\nSELECT sent_id, qi, ki FROM edges"
SQL["tree_mask_degree"] = _with(ORDER_ACTS, TREE_CHAIN) + """
SELECT i.sent_id, i.idx AS qi, count(e.ki)::INT AS degree
FROM inp i LEFT JOIN edges e ON e.sent_id = i.sent_id AND e.qi = i.idx
GROUP BY i.sent_id, i.idx"""
SQL["tree_dense_mask"] = _with(ORDER_ACTS, TREE_CHAIN, ROW_TEXTS) + "\nSELECT sent_id, qi, r AS row_text FROM mrows"
SQL["tree_example"] = _with(ORDER_ACTS, TREE_CHAIN, ROW_TEXTS) + "\nSELECT sent_id, text FROM texts"
SQL["tree_fingerprint"] = _with(ORDER_ACTS, TREE_CHAIN, ROW_TEXTS) + \
    "\nSELECT sent_id, md5('i-love-nlp' || text) AS fingerprint FROM texts"
SQL["tree_dataset_digest"] = _with(ORDER_ACTS, TREE_CHAIN, ROW_TEXTS) + """,
buckets AS (
  SELECT sent_id // 1024 AS b, count(*) AS n,
         md5(string_agg(sent_id || ':' || md5('i-love-nlp' || text), chr(10) ORDER BY sent_id)) AS d
  FROM texts GROUP BY 1
)
SELECT sum(n)::BIGINT AS n_sentences, md5(string_agg(b || ':' || d, chr(10) ORDER BY b)) AS digest FROM buckets"""


def oracle_sql() -> dict[str, str]:
    from . import oracle_models, oracle_more  # noqa: F401
    return dict(SQL)
