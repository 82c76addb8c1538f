"""DuckDB oracle SQL: vocabulary, batching, metrics, chat, counts, sampling."""

from __future__ import annotations

from .oracle import ORDER_ACTS, SQL, TREE_CHAIN, _with

# Unicode White_Space as an RE2 class (RE2's \s is ASCII only and lacks \v).
WS_CHARS = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS = f"'[{WS_CHARS}]+'"
NL = "chr(10)"


def words(col: str) -> str:
    return f"list_filter(string_split_regex({col}, {WS}), lambda x: x <> '')"


def vocab_cte(corpus_sql: str, name: str = "vocab") -> str:
    """Word vocabulary: specials 0-3, then (count desc, token asc), no limit."""
    return f"""
{name}_w AS (SELECT unnest({words('text')}) AS token FROM ({corpus_sql})),
{name}_c AS (SELECT token, count(*) AS cnt FROM {name}_w
            WHERE token NOT IN ('<unk>', '<s>', '</s>', '<pad>') GROUP BY token),
{name}_l AS (SELECT token, row_number() OVER (ORDER BY cnt DESC, token) AS rn FROM {name}_c),
{name} AS (
  SELECT * FROM (VALUES ('<unk>', 0::BIGINT), ('<s>', 1::BIGINT), ('</s>', 2::BIGINT), ('<pad>', 3::BIGINT)) v(token, id)
  UNION ALL SELECT token, (rn + 3)::BIGINT FROM {name}_l
)"""


DOCS_VOCAB = vocab_cte("SELECT text FROM documents")
CLEAN_VOCAB = """
cv AS (
  SELECT token, (row_number() OVER (ORDER BY id) - 1)::BIGINT AS id
  FROM vocab WHERE NOT regexp_matches(token, '[0-9²³¹]{2}')
)"""
PREFIX_MERGES = """
pm AS (
  SELECT id AS rank, substr(token, 1, length(token) - 1) AS a, substr(token, length(token), 1) AS b
  FROM vocab WHERE length(token) >= 2
),
cm AS (
  SELECT rank, a, b FROM pm
  WHERE NOT regexp_matches(a || b, '[0-9²³¹]{2}')
    AND a IN (SELECT token FROM cv) AND b IN (SELECT token FROM cv)
)"""

SQL["text_lines"] = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INT AS line_no, unnest(ls) AS text FROM l"""
SQL["vocab_json"] = """
WITH k AS (SELECT event_id, props, unnest(json_keys(props)) AS token FROM events)
SELECT event_id, token, (props ->> token)::BIGINT AS id FROM k"""
SQL["vocab_train"] = _with(DOCS_VOCAB) + "\nSELECT token, id FROM vocab"
SQL["vocab_size"] = _with(DOCS_VOCAB) + "\nSELECT count(*)::BIGINT AS vocab_size FROM vocab"
SQL["vocab_specials"] = _with(DOCS_VOCAB) + """
SELECT max(CASE WHEN token = '<pad>' THEN id END) AS pad_id, max(CASE WHEN token = '<s>' THEN id END) AS bos_id,
       max(CASE WHEN token = '</s>' THEN id END) AS eos_id, max(CASE WHEN token = '<unk>' THEN id END) AS unk_id
FROM vocab"""
SQL["vocab_encode"] = _with(DOCS_VOCAB, f"""
toks AS (SELECT doc_id, ['<s>'] || {words('text')} || ['</s>'] AS a FROM documents),
ex AS (SELECT doc_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS tok FROM toks)""") + """
SELECT doc_id, count(*)::BIGINT AS n_tokens, count_if(coalesce(v.id, 0) = 0)::BIGINT AS n_unk,
       sum(coalesce(v.id, 0) * (pos + 1))::BIGINT AS id_checksum
FROM ex LEFT JOIN vocab v ON v.token = ex.tok GROUP BY doc_id"""
BENCH_IDS = f"""
btoks AS (SELECT item_id, ['<s>'] || {words('text')} || ['</s>'] AS a FROM benchmark),
bex AS (SELECT item_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS tok FROM btoks),
bids AS (SELECT item_id, pos, bex.tok, coalesce(v.id, 0) AS token_id FROM bex LEFT JOIN vocab v ON v.token = bex.tok)"""
SQL["vocab_decode"] = _with(DOCS_VOCAB, BENCH_IDS) + """
SELECT item_id, string_agg(v.token, ' ' ORDER BY pos) AS text
FROM bids JOIN vocab v ON v.id = bids.token_id
WHERE v.token NOT IN ('<unk>', '<s>', '</s>', '<pad>')
GROUP BY item_id"""
SQL["vocab_unk"] = _with(DOCS_VOCAB, BENCH_IDS) + """
SELECT item_id, count(*)::BIGINT AS n_words, count_if(token_id = 0)::BIGINT AS n_unk
FROM bids WHERE tok NOT IN ('<s>', '</s>') GROUP BY item_id"""
SQL["vocab_clean"] = _with(DOCS_VOCAB, CLEAN_VOCAB) + "\nSELECT token, id FROM cv"
SQL["merge_clean"] = _with(DOCS_VOCAB, CLEAN_VOCAB, PREFIX_MERGES) + "\nSELECT rank, a, b FROM cm"
SQL["vocab_audit"] = _with(DOCS_VOCAB, CLEAN_VOCAB) + """,
j AS (SELECT cv.token, cv.id AS nid, v.id AS oid FROM cv LEFT JOIN vocab v USING (token)),
r AS (SELECT nid, row_number() OVER (ORDER BY oid, nid) - 1 AS rk FROM j WHERE oid IS NOT NULL)
SELECT (count(*) = 0 OR (min(nid) = 0 AND max(nid) = count(*) - 1 AND count(DISTINCT nid) = count(*))) AS dense_ids,
       count_if(oid IS NULL) = 0 AS subset_of_old,
       (SELECT count_if(rk <> nid) FROM r) = 0 AS order_kept
FROM j"""
SQL["merge_audit"] = _with(DOCS_VOCAB, CLEAN_VOCAB, PREFIX_MERGES) + """,
j AS (SELECT cm.rank AS nr, pm.rank AS orank FROM cm JOIN pm USING (a, b)),
r AS (SELECT row_number() OVER (ORDER BY orank, nr) AS r1, row_number() OVER (ORDER BY nr, orank) AS r2 FROM j)
SELECT (SELECT count(*) FROM (SELECT a, b FROM cm GROUP BY a, b HAVING count(*) > 1)) = 0 AS no_repeats,
       (SELECT count(*) FROM cm WHERE NOT EXISTS (SELECT 1 FROM pm WHERE pm.a = cm.a AND pm.b = cm.b)) = 0
         AS subset_of_old,
       (SELECT count_if(r1 <> r2) FROM r) = 0 AS order_kept"""

# ---------------------------------------------------------------- batching
PAD_CTES = _with(ORDER_ACTS, TREE_CHAIN, vocab_cte(
    "SELECT tok AS text FROM acts",
    name="nv")) + """,
ids AS (
  SELECT i.sent_id, i.idx, i.pid, coalesce(a.id, 0) AS input_id, coalesce(b.id, 0) AS label_id
  FROM inp i LEFT JOIN nv a ON a.token = i.tok LEFT JOIN nv b ON b.token = i.label
),
seq AS (
  SELECT sent_id,
         list(input_id ORDER BY idx) AS input_ids,
         list(CASE WHEN label_id = 3 THEN -100 ELSE label_id END ORDER BY idx) AS labels,
         list(pid ORDER BY idx) AS position_ids,
         count(*) AS n
  FROM ids GROUP BY sent_id
),
bt AS (SELECT *, (row_number() OVER (ORDER BY sent_id) - 1) // 16 AS batch_id FROM seq),
mx AS (SELECT *, max(n) OVER (PARTITION BY batch_id) AS max_len FROM bt)"""
SQL["pad_batches"] = PAD_CTES + """
SELECT batch_id::BIGINT AS batch_id, sent_id, max_len::INT AS max_len,
       array_to_string(list_resize(input_ids, max_len, 3), ' ') AS input_ids,
       array_to_string(list_resize(labels, max_len, -100), ' ') AS labels,
       array_to_string(list_resize(position_ids, max_len, 0), ' ') AS position_ids
FROM mx"""
SQL["batch_stack"] = PAD_CTES + """
SELECT batch_id::BIGINT AS batch_id, string_agg(sent_id::VARCHAR, ' ' ORDER BY sent_id) AS sent_ids,
       count(*)::INT AS n_rows, max(max_len)::INT AS max_len
FROM mx GROUP BY batch_id"""
SQL["batch_mask_padded"] = PAD_CTES + """,
pg AS (SELECT sent_id, max_len, unnest(range(max_len)) AS q FROM mx),
pc AS (SELECT sent_id, max_len, q, unnest(range(max_len)) AS k FROM pg),
pe AS (
  SELECT pc.sent_id, pc.q, pc.k, e.ki IS NOT NULL AS on_
  FROM pc LEFT JOIN edges e ON e.sent_id = pc.sent_id AND e.qi = pc.q AND e.ki = pc.k
)
SELECT sent_id, q::INT AS qi, string_agg(CASE WHEN on_ THEN '1.0' ELSE '0.0' END, ' ' ORDER BY k) AS row_text
FROM pe GROUP BY sent_id, q"""

SQL["batch_full"] = PAD_CTES + """,
pg AS (SELECT sent_id, max_len, unnest(range(max_len)) AS q FROM mx),
pc AS (SELECT sent_id, max_len, q, unnest(range(max_len)) AS k FROM pg),
mr AS (
  SELECT pc.sent_id, pc.q, string_agg(CASE WHEN e.ki IS NULL THEN '0.0' ELSE '1.0' END, ' ' ORDER BY pc.k) AS r
  FROM pc LEFT JOIN edges e ON e.sent_id = pc.sent_id AND e.qi = pc.q AND e.ki = pc.k GROUP BY pc.sent_id, pc.q
),
pm AS (SELECT sent_id, string_agg(r, '|' ORDER BY q) AS mask FROM mr GROUP BY sent_id)
SELECT batch_id::BIGINT AS batch_id, count(*)::INT AS n_rows,
       string_agg(array_to_string(list_resize(input_ids, max_len, 3), ' '), ';' ORDER BY sent_id) AS input_ids,
       string_agg(array_to_string(list_resize(labels, max_len, -100), ' '), ';' ORDER BY sent_id) AS labels,
       string_agg(array_to_string(list_resize(position_ids, max_len, 0), ' '), ';' ORDER BY sent_id) AS position_ids,
       md5(string_agg(mask, ';' ORDER BY sent_id)) AS attention_mask_md5
FROM mx JOIN pm USING (sent_id) GROUP BY batch_id"""

# ---------------------------------------------------------------- metrics
SCORES = """
fl AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
ce AS (SELECT label, i, avg(x) AS m FROM fl WHERE label BETWEEN 0 AND 9 GROUP BY label, i),
di AS (SELECT vec_id, ce.label::INT AS label, sum((x - m) * (x - m)) AS far FROM fl JOIN ce USING (i) GROUP BY vec_id, ce.label),
ex AS (SELECT vec_id, label, exp(min(far) OVER (PARTITION BY vec_id) - far) AS e FROM di),
scores AS (SELECT vec_id, label, e / sum(e) OVER (PARTITION BY vec_id) AS score FROM ex),
top AS (
  SELECT vec_id, label, score FROM scores
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) = 1
),
pairs AS (SELECT t.vec_id AS item_id, t.label AS pred, e.label AS gold, t.score FROM top t JOIN embeddings e USING (vec_id)),
pc AS (
  SELECT label, sum(tp) AS tp, sum(np) AS np, sum(ng) AS ng, 2.0 * sum(tp) / (sum(np) + sum(ng)) AS f1 FROM (
    SELECT pred AS label, (pred = gold)::INT AS tp, 1 AS np, 0 AS ng FROM pairs
    UNION ALL SELECT gold, 0, 0, 1 FROM pairs) GROUP BY label
),
acc AS (SELECT count(*)::BIGINT AS n, count_if(pred = gold)::BIGINT AS n_correct,
               avg((pred = gold)::INT::DOUBLE) AS accuracy FROM pairs)"""
LABELS = """
names AS (SELECT * FROM (VALUES (0, 'Society & Culture'), (1, 'Science & Mathematics'), (2, 'Health'),
  (3, 'Education & Reference'), (4, 'Computers & Internet'), (5, 'Sports'), (6, 'Business & Finance'),
  (7, 'Entertainment & Music'), (8, 'Family & Relationships'), (9, 'Politics & Government')) n(label_id, label_name))"""

SQL["top1_label"] = _with(SCORES) + "\nSELECT vec_id, label, round(score, 6) AS score FROM top"
SQL["label_names"] = _with(SCORES, LABELS) + \
    "\nSELECT vec_id, label, label_name FROM top LEFT JOIN names ON names.label_id = top.label"
SQL["prediction_contract"] = _with(SCORES, LABELS) + """
SELECT count(*)::BIGINT AS n, count_if(label_name IS NULL)::BIGINT AS bad_label,
       count_if(score IS NULL OR score < 0 OR score > 1)::BIGINT AS bad_score
FROM top LEFT JOIN names ON names.label_id = top.label"""
SQL["accuracy"] = _with(SCORES) + "\nSELECT n, n_correct, round(accuracy, 6) AS accuracy FROM acc"
SQL["macro_f1"] = _with(SCORES) + "\nSELECT round(avg(f1), 6) AS macro_f1 FROM pc"
SQL["per_class_f1"] = _with(SCORES) + """
SELECT label::INT AS label, tp::BIGINT AS tp, np::BIGINT AS np, ng::BIGINT AS ng, round(f1, 6) AS f1 FROM pc"""
SQL["threshold_points"] = _with(SCORES) + """
SELECT round(accuracy, 6) AS accuracy,
       (SELECT count(*) FROM (VALUES (0.30), (0.35), (0.50)) t(x) WHERE acc.accuracy >= x)::INT AS points
FROM acc"""
SQL["loss_points"] = _with(SCORES) + """,
loss AS (SELECT avg(-ln(s.score)) AS loss FROM scores s JOIN embeddings e ON e.vec_id = s.vec_id AND e.label = s.label)
SELECT round(loss, 6) AS loss, (2 * (SELECT count(*) FROM (VALUES (3.0)) t(x) WHERE loss.loss <= x))::INT AS points
FROM loss"""
SQL["failure_example"] = _with(SCORES) + \
    "\nSELECT item_id AS vec_id, pred, gold FROM pairs WHERE pred <> gold ORDER BY item_id DESC LIMIT 1"
SQL["tolerance"] = _with(SCORES) + """,
hp AS (SELECT *, CASE WHEN item_id % 2 = 0 THEN 'even' ELSE 'odd' END AS half FROM pairs),
hf AS (
  SELECT half, label, 2.0 * sum(tp) / (sum(np) + sum(ng)) AS f1 FROM (
    SELECT half, pred AS label, (pred = gold)::INT AS tp, 1 AS np, 0 AS ng FROM hp
    UNION ALL SELECT half, gold, 0, 0, 1 FROM hp) GROUP BY half, label
),
j AS (
  SELECT coalesce(e.label, o.label)::INT AS label, coalesce(e.f1, 0.0) AS a, coalesce(o.f1, 0.0) AS b
  FROM (SELECT * FROM hf WHERE half = 'even') e FULL JOIN (SELECT * FROM hf WHERE half = 'odd') o USING (label)
)
SELECT label, round(a, 6) AS f1_even, round(b, 6) AS f1_odd, abs(a - b) <= 0.001 AS within FROM j"""
SQL["rounded_report"] = _with(SCORES) + """
SELECT round(accuracy, 2) AS accuracy_2, (SELECT round(avg(f1), 4) FROM pc) AS macro_f1_4 FROM acc"""
SQL["seeded_sample"] = """
SELECT doc_id, ('0x' || substr(md5('42|' || doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 AS u
FROM documents ORDER BY u, doc_id LIMIT 83"""

# ---------------------------------------------------------------- chat
BLOCK = f"'<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL}"
DEFAULT_BLOCK = (f"'<|im_start|>system' || {NL} || 'You are a helpful AI assistant named SmolLM, trained by Hugging "
                 f"Face<|im_end|>' || {NL}")


def render_sql(src: str, gen: bool) -> str:
    tail = f" || '<|im_start|>assistant' || {NL}" if gen else ""
    return f"""
SELECT conv_id,
  CASE WHEN arg_min(role, turn) <> 'system' THEN {DEFAULT_BLOCK} ELSE '' END
  || string_agg({BLOCK}, '' ORDER BY turn){tail} AS prompt
FROM {src} GROUP BY conv_id"""


SQL["chat_render"] = render_sql("conversations", True)
SQL["chat_audit"] = f"""
WITH r AS ({render_sql("conversations", True)}),
c AS (SELECT t.conv_id, bool_and(contains(r.prompt, t.text)) AS all_contained
      FROM conversations t JOIN r USING (conv_id) GROUP BY t.conv_id)
SELECT r.conv_id, starts_with(prompt, '<|im_start|>system') AS starts_with_system,
       (length(prompt) - length(replace(prompt, '<|im_start|>system', ''))) / length('<|im_start|>system') < 2
         AS one_system_block,
       coalesce(c.all_contained, true) AS all_contained
FROM r LEFT JOIN c USING (conv_id)"""
SQL["chat_last"] = """
SELECT conv_id, arg_max(role, turn) AS last_role, arg_max(text, turn) AS last_text FROM conversations GROUP BY conv_id"""
_KW = ["As an AI", "I don't", "I cannot", "I am not", "I won't", "I will not", "I do not", "I can't", "not to"]
SQL["chat_refusal"] = "SELECT conv_id, turn, (" + " OR ".join(
    "contains(text, '" + k.replace("'", "''") + "')" for k in _KW) + \
    ") AS is_refusal, (" + " OR ".join(f"contains(text, '{k}')" for k in ("ths", "heit", "ment", "ciones")) + \
    ") AS has_own FROM conversations WHERE role = 'assistant'"
SQL["chat_keyword"] = f"""
WITH fq AS (SELECT conv_id, arg_min(text, turn) AS q FROM conversations WHERE role = 'user' GROUP BY conv_id),
fu AS (SELECT conv_id, unnest(list_distinct({words('q')})) AS keyword FROM fq)
SELECT fu.conv_id, fu.keyword, coalesce(bool_or(contains(lower(c.text), lower(fu.keyword))), false) AS found
FROM fu LEFT JOIN conversations c ON c.conv_id = fu.conv_id AND c.role = 'assistant'
GROUP BY fu.conv_id, fu.keyword"""
SQL["chat_append"] = """
SELECT conv_id, turn, role, text FROM conversations
UNION ALL SELECT conv_id, max(turn) + 1, 'user', 'Please continue.' FROM conversations GROUP BY conv_id"""
SQL["chat_strip"] = f"""
WITH lt AS (SELECT conv_id, max(turn) AS last_turn FROM conversations GROUP BY conv_id),
t AS (SELECT c.*, lt.last_turn FROM conversations c JOIN lt USING (conv_id)),
p AS ({render_sql("(SELECT * FROM t WHERE turn < last_turn)", False)}),
f AS ({render_sql("t", False)}),
j AS (SELECT f.conv_id, {words("f.prompt")} AS a, coalesce(len({words("p.prompt")}), 0) AS n FROM f LEFT JOIN p USING (conv_id)),
k AS (SELECT conv_id, a[n + 1:n + 128] AS toks FROM j)
SELECT conv_id, array_to_string(toks, ' ') AS reply, len(toks)::INT AS n_new FROM k"""

# ---------------------------------------------------------------- counts
LANG_COUNTS = f"""
lc AS (SELECT lang AS grp, w AS key, count(*)::DOUBLE AS value
       FROM (SELECT lang, unnest({words('text')}) AS w FROM documents) GROUP BY 1, 2)"""
SQL["count_increment"] = _with(LANG_COUNTS) + "\nSELECT grp, key, value FROM lc"
SQL["count_argmax"] = f"""
WITH dc AS (SELECT doc_id, w AS key, count(*)::DOUBLE AS value
            FROM (SELECT doc_id, unnest({words('text')}) AS w FROM documents) GROUP BY 1, 2)
SELECT doc_id, key FROM dc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY value DESC, key) = 1"""
SQL["count_topk"] = _with(LANG_COUNTS) + """
SELECT grp, rank::BIGINT AS rank, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY value DESC, key) AS rank FROM lc) WHERE rank <= 5"""
SQL["count_sorted"] = _with(LANG_COUNTS) + """
SELECT grp, (row_number() OVER (PARTITION BY grp ORDER BY value DESC, key))::BIGINT AS rank, key, value FROM lc"""
SQL["count_total"] = _with(LANG_COUNTS) + "\nSELECT grp, sum(value) AS total FROM lc GROUP BY grp"
SQL["count_norm"] = _with(LANG_COUNTS) + """
SELECT grp, key, round(CASE WHEN total = 0 THEN value ELSE value / total END, 9) AS value
FROM lc JOIN (SELECT grp, sum(value) AS total FROM lc GROUP BY grp) USING (grp)"""
SQL["count_scale"] = _with(LANG_COUNTS) + "\nSELECT grp, key, value / 2.0 AS value FROM lc"
BENCH_COUNTS = f"""
bc AS (SELECT w AS key, count(*)::DOUBLE AS value
       FROM (SELECT unnest({words('text')}) AS w FROM benchmark) GROUP BY 1),
ac AS (SELECT w AS key, count(*)::DOUBLE AS value
       FROM (SELECT unnest({words('text')}) AS w FROM documents) GROUP BY 1)"""
SQL["count_dot"] = _with(LANG_COUNTS, BENCH_COUNTS) + """
SELECT lc.grp AS grp_a, 'benchmark' AS grp_b, sum(lc.value * bc.value) AS dot FROM lc JOIN bc USING (key) GROUP BY lc.grp"""
SQL["count_add"] = _with(BENCH_COUNTS) + """
SELECT 'corpus' AS grp, key, sum(value) AS value FROM (SELECT * FROM ac UNION ALL SELECT * FROM bc) GROUP BY key"""
SQL["count_sub"] = _with(BENCH_COUNTS) + """
SELECT 'corpus' AS grp, key, sum(value) AS value
FROM (SELECT * FROM ac UNION ALL SELECT key, -value FROM bc) GROUP BY key"""

# ---------------------------------------------------------------- sampling
BANDS = """
ew AS (SELECT event_type, sum(value) AS w FROM events GROUP BY event_type),
bands AS (
  SELECT event_type, w, (sum(w) OVER (ORDER BY event_type) - w) / sum(w) OVER () AS lo,
         CASE WHEN event_type >= (SELECT max(event_type) FROM ew WHERE w > 0) THEN 1.0
              ELSE sum(w) OVER (ORDER BY event_type) / sum(w) OVER () END AS hi, w / sum(w) OVER () AS p
  FROM ew
)"""
SQL["weighted_draw"] = _with(BANDS) + """,
users AS (SELECT DISTINCT user_id,
          ('0x' || substr(md5('42|' || user_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 AS u FROM events)
SELECT user_id, event_type FROM users JOIN bands ON u >= lo AND u < hi WHERE hi > lo"""
SQL["weighted_draw_inclusive"] = _with(BANDS) + """,
users AS (SELECT DISTINCT user_id,
          ('0x' || substr(md5('42|' || user_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 AS u FROM events)
SELECT user_id, event_type FROM users JOIN bands ON (u > lo AND u <= hi) OR (u = 0 AND lo = 0) WHERE hi > lo"""
SQL["value_probability"] = _with(BANDS) + "\nSELECT event_type, round(p, 9) AS probability FROM bands"
SQL["bernoulli"] = """
SELECT event_id FROM events
WHERE ('0x' || substr(md5('42|' || event_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < 0.1"""
SQL["transpose"] = _with(ORDER_ACTS, TREE_CHAIN) + "\nSELECT sent_id, ki AS row, qi AS col FROM edges"
SQL["scalar_helpers"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(abs(l_quantity - l_tax) + abs(l_discount - 0.0), 6) AS l1,
       trunc(l_extendedprice / 1000 + 0.5)::BIGINT AS nearest,
       CASE WHEN l_quantity - 25 >= 0 THEN 1 ELSE -1 END AS sgn
FROM lineitem"""

# ---------------------------------------------------------------- classifier
NB = _with(f"""
nw AS (SELECT quality AS y, unnest({words('text')}) AS token FROM documents JOIN labels USING (doc_id)),
nc AS (SELECT token, sum(y) AS c1, sum(1 - y) AS c0 FROM nw GROUP BY token),
nt AS (SELECT sum(c1) AS n1, sum(c0) AS n0, count(*) AS v FROM nc),
np AS (SELECT ln(sum(quality) / sum(1 - quality)) AS prior FROM documents JOIN labels USING (doc_id)),
wt AS (SELECT token, ln((c1 + 1) / (n1 + v)) - ln((c0 + 1) / (n0 + v)) AS weight FROM nc, nt),
dw AS (SELECT doc_id, unnest({words('text')}) AS token FROM documents),
ds AS (SELECT doc_id, sum(weight) AS s FROM dw JOIN wt USING (token) GROUP BY doc_id),
od AS (SELECT doc_id, prior + coalesce(s, 0) AS log_odds FROM documents LEFT JOIN ds USING (doc_id), np),
nbp AS (SELECT doc_id AS item_id, (log_odds > 0)::INT AS pred, quality AS gold FROM od JOIN labels USING (doc_id))""")
SQL["nb_classifier"] = NB + "\nSELECT doc_id, (log_odds > 0)::INT AS label, round(log_odds, 4) AS log_odds FROM od"
SQL["nb_report"] = NB + """,
pc AS (SELECT label, 2.0 * sum(tp) / (sum(np_) + sum(ng)) AS f1 FROM (
    SELECT pred AS label, (pred = gold)::INT AS tp, 1 AS np_, 0 AS ng FROM nbp
    UNION ALL SELECT gold, 0, 0, 1 FROM nbp) GROUP BY label),
acc AS (SELECT count(*)::BIGINT AS n, count_if(pred = gold)::BIGINT AS n_correct, avg((pred = gold)::INT::DOUBLE) AS accuracy FROM nbp)
SELECT n, n_correct, round(accuracy, 6) AS accuracy,
       (SELECT count(*) FROM (VALUES (0.30), (0.35), (0.50)) t(x) WHERE acc.accuracy >= x)::INT AS points,
       (SELECT round(avg(f1), 6) FROM pc) AS macro_f1
FROM acc"""
SQL["nb_failure"] = NB + """
SELECT item_id AS doc_id, pred, gold, text FROM nbp JOIN documents ON doc_id = item_id
WHERE pred <> gold ORDER BY item_id DESC LIMIT 1"""

# ---------------------------------------------------------------- byte pairs
SQL["bpe_encode"] = rf"""WITH RECURSIVE seg AS (
  SELECT doc_id, unnest(a) AS s, generate_subscripts(a, 1) AS o
  FROM (SELECT doc_id, regexp_extract_all(text, '[{WS_CHARS}]?[^{WS_CHARS}]+|[{WS_CHARS}]+') AS a FROM documents)
),
near AS (SELECT doc_id, o, s, regexp_full_match(s, '[{WS_CHARS}]+') AS blank, lag(s) OVER d AS p, lead(s) OVER d IS NULL AS last
         FROM seg WINDOW d AS (PARTITION BY doc_id ORDER BY o)),
-- a blank run before a word gives its last blank to the word
part AS (SELECT doc_id, o, CASE WHEN blank AND NOT last THEN left(s, length(s) - 1)
                                WHEN NOT blank AND regexp_full_match(p, '[{WS_CHARS}]+') THEN right(p, 1) || s ELSE s END AS s FROM near),
tok AS (
  SELECT doc_id, o, unnest(a) AS pt, generate_subscripts(a, 1) AS j
  FROM (SELECT doc_id, o, regexp_extract_all(
    s, '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS_CHARS}\p{{L}}\p{{N}}]+|[{WS_CHARS}]+') AS a FROM part)
),
words AS MATERIALIZED (SELECT pt, count(*) AS n, row_number() OVER () AS w FROM tok GROUP BY pt),
bytes AS MATERIALIZED (
  SELECT w, n, i, substring(h, 2 * i - 1, 2) AS x, CASE WHEN 2 * i < length(h) THEN substring(h, 2 * i - 1, 4) END AS pair
  FROM (SELECT w, n, h, unnest(range(1, length(h) // 2 + 1)) AS i FROM (SELECT w, n, hex(encode(pt)) AS h FROM words))
),
ranks AS (SELECT pair, row_number() OVER (ORDER BY sum(n) DESC, pair) - 1 AS rank FROM bytes WHERE pair IS NOT NULL GROUP BY pair),
alphabet AS (
  SELECT printf('%02X', b) AS x, chr((CASE WHEN keep THEN b
    ELSE 255 + row_number() OVER (PARTITION BY keep ORDER BY b) END)::INT) AS c
  FROM (SELECT b, b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174 AS keep FROM range(256) t(b))
),
kept AS (
  SELECT pair, rank FROM ranks JOIN alphabet l ON l.x = left(pair, 2) JOIN alphabet r ON r.x = right(pair, 2)
  WHERE NOT regexp_matches(l.c || r.c, '[0-9²³¹]{{2}}')
),
-- each round joins the pairs that rank below both neighbours (the left one on ties) and drops those beside them
st(w, i, rank, joined) AS (
  SELECT w, i, rank, false FROM bytes JOIN kept USING (pair)
  UNION ALL
  SELECT w, i, rank, joined FROM (
    SELECT *, coalesce(lag(joined) OVER d AND lag(i) OVER d = i - 1, false) OR
              coalesce(lead(joined) OVER d AND lead(i) OVER d = i + 1, false) AS beside
    FROM (SELECT w, i, rank, NOT coalesce(lag(i) OVER d = i - 1 AND lag(rank) OVER d <= rank, false) AND
                 NOT coalesce(lead(i) OVER d = i + 1 AND lead(rank) OVER d < rank, false) AS joined
          FROM st WHERE NOT joined WINDOW d AS (PARTITION BY w ORDER BY i))
    WINDOW d AS (PARTITION BY w ORDER BY i))
  WHERE NOT beside
),
joins AS (SELECT w, i FROM st WHERE joined),
pieces AS (
  SELECT b.w, count(*) AS k, string_agg(a.c || coalesce(a2.c, ''), ' ' ORDER BY b.i) AS t
  FROM bytes b JOIN alphabet a ON a.x = b.x LEFT JOIN joins j ON j.w = b.w AND j.i = b.i
  LEFT JOIN joins before ON before.w = b.w AND before.i = b.i - 1
  LEFT JOIN alphabet a2 ON j.i IS NOT NULL AND a2.x = right(b.pair, 2)
  WHERE before.i IS NULL GROUP BY b.w
),
done AS (SELECT doc_id, sum(k) AS n_tokens, count(*) AS n_pretokens, string_agg(t, ' ' ORDER BY o, j) AS t
         FROM tok JOIN words USING (pt) JOIN pieces USING (w) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_tokens, 0)::BIGINT AS n_tokens, coalesce(n_pretokens, 0)::BIGINT AS n_pretokens,
       md5(coalesce(t, '')) AS pieces_md5
FROM documents d LEFT JOIN done USING (doc_id)"""
