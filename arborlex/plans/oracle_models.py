"""DuckDB oracle SQL: trained BPE models, block-sparse masks and their hash tree, many keywords."""

from __future__ import annotations

from ..operators.bpe_train import BATCH, CANDIDATES, LEAST, ROUNDS
from ..operators.tiles import FAN, TILE
from .catalog_models import KEYWORD_LETTERS
from .oracle import ORDER_ACTS, SQL, TREE_CHAIN, _with
from .oracle_more import words

# pre-tokens of every document with their place, and the distinct ones with their numbers
_PRETOKENS = SQL["bpe_encode"].split("bytes AS MATERIALIZED")[0]

_ALPHABET = """
alphabet AS (
  SELECT b, chr((CASE WHEN keep THEN b ELSE 255 + row_number() OVER (PARTITION BY keep ORDER BY b) END)::INT) AS c
  FROM (SELECT b, b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174 AS keep FROM range(256) t(b))
),
symbols AS (SELECT list(chr(1) || c || chr(2) ORDER BY b) AS l FROM alphabet),
w0 AS MATERIALIZED (
  SELECT w, pt, n, array_to_string(list_transform(range(1, length(hex(encode(pt))) // 2 + 1),
         lambda i: l[('0x' || substring(hex(encode(pt)), 2 * i - 1, 2))::BIGINT + 1]), '') AS s
  FROM words, symbols
)"""


def _rounds(rounds: int, batch: int, least: int) -> str:
    """Tables c0, c1, ... with each round's merges, and w1, w2, ... with the pre-tokens after it."""
    out = []
    for r in range(rounds):
        out.append(f"""
p{r} AS (SELECT a, b, sum(n) AS n FROM (
           SELECT n, z[1] AS a, z[2] AS b FROM (SELECT n, unnest(list_zip(t[:len(t) - 1], t[2:])) AS z FROM (
             SELECT n, string_split(s[2:length(s) - 1], chr(2) || chr(1)) AS t FROM w{r}) WHERE len(t) > 1))
         GROUP BY a, b HAVING sum(n) >= {least}),
g{r} AS MATERIALIZED (SELECT list({{'a': a, 'b': b, 'n': n}} ORDER BY n DESC, a, b) AS l
         FROM (SELECT * FROM p{r} ORDER BY n DESC, a, b LIMIT {CANDIDATES})),
-- one candidate after the other: taken if none of its symbols is
q{r}(i, used, taken) AS (
  SELECT 0, []::VARCHAR[], []::BIGINT[]
  UNION ALL
  SELECT i + 1, CASE WHEN free THEN list_concat(used, [l[i + 1].a, l[i + 1].b]) ELSE used END,
         CASE WHEN free THEN list_append(taken, i + 1) ELSE taken END
  FROM (SELECT i, used, taken, l, NOT list_contains(used, l[i + 1].a) AND NOT list_contains(used, l[i + 1].b) AND len(taken) < {batch} AS free
        FROM q{r}, g{r} WHERE i < len(l))),
c{r} AS MATERIALIZED (SELECT l[k].a AS a, l[k].b AS b, l[k].n AS n, {r} AS round, k AS i
         FROM (SELECT unnest(taken) AS k FROM (SELECT taken FROM q{r} ORDER BY i DESC LIMIT 1)), g{r}),
w{r + 1} AS MATERIALIZED (
  SELECT w, pt, n, list_reduce(list_concat([s], l), lambda x, p: replace(x, p, replace(p, chr(2) || chr(1), ''))) AS s
  FROM w{r}, (SELECT coalesce(list(chr(1) || a || chr(2) || chr(1) || b || chr(2) ORDER BY i), []) AS l FROM c{r}))""")
    return ",".join(out)


_MERGES = "merges AS MATERIALIZED (SELECT a, b, n, row_number() OVER (ORDER BY round, i) - 1 AS rank FROM (" + " UNION ALL ".join(
    f"SELECT * FROM c{r}" for r in range(ROUNDS)) + "))"
_TRAINED = f"{_PRETOKENS}{_ALPHABET.lstrip()},{_rounds(ROUNDS, BATCH, LEAST)},\n{_MERGES}"

SQL["bpe_train"] = f"""{_TRAINED}
SELECT rank::BIGINT AS rank, a, b, n::BIGINT AS n FROM merges"""

SQL["bpe_encode_trained"] = f"""{_TRAINED},
ordered AS (SELECT list(chr(1) || a || chr(2) || chr(1) || b || chr(2) ORDER BY rank) AS l FROM merges),
-- the merge of lowest rank that a pre-token holds, until it holds none
st AS (
  SELECT w, s, list_filter(l, lambda p: contains(s, p))[1] AS p FROM w0, ordered
  UNION ALL
  SELECT w, s, list_filter(l, lambda p: contains(s, p))[1] AS p
  FROM (SELECT w, replace(s, p, replace(p, chr(2) || chr(1), '')) AS s FROM st WHERE p IS NOT NULL), ordered
),
pieces AS (SELECT w, string_split(s[2:length(s) - 1], chr(2) || chr(1)) AS t FROM st WHERE p IS NULL),
done AS (SELECT doc_id, sum(len(t)) AS n_tokens, count(*) AS n_pretokens, max(list_max(list_transform(t, lambda x: length(x)))) AS longest,
                string_agg(array_to_string(t, ' '), ' ' ORDER BY o, j) AS t
         FROM tok JOIN words USING (pt) JOIN pieces USING (w) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_tokens, 0)::BIGINT AS n_tokens, coalesce(n_pretokens, 0)::BIGINT AS n_pretokens,
       coalesce(longest, 0)::BIGINT AS longest, md5(coalesce(t, '')) AS pieces_md5
FROM documents d LEFT JOIN done USING (doc_id)"""

# ------------------------------------------------------------------ tiles and the hash tree

_TILES = f"""
bits AS (SELECT sent_id, qi // {TILE} AS tile_row, ki // {TILE} AS tile_col, ki % {TILE} AS col,
                sum(1::BIGINT << (qi % {TILE}))::BIGINT AS rows, count(*) AS ones FROM edges GROUP BY ALL),
tiles AS (SELECT sent_id, tile_row, tile_col, sum(ones)::BIGINT AS ones, string_agg(col || ':' || rows, ',' ORDER BY col) AS cells
          FROM bits GROUP BY ALL),
refs AS (SELECT sent_id, n_in AS n, coalesce(n_tiles, 0) AS n_tiles, coalesce(ones, 0) AS ones
         FROM (SELECT DISTINCT sent_id, n_in FROM inp) LEFT JOIN
              (SELECT sent_id, count(*) AS n_tiles, sum(ones)::BIGINT AS ones FROM tiles GROUP BY sent_id) USING (sent_id))"""

SQL["tree_mask_tiles"] = _with(ORDER_ACTS, TREE_CHAIN, _TILES) + "\nSELECT sent_id, tile_row, tile_col, ones, cells FROM tiles"
SQL["tree_mask_refs"] = _with(ORDER_ACTS, TREE_CHAIN, _TILES) + """
SELECT sent_id, '1x' || n || 'x' || n AS shape, n_tiles::BIGINT AS n_tiles, ones FROM refs"""
SQL["batch_masks"] = _with(ORDER_ACTS, TREE_CHAIN, _TILES) + """
SELECT batch_id::BIGINT AS batch_id, count(*) || 'x1x' || max(n) || 'x' || max(n) AS shape,
       string_agg(sent_id || ':' || n || ':' || n_tiles || ':' || ones, ';' ORDER BY sent_id) AS masks
FROM (SELECT *, (row_number() OVER (ORDER BY sent_id) - 1) // 16 AS batch_id FROM refs) GROUP BY batch_id"""

_LEVELS = 6  # enough for 16**6 examples
SQL["tree_hash_tree"] = _with(ORDER_ACTS, TREE_CHAIN, _TILES) + f""",
places AS (SELECT sent_id, idx // {TILE} AS tile_row, md5(string_agg(tok || chr(9) || label || chr(9) || pid, chr(10) ORDER BY idx)) AS places
           FROM inp GROUP BY ALL),
held AS (SELECT sent_id, tile_row, string_agg(md5(tile_col || '|' || cells), '' ORDER BY tile_col) AS tiles FROM tiles GROUP BY ALL),
rws AS (SELECT sent_id, tile_row, md5(places || coalesce(tiles, '')) AS hash FROM places LEFT JOIN held USING (sent_id, tile_row)),
l0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sent_id) - 1 AS i, sent_id, md5(string_agg(hash, '' ORDER BY tile_row)) AS hash
                    FROM rws GROUP BY sent_id)""" + "".join(f""",
l{k + 1} AS MATERIALIZED (SELECT i // {FAN} AS i, NULL::BIGINT AS sent_id, md5(string_agg(hash, '' ORDER BY i)) AS hash
                    FROM l{k} WHERE (SELECT count(*) FROM l{k}) > 1 GROUP BY i // {FAN})""" for k in range(_LEVELS)) + "".join(
    f"\n{'UNION ALL ' if k else ''}SELECT {k} AS level, i, sent_id, hash FROM l{k}" for k in range(_LEVELS + 1))

SQL["keyword_scan"] = f"""
WITH k AS (SELECT DISTINCT lower(w) AS keyword FROM (SELECT unnest({words('text')}) AS w FROM benchmark) WHERE length(w) >= {KEYWORD_LETTERS}),
h AS (SELECT doc_id, count(*) AS n, string_agg(keyword, ' ' ORDER BY keyword) AS t
      FROM (SELECT doc_id, lower(text) AS text FROM documents) JOIN k ON contains(text, keyword) GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_keywords, md5(coalesce(t, '')) AS keywords_md5 FROM documents LEFT JOIN h USING (doc_id)"""

# ------------------------------------------------------------------ files and functions of the caller

SQL["file_lines"] = """
SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS sent_id, text
FROM (SELECT doc_id, unnest(l) AS text, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))"""

SQL["merge_file"] = f"""{_TRAINED}
SELECT rank::BIGINT AS rank, a, b FROM merges"""

SQL["dataset_sink"] = _with(ORDER_ACTS, TREE_CHAIN) + """
SELECT sent_id, count(*) AS n, md5(string_agg(kind || ' ' || tok || ' ' || label || ' ' || pid, '|' ORDER BY idx)) AS rows_md5,
       (SELECT count(*) FROM inp)::BIGINT AS manifest_rows
FROM inp GROUP BY sent_id"""

SQL["map_batched"] = """
SELECT doc_id, len(p)::BIGINT AS n_parts, list_max(list_transform(p, lambda x: length(x)))::BIGINT AS longest
FROM (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS p FROM documents)"""

SQL["collate_batches"] = _with(ORDER_ACTS, TREE_CHAIN) + """,
seqs AS (SELECT sent_id, list(pid ORDER BY idx) AS pids, (row_number() OVER (ORDER BY sent_id) - 1) // 16 AS batch_id FROM inp GROUP BY sent_id),
long AS (SELECT *, max(len(pids)) OVER (PARTITION BY batch_id) AS top FROM seqs)
SELECT batch_id::BIGINT AS batch_id, count(*)::INT AS n_rows,
       string_agg(array_to_string(list_resize(pids, top, 0), ' '), ';' ORDER BY sent_id) AS position_ids
FROM long GROUP BY batch_id"""

SQL["count_dot_top"] = f"""
WITH a AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest({words("coalesce(text, '')")}) AS w FROM documents) GROUP BY ALL),
b AS (SELECT item_id, w, count(*) AS n FROM (SELECT item_id, unnest({words("coalesce(text, '')")}) AS w FROM benchmark) GROUP BY ALL)
SELECT item_id AS grp_b, row_number() OVER (PARTITION BY item_id ORDER BY dot DESC, doc_id) AS rank, doc_id AS grp_a, dot
FROM (SELECT item_id, doc_id, sum(a.n * b.n)::DOUBLE AS dot FROM a JOIN b USING (w) GROUP BY ALL)
QUALIFY rank <= 5"""
