"""The registered queries of the operators, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    collocations,
    exact_dedup,
    html_main_text,
    lexical_search,
    line_dedup,
    mixing,
    near_dedup,
    pii,
    quality_nbsvm,
    quality_rules,
    secret_scan,
    sentencepieces,
    warc,
)
from .common import table


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


def op2_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op3_sentencepieces(spark, sf_dir):
    return sentencepieces.encode(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark, sf_dir):
    return quality_nbsvm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark, sf_dir):
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_lines").cast("bigint").alias("n_lines"),
                      F.col("_n_dropped").cast("bigint").alias("n_dropped"), "text")


def op7_mixing(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark, sf_dir):
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark, sf_dir):
    return quality_rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_html_main_text(spark, sf_dir):
    return html_main_text.extract(table(spark, sf_dir, "pages"))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def queries():
    return {f.__name__: f for f in (
        op1_exact_dedup, op2_near_dedup, op3_sentencepieces, op4_quality_classifier, op5_warc, op6_line_dedup,
        op7_mixing, op8_secret_scan, op9_quality_rules, op10_html_main_text, op11_collocations, op12_pii, op13_lexical_search)}


_WS = r"[\x20\x09-\x0D]"

ORACLE = {
    "op1_exact_dedup": rf"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_WS}+', ' ', 'g')) AS text_sha256,
                          regexp_replace(coalesce(text, ''), '{_WS}+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, text_sha256 FROM d""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t, octet_length(encode(coalesce(html, ''))) AS b FROM pages),
        q AS (SELECT page_id, b, t, max(page_id) OVER (PARTITION BY t) AS first FROM p)
        SELECT page_id, b::BIGINT AS payload_bytes, sha1(t) AS payload_digest,
               CASE WHEN b >= 1000 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN b >= 1000 AND first <> page_id THEN first END AS refers_to FROM q""",
    "op6_line_dedup": rf"""
        WITH pages AS (SELECT DISTINCT coalesce('=' || source, '') AS host, coalesce(text, '') AS t FROM documents),
        bare AS (SELECT host, t, unnest(list_distinct(list_filter(list_transform(string_split(t, chr(10)),
                 lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> ''))) AS line FROM pages),
        totals AS (SELECT host, count(*) AS pages FROM pages GROUP BY host),
        lines AS (SELECT host, line FROM bare JOIN totals USING (host) GROUP BY host, line, pages
                  HAVING count(*) >= {line_dedup.MIN_PAGES} AND count(*) > {line_dedup.RATIO} * pages),
        drops AS (SELECT host, list(line) AS drop_lines FROM lines GROUP BY host),
        split AS (SELECT doc_id, text, string_split(text, chr(10)) AS a, drop_lines FROM documents
                  LEFT JOIN drops ON drops.host = coalesce('=' || source, '')),
        stay AS (SELECT doc_id, text, a, list_filter(a, lambda x: drop_lines IS NULL OR NOT list_contains(drop_lines,
                 regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g'))) AS s FROM split)
        SELECT doc_id, coalesce(len(a), 0)::BIGINT AS n_lines, coalesce(len(a) - len(s), 0)::BIGINT AS n_dropped,
               array_to_string(s, chr(10)) AS text FROM stay""",
    "op11_collocations": r"""
        WITH p AS (SELECT row_number() OVER () AS pid, lang, piece FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        w AS (SELECT lang, pid, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i
              FROM (SELECT lang, pid, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p)),
        t AS (SELECT lang, w1, lead(w1, 1) OVER x AS w2, lead(w1, 2) OVER x AS w3 FROM w WINDOW x AS (PARTITION BY pid ORDER BY i)),
        f AS (SELECT lang, 1 AS k, w1 AS phrase, count(*)::HUGEINT AS f FROM t GROUP BY ALL
              UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM t WHERE w2 IS NOT NULL GROUP BY ALL
              UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM t WHERE w3 IS NOT NULL GROUP BY ALL),
        n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
        cuts AS (SELECT c.lang, c.k, c.phrase, c.a, c.ws, x.cut, l.f AS l, r.f AS r, (1000000 * a * a) // (l.f * r.f) AS score
                 FROM c JOIN (VALUES (1), (2)) AS x(cut) ON x.cut < c.k
                 JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(ws[:x.cut], ' ')
                 JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(ws[x.cut + 1:], ' ')),
        low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        longer AS (SELECT lang, phrase, max(a) AS longer FROM (
                     SELECT lang, a, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
        kept AS (SELECT low.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
                 FROM low LEFT JOIN longer USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM kept JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_lexical_search": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
        size AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
        q AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
        p AS (SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf
              FROM (SELECT rid, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
              WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
              FROM p, size GROUP BY term, n_docs),
        s AS (SELECT item, item_id, rid, doc_id, sum(times * weight * ((1000000000 * tf) //
                     (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
              FROM p JOIN w USING (term) JOIN q USING (term), size GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20""",
}


def oracle_sql():
    return dict(ORACLE)
