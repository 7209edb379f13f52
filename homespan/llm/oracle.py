"""DuckDB SQL that checks the registered queries."""

from __future__ import annotations


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op6_minhash_near_dedup"] = r"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT r, doc_id, array_to_string(w[i:i + 3], ' ') AS s
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT r, doc_id, count(*) AS n FROM shingles GROUP BY ALL),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM (SELECT p.r AS pr, q.r AS qr, count(*) AS c FROM shingles p JOIN shingles q ON p.s = q.s AND p.r <> q.r GROUP BY ALL)
    JOIN sizes a ON a.r = pr JOIN sizes b ON b.r = qr
    WHERE 100 * c >= 80 * (a.n + b.n - c)),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, t.doc_id = component_id AS kept
FROM texts t LEFT JOIN sizes s USING (r) JOIN least ON least.x = t.doc_id
"""

ORACLE_SQL["op10_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, w[i:i + 9] AS win, least(len(w), 10) AS size
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
runs AS (
    SELECT doc_id, i, size, w[i:i + size - 1] AS win
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT doc_id, i, runs.size, item_id FROM runs JOIN windows ON runs.win = windows.win AND runs.size = windows.size),
hits AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE_SQL["op5_kd_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""

ORACLE_SQL["op7_chat_windows"] = r"""
WITH told AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
counted AS (
    SELECT *, len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r]')) + 4 AS tokens,
        23 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;')) + 1
            + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) AS chars
    FROM told),
placed AS (
    SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
        ROWS UNBOUNDED PRECEDING) - tokens AS begins
    FROM counted),
systems AS (
    SELECT conv_id, min(begins) AS s_begins, arg_min(tokens, begins) AS s_tokens, arg_min(chars, begins) AS s_chars
    FROM placed WHERE role = 'system' GROUP BY conv_id),
spans AS (
    SELECT p.*, s_begins, s_chars, greatest((1024 - 192 - coalesce(s_tokens, 0)) // 2, 192) AS span
    FROM placed p LEFT JOIN systems USING (conv_id)),
parts AS (SELECT *, begins // span AS block, tokens > span AS alone FROM spans),
windows AS (
    SELECT conv_id, block, alone, min(begins) AS window_begins, sum(chars) AS own, any_value(s_begins) AS s_begins,
        any_value(s_chars) AS s_chars
    FROM parts GROUP BY conv_id, block, alone),
repeats AS (
    SELECT w.conv_id, w.block, w.alone, sum(p.chars) AS again
    FROM windows w JOIN parts p ON p.conv_id = w.conv_id AND p.block BETWEEN w.block - 1 AND w.block
        AND p.begins < w.window_begins AND p.begins >= w.window_begins - 192
        AND p.begins IS DISTINCT FROM w.s_begins
    GROUP BY ALL),
sizes AS (
    SELECT conv_id, sum(own + coalesce(again, 0) + CASE WHEN s_begins < window_begins THEN s_chars ELSE 0 END)::BIGINT
        AS formatted_chars
    FROM windows LEFT JOIN repeats USING (conv_id, block, alone) GROUP BY conv_id),
digests AS (
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY begins)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY begins) FILTER (role = 'assistant'), '') AS learnt
    FROM placed GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars
FROM digests JOIN sizes USING (conv_id)
"""

ORACLE_SQL["op11_fill_in_middle"] = r"""
WITH told AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
    FROM documents),
drawn AS (
    SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM told),
cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
             THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
pieces AS (
    SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS prefix,
        coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
        coalesce(array_to_string(units[high + 1:], ''), '') AS suffix
    FROM cut)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM pieces
"""

ORACLE_SQL["op12_hyperplane_dedup"] = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
fine AS (
    SELECT * FROM v
    WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.r AS ar, a.vec_id AS x, b.vec_id AS y
    FROM fine a JOIN fine b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
    SELECT vec_id AS x, vec_id AS y FROM v
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT ar, count(*) AS n FROM links GROUP BY ar)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v LEFT JOIN counts ON counts.ar = v.r JOIN least ON least.x = v.vec_id
"""
