"""SQL for the queries that SQL can express."""

from __future__ import annotations

TOP_K = """WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum([z[1] * z[2] FOR z IN list_zip(a.v, b.v)])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


PHRASES = """WITH d AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS s FROM d),
q AS (SELECT lang, row_number() OVER () AS piece, list_filter(string_split_regex(s, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
w AS (SELECT lang, piece, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM q),
o AS (SELECT lang, x, lead(x, 1) OVER v AS y, lead(x, 2) OVER v AS z, lead(x, 3) OVER v AS u FROM w WINDOW v AS (PARTITION BY piece ORDER BY i)),
g AS (SELECT lang, 1 AS m, x AS phrase FROM o UNION ALL SELECT lang, 2, x || ' ' || y FROM o WHERE y IS NOT NULL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM o WHERE z IS NOT NULL
  UNION ALL SELECT lang, 4, x || ' ' || y || ' ' || z || ' ' || u FROM o WHERE u IS NOT NULL),
f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS n FROM g GROUP BY ALL),
c AS (SELECT * FROM f WHERE m >= 2 AND n >= 30),
cut AS (SELECT c.lang, c.phrase, c.n AS a, k, array_to_string(string_split(c.phrase, ' ')[1:k], ' ') AS x,
    array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ') AS y FROM c, (VALUES (1), (2), (3)) AS v(k) WHERE k < m),
s AS (SELECT cut.lang, cut.phrase, a, k, l.n AS l, r.n AS r, (2000000 * a) // (l.n + r.n) AS score FROM cut
  JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM low WHERE NOT EXISTS (SELECT 1 FROM c q WHERE q.lang = low.lang AND 100 * q.n >= 80 * low.a
  AND q.m > len(string_split(low.phrase, ' ')) AND contains(' ' || q.phrase || ' ', ' ' || low.phrase || ' '))),
total AS (SELECT lang, sum(n) AS n FROM f WHERE m = 1 GROUP BY lang)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT kept.*, total.n, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept JOIN total USING (lang))
WHERE rank <= 2000"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Pairs by every shared shingle, then the least id that links lead to.
JACCARD = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT row, len(ws) AS c, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT row, i, c, string_agg(x, ' ') OVER (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s FROM w),
h AS (SELECT DISTINCT row, s FROM g WHERE i + 4 <= c OR (i = 1 AND c < 5)),
n AS (SELECT row, count(*) AS n FROM h GROUP BY row),
p AS (SELECT a.row AS a, b.row AS b, count(*) AS both_ FROM h a JOIN h b ON a.s = b.s AND a.row < b.row GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.row = a JOIN n y ON y.row = b WHERE 100 * both_ >= 75 * (x.n + y.n - both_)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, a AS b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.b),
least AS (SELECT reach.a AS row, min(doc_id) AS component_id FROM reach JOIN d ON d.row = reach.b GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id)::BIGINT AS component_id
FROM d LEFT JOIN n USING (row) LEFT JOIN least USING (row)"""

_WINDOWS = " UNION ALL ".join(f"""SELECT row, i, {m} AS m, string_agg(x, ' ') OVER (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND {m - 1} FOLLOWING) AS s, c
  FROM w WHERE {m} IN (SELECT m FROM items)""" for m in range(1, 14))

DECONTAMINATION = f"""WITH b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
v AS (SELECT item_id, len(ws) AS c, least(len(ws), 13) AS m, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM b),
grams AS (SELECT item_id, m, i, c, string_agg(x, ' ') OVER (PARTITION BY item_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s FROM v),
items AS (SELECT DISTINCT item_id, m, s FROM grams WHERE i + m - 1 <= c),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
w AS (SELECT row, len(ws) AS c, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM d),
runs AS (SELECT * FROM ({_WINDOWS}) WHERE i + m - 1 <= c),
hits AS (SELECT row, i, runs.m, item_id FROM runs JOIN items ON items.s = runs.s AND items.m = runs.m),
hit AS (SELECT row, count(DISTINCT at_) AS n FROM (SELECT row, unnest(range(i, i + m)) AS at_ FROM (SELECT DISTINCT row, i, m FROM hits)) GROUP BY 1),
of AS (SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM hits) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(of.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n > 0 AND 20 * hit.n >= len(ws), false) AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN of USING (row)"""

#: Lengths by the template of chat.py: a block's head and end, a mark between its texts, a backslash before each control character.
CHAT = r"""WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
o AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w IS NOT DISTINCT FROM role AS goes_on, lead(role) OVER w IS NOT DISTINCT FROM role AS more
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
m AS (SELECT *, length(text) + length(text) - length(translate(text, '\#<', '')) AS shown,
  CASE WHEN goes_on THEN 8 ELSE 6 + 2 * length(role) - length(translate(role, '\#<:' || chr(10), '')) END AS lead_,
  CASE WHEN more THEN 0 ELSE 9 END AS tail FROM o)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(lead_ + shown + tail)::BIGINT AS formatted_chars FROM m GROUP BY conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_top_k": TOP_K, "op3_jaccard_join": JACCARD, "op6_decontamination": DECONTAMINATION, "op10_chat_format": CHAT,
            "op12_phrase_mining": PHRASES}
