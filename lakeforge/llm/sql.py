"""DuckDB statements of the queries whose results SQL can state."""

from __future__ import annotations

# A word; the weights of the production mix as rows.
WORD = "[^\\x20\\x09-\\x0D]+"
_WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"


def _split(children: str, parent: str, child: str) -> str:
    """Water-filling of one level: rows of ``children`` with share."""
    return f"""
    (WITH r0 AS (SELECT *, CASE WHEN weight > 0 THEN cap0 ELSE 0 END AS cap, greatest(weight, 1) AS w FROM {children}),
     r1 AS (SELECT *, least(budget0, sum(cap) OVER (PARTITION BY {parent})) AS budget FROM r0),
     r2 AS (SELECT *, sum(cap) OVER o - cap AS before, sum(w) OVER (PARTITION BY {parent}) - sum(w) OVER o + w AS open FROM r1
            WINDOW o AS (PARTITION BY {parent} ORDER BY cap / w, {child} ROWS UNBOUNDED PRECEDING)),
     r3 AS (SELECT *, cap::HUGEINT * open <= w::HUGEINT * (budget - before) AS is_full FROM r2),
     r4 AS (SELECT *, budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (PARTITION BY {parent}), 0) AS rest, CASE WHEN is_full THEN 0 ELSE w END AS own FROM r3),
     r5 AS (SELECT *, sum(own) OVER (PARTITION BY {parent}) AS all_open, sum(own) OVER (PARTITION BY {parent} ORDER BY cap / w, {child} ROWS UNBOUNDED PRECEDING) AS upto FROM r4)
     SELECT *, CASE WHEN is_full THEN cap ELSE (rest::HUGEINT * upto) // all_open - (rest::HUGEINT * (upto - own)) // all_open END::BIGINT AS share FROM r5)"""


OP1 = f"""
WITH tokens AS (
  SELECT doc_id, CASE coalesce(try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT), 0) % 4 WHEN 1 THEN 'books' WHEN 2 THEN 'code' WHEN 3 THEN 'reference' ELSE 'web' END AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source, len({_WORDS})::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS total, sum(n_tokens)::BIGINT * 3 AS cap0 FROM tokens GROUP BY ALL HAVING sum(n_tokens) > 0),
d0 AS (SELECT 0 AS root, domain, sum(cap0)::BIGINT AS cap0, CASE domain WHEN 'web' THEN 4 WHEN 'books' THEN 3 WHEN 'code' THEN 1 WHEN 'reference' THEN 2 ELSE 1 END AS weight,
         (SELECT (sum(total) * 75 // 100)::BIGINT FROM leaves) AS budget0 FROM leaves GROUP BY domain),
d1 AS {_split('d0', 'root', 'domain')},
l0 AS (SELECT domain, lang, sum(cap0)::BIGINT AS cap0, CASE WHEN domain = 'web' AND lang = 'en' THEN 5 WHEN domain = 'books' AND lang = 'en' THEN 3 ELSE 1 END AS weight,
         any_value(share) AS budget0 FROM leaves JOIN (SELECT domain, share FROM d1) USING (domain) GROUP BY domain, lang),
l1 AS {_split('l0', 'domain', 'lang')},
s0 AS (SELECT domain, lang, source, total, cap0, CASE WHEN domain = 'web' AND lang = 'en' AND source = 'src0' THEN 2 ELSE 1 END AS weight, share AS budget0
         FROM leaves JOIN (SELECT domain, lang, share FROM l1) USING (domain, lang)),
s1 AS {_split('s0', 'domain, lang', 'source')},
plan AS (SELECT domain, lang, source, share // total AS whole, share % total AS rest FROM s1 WHERE share > 0),
r AS (SELECT * FROM tokens JOIN plan USING (domain, lang, source) WHERE n_tokens > 0),
last AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5(concat_ws(':', 'mix-1', whole::VARCHAR, doc_id::VARCHAR)), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS upto FROM r WHERE rest > 0)
SELECT doc_id, domain, lang, source, e.epoch::BIGINT AS epoch, n_tokens, n_tokens AS take_tokens FROM r, LATERAL (SELECT unnest(range(whole)) AS epoch) e
UNION ALL
SELECT doc_id, domain, lang, source, whole::BIGINT, n_tokens, least(n_tokens, rest - upto + n_tokens)::BIGINT FROM last WHERE rest - upto + n_tokens > 0
"""

OP4 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS i)),
low AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
hit AS (SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i FROM win JOIN low USING (s) WHERE first < doc_id), LATERAL (SELECT unnest(range(13)) AS k)),
gone AS (SELECT doc_id, list(p) AS gone, count(*) AS n FROM hit GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM w JOIN gone USING (doc_id)) ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(gone.n, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN gone.n IS NULL THEN array_to_string(w.w, ' ') ELSE coalesce(kept.kept, '') END) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT page_id, url,
  translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT page_id, host, path, rhost || rpath AS rule, rverdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM h JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.rverdict, 'allow') AS verdict
FROM h LEFT JOIN m ON h.page_id = m.page_id AND h.host = m.host AND h.path = m.path AND m.k = 1
"""

OP6 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY text)
SELECT doc_id, keep_id, n::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM t JOIN g USING (text)
"""

OP9 = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS s FROM d, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
twice AS (SELECT doc_id, s FROM g GROUP BY doc_id, s HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM (SELECT doc_id, i FROM g JOIN twice USING (doc_id, s)), LATERAL (SELECT unnest(range(3)) AS k) GROUP BY doc_id),
m AS (SELECT d.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
  (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS k FROM f GROUP BY source),
mo AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v FROM h),
pr AS (SELECT m, CASE WHEN v > 0 AND m * (1 - m) / v - 1 > 0 THEN m * (1 - m) / v - 1 ELSE 10.0 END AS s FROM mo),
ver AS (SELECT source, (k + m * s) / (n + s) <= 0.5 AS host_kept FROM h, pr)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM f JOIN ver ON f.source IS NOT DISTINCT FROM ver.source
"""

OP13 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same, a.r = b.r AS own,
    list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0),
pos AS (SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same AND NOT own
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS FIRST) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM pos p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id NULLS FIRST)
QUALIFY row_number() OVER w <= 3
"""

ORACLES = {"op1_mixing": OP1, "op4_substring": OP4, "op5_url_filter": OP5, "op6_exact": OP6, "op9_host_rules": OP9, "op13_hard_negatives": OP13}
