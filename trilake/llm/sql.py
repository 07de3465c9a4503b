"""DuckDB twins of the contract queries that SQL can express.

None for the queries that need a tokenizer, CRC-32 or XXH64 of texts, a trained model, a
parsed page tree or graph search; the tests hold those against brute force.
"""

from .license_scan import template_list

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _strength(level: str) -> str:
    """Prior strength of a level (n, bad, m) by moments, within 1 and 1000."""
    return (f"(SELECT CASE WHEN room > 0 AND over > 0 THEN least(greatest(room / over - 1, 1.0), 1000.0) ELSE 1000.0 END FROM ("
            f"SELECT sum(n * (bad / n - m) * (bad / n - m) - m * (1 - m)) AS over, sum(m * (1 - m) * (n - 1)) AS room "
            f"FROM {level} WHERE n > 0) f)")


OP1 = f"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
label AS (SELECT doc_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
hosts AS (SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad,
                 CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in', 'co.nz') THEN two ELSE one END AS suffix,
                 CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in', 'co.nz') THEN three ELSE two END AS domain
          FROM (SELECT p.host, l.bad, regexp_extract(p.host, '([^.]*)$', 1) AS one, regexp_extract(p.host, '((?:[^.]*\\.)?[^.]*)$', 1) AS two,
                       regexp_extract(p.host, '((?:[^.]*\\.)?(?:[^.]*\\.)?[^.]*)$', 1) AS three
                FROM parts p LEFT JOIN label l ON p.page_id = l.doc_id) x GROUP BY ALL),
l1 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0.5) FROM hosts) AS m FROM hosts GROUP BY suffix),
s1 AS (SELECT suffix, (bad + {_strength('l1')} * m) / (n + {_strength('l1')}) AS m FROM l1),
l2 AS (SELECT d.suffix, d.domain, d.n, d.bad, s1.m FROM (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL) d JOIN s1 USING (suffix)),
s2 AS (SELECT domain, (bad + {_strength('l2')} * m) / (n + {_strength('l2')}) AS m FROM l2),
l3 AS (SELECT h.host, h.n, h.bad, s2.m FROM hosts h JOIN s2 USING (domain)),
post AS (SELECT host, (bad + k * m) / (n + k) AS mean, n + k AS s FROM (SELECT *, {_strength('l3')} AS k FROM l3) y),
judged AS (SELECT p.page_id, p.host, p.path, CASE WHEN mean + 1.645 * sqrt(mean * (1 - mean) / (s + 1)) <= 0.5 THEN 'allow' ELSE 'block' END AS own,
                  CASE WHEN (p.host = 'example.net' OR p.host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                       WHEN (p.host = 'example.com' OR p.host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                       WHEN (p.host = 'org' OR p.host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                       WHEN (p.host = 'net' OR p.host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
           FROM parts p JOIN post USING (host))
SELECT page_id, host, path, rule,
       CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' WHEN 'example.com/de/' THEN 'block' WHEN 'net/' THEN 'block' ELSE own END AS verdict
FROM judged"""

_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP4 = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS words
        FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0) t),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
size AS (SELECT DISTINCT n FROM win),
spot AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS words
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size) t),
hit AS (SELECT s.doc_id, s.n, s.i, win.item_id FROM spot s JOIN win ON s.n = win.n AND s.words = win.words),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit) t GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) t GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

def _template_rows() -> str:
    """The license templates as rows (t, label, exact, n, need, words)."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    return ", ".join(f"({x['t']}, '{x['label']}', {x['exact']}, {x['n']}, {x['need']}, {quoted(x['words'])})" for x in template_list())


OP11 = f"""
WITH template(t, label, exact, n, need, tw) AS (VALUES {_template_rows()}),
gram AS (SELECT t, n, i - 1 AS tpos, list_slice(tw, i, i + n - 1) AS words
         FROM (SELECT t, n, tw, unnest(range(1, len(tw) - n + 2)) AS i FROM template) x),
doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT r, n, i - 1 AS pos, list_slice(w, i, i + n - 1) AS words
          FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM template) s) x),
vote AS MATERIALIZED (SELECT r, t, pos - tpos AS diag, tpos FROM place JOIN gram ON place.n = gram.n AND place.words = gram.words),
base AS (SELECT r, t, diag FROM vote JOIN template USING (t) WHERE exact GROUP BY r, t, diag, need HAVING count(*) = need),
band AS (SELECT b.r, b.t, b.diag, count(*) AS votes, list_distinct(flatten(list(range(v.tpos, v.tpos + n)))) AS covered
         FROM (SELECT DISTINCT r, t, diag FROM vote) b JOIN template USING (t)
         JOIN vote v ON v.r = b.r AND v.t = b.t AND v.diag BETWEEN b.diag AND b.diag + 3 WHERE NOT exact GROUP BY b.r, b.t, b.diag),
span AS (SELECT r, label, len(covered) / CAST(len(tw) AS DOUBLE) AS share FROM band JOIN template USING (t)
         WHERE votes >= need AND len(covered) / CAST(len(tw) AS DOUBLE) >= 0.8),
first AS (SELECT r, count(*) AS n_base, min(diag) AS first_word, max(diag) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM base JOIN template USING (t) GROUP BY r),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
          FROM (SELECT r, label, share FROM span UNION ALL SELECT r, label, 1.0 FROM base JOIN template USING (t)) x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(first.labels, '') AS base_labels,
       coalesce(every.labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM doc LEFT JOIN first USING (r) LEFT JOIN every USING (r)"""


def _clustering(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Three rounds of exact integer k-means, a pair of subqueries each."""
    far = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    out = [f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, x FROM kept
    QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= {k})"""]
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (SELECT r, vec_id, v.x, c, {far} AS d FROM kept v, c{i} c
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < rounds:
            out.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(n.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT c, list(CAST(floor_div AS BIGINT) ORDER BY j) AS x FROM (SELECT c, j, (s - ((s % n) + n) % n) // n AS floor_div
        FROM (SELECT c, j, sum(x[j]) AS s, count(*) AS n FROM a{i}, range(1, {dims + 1}) t(j) GROUP BY c, j) y) z GROUP BY c) n USING (c))""")
    return ",\n".join(out) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} k ON a.c = k.c"""


OP12 = _clustering()

OP13 = f"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
total AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM doc),
item AS MATERIALIZED (SELECT row_number() OVER () AS i, item_id, list_distinct({_WORDS}) AS w FROM benchmark),
ask AS MATERIALIZED (SELECT i, unnest(w) AS term FROM item),
term AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM doc) t WHERE term IN (SELECT term FROM ask) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS wt FROM term, total GROUP BY term),
score AS (SELECT i, r, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.w) * docs) // words)))) AS BIGINT) AS score
          FROM ask JOIN term USING (term) JOIN weight USING (term) JOIN doc d USING (r), total GROUP BY i, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
      FROM score JOIN item USING (i) JOIN doc USING (r) WHERE score > 0) t
WHERE rank <= 10"""

ORACLES = {"op1_url_reputation": OP1, "op4_decontaminate": OP4, "op11_license_scan": OP11, "op12_heap_clusters": OP12,
           "op13_lexical_search": OP13}
