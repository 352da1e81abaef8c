"""The results of registered queries as plain DuckDB SQL on the given tables."""

from __future__ import annotations

from .urls import DAMPING, ROUNDS, RULES, THRESHOLD

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


# Smallest node reachable from each node over ``links (x, y)``, which hold both directions.
_REACH = """
reach AS (SELECT node, node AS root FROM nodes
          UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.node),
named AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)"""

_URL_FILTER_HEAD = f"""
parts AS (
  SELECT page_id, html, {_lower("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages)"""


def _url_filter() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    cases = []
    for kind, name in ordered:
        domain, _, rest = name.partition("/")
        cases.append((f"WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{rest}')", name, kind))
    rule = "CASE " + " ".join(f"{c} THEN '{n}'" for c, n, _ in cases) + " END"
    kind = "CASE " + " ".join(f"{c} THEN '{k}'" for c, _, k in cases) + " END"
    steps = [_URL_FILTER_HEAD, f"ruled AS (SELECT *, {rule} AS rule, {kind} AS kind FROM parts)", """
found AS (
  SELECT host AS src, unnest(regexp_extract_all(html, '(?is)\\b(?:href|src)\\s*=\\s*["'']?\\s*((?:[a-z][a-z0-9+.-]*:)?//[^\\s"''<>]+)', 1))
         AS link FROM ruled WHERE host <> ''),
named AS (SELECT src, """ + _lower("regexp_extract(regexp_extract(link, '(?s)//.*'), '(?s)^//([^/?#]*)', 1)") + """ AS dst FROM found),
links AS (SELECT src, dst, count(*) AS n FROM named WHERE dst <> '' AND dst <> src GROUP BY src, dst),
seeds AS (SELECT host, avg(CASE WHEN kind = 'allow' THEN 1.0 ELSE 0.0 END) AS good,
                 avg(CASE WHEN kind = 'block' THEN 1.0 ELSE 0.0 END) AS bad FROM ruled WHERE host <> '' GROUP BY host)"""]
    steps.append("shares AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM links)")
    for name, seed, src, dst, kept in (("t", "good", "src", "dst", "1"), ("d", "bad", "dst", "src", "(1 - sum(seed))")):
        steps.append(f"{name}0 AS (SELECT host, {seed} AS rank FROM seeds WHERE {seed} > 0)")
        steps += [f"""{name}{k} AS (SELECT host, sum(seed) + {kept} * {DAMPING} * sum(moved) AS rank FROM (
                SELECT s.{dst} AS host, 0.0::DOUBLE AS seed, r.rank * s.share AS moved FROM {name}{k - 1} r JOIN shares s ON s.{src} = r.host
                UNION ALL SELECT host, rank, 0.0::DOUBLE FROM {name}0) GROUP BY host)""" for k in range(1, ROUNDS + 1)]
    steps.append(f"""bad AS (SELECT d.host FROM d{ROUNDS} d LEFT JOIN t{ROUNDS} t USING (host)
                     WHERE d.rank >= {THRESHOLD} AND d.rank > coalesce(t.rank, 0))""")
    return "WITH " + ",\n".join(steps) + """
SELECT page_id, host, path, rule,
       coalesce(kind, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled"""


_NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
          ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
nodes AS (SELECT vec_id AS node FROM embeddings),""" + _REACH + """,
degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, node = component_id AS kept
FROM named LEFT JOIN degrees ON x = node"""

_JACCARD = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(""" + _lower("coalesce(text, '')") + """, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
             ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
near AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
         GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links AS (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
nodes AS (SELECT doc_id AS node FROM documents),""" + _REACH + """
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id FROM s JOIN named ON node = doc_id"""

_WORDS = "regexp_extract_all(" + _lower("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_DECONTAMINATION = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, least(13, len(ws)) AS n, unnest(list_transform(range(1, len(ws) - least(13, len(ws)) + 2),
              lambda i: array_to_string(ws[i:i + least(13, len(ws)) - 1], ' '))) AS words FROM b WHERE len(ws) > 0),
d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
dw AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n),
hits AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND array_to_string(ws[i:i + dw.n - 1], ' ') = words),
counted AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN items USING (doc_id)"""

_WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS last FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)"""

_AUDIT = """
WITH l(f, bit) AS (VALUES ('A', 16), ('B', 8), ('C', 4), ('D', 2), ('E', 1)),
orders AS (SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order, unnest([
             {'step': 1, 'own': a.bit, 'before': 0}, {'step': 2, 'own': b.bit, 'before': a.bit},
             {'step': 3, 'own': c.bit, 'before': a.bit + b.bit}, {'step': 4, 'own': d.bit, 'before': a.bit + b.bit + c.bit},
             {'step': 5, 'own': e.bit, 'before': 31 - e.bit}]) AS s
           FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
             AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
d AS (SELECT doc_id, part, CASE WHEN len(ws) < 200 THEN 16 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 8 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 2 ELSE 0 END
             + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 1 ELSE 0 END AS cell FROM t),
g AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, cell, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM d LEFT JOIN g USING (doc_id) GROUP BY part, cell),
r AS (SELECT part, filter_order, s.step AS step, s.own AS own,
             sum(CASE WHEN cell & (s.own | s.before) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN cell & s.own > 0 AND cell & s.before = 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN cell & s.own > 0 AND cell & s.before > 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN cell = s.own THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN cell & s.own > 0 AND cell & s.before = 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN cell & s.own > 0 AND cell & s.before = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, orders GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r"""

_PASSAGES = """
WITH d AS (SELECT doc_id, row_number() OVER () AS nr, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT nr, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS words FROM (
        SELECT nr, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13)),
lost AS (SELECT nr, i FROM (SELECT nr, doc_id, i, min(doc_id) OVER (PARTITION BY words) AS first FROM w) WHERE first < doc_id),
gone AS (SELECT DISTINCT nr, p FROM (SELECT nr, unnest(range(i, i + 13)) AS p FROM lost)),
said AS (SELECT nr, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM d),
kept AS (SELECT nr, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n FROM said ANTI JOIN gone USING (nr, p) GROUP BY nr)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (nr)"""

ORACLES: dict[str, str] = {
    "op4_url_filter": _url_filter(),
    "op5_embedding_near_dedup": _NEAR_VECTORS,
    "op8_warc": _WARC,
    "op9_decontamination": _DECONTAMINATION,
    "op10_jaccard_join": _JACCARD,
    "op12_filter_audit": _AUDIT,
    "op13_substring_dedup": _PASSAGES,
}
