"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# smallest node reachable over links(a, b), both directions in the table
_REACH = """
reach AS (
  SELECT node, node AS other FROM nodes
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
roots AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""

OP1 = f"""WITH RECURSIVE
vectors AS (
  SELECT vec_id AS node, CAST(embedding AS DOUBLE[]) AS e,
         embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fine
  FROM embeddings),
nodes AS (SELECT node FROM vectors),
links AS (
  SELECT a.node AS a, b.node AS b FROM vectors a JOIN vectors b
  ON a.node <> b.node AND a.fine AND b.fine AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
{_REACH}
SELECT r.node AS vec_id, count(l.a) AS n_links, r.component_id, r.node = r.component_id AS kept
FROM roots r LEFT JOIN links l ON r.node = l.a GROUP BY r.node, r.component_id"""

OP6 = f"""WITH RECURSIVE
read AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM read),
kinds AS (SELECT min(doc_id) AS node, len(s) AS n, list_sort(s) AS s FROM sets GROUP BY list_sort(s), len(s), CASE WHEN len(s) = 0 THEN doc_id END),
nodes AS (SELECT node FROM kinds),
grams AS (SELECT node, n, unnest(s) AS g FROM kinds),
links AS (
  SELECT a.node AS a, b.node AS b FROM grams a JOIN grams b ON a.g = b.g AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
{_REACH}
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets d JOIN kinds k ON list_sort(d.s) = k.s AND (len(d.s) > 0 OR d.doc_id = k.node) JOIN roots r ON r.node = k.node"""


def _url_sql(order: int = 4) -> str:
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = _LOWER.format(f"coalesce(regexp_extract(url, '{whole}', 1), '')")
    path = f"coalesce(regexp_extract(url, '{whole}', 2), '')"
    rules = [  # longest first
        ("www.example.com", "/en/", "allow"),
        ("example.com", "/en/", "block"),
        ("net", "/es/", "block"),
        ("net", "/fr/", "block"),
        ("com", "/", "allow"),
    ]
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in rules) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in rules) + " END"
    steps = ["p0 AS (SELECT g, 1.0::DOUBLE / (SELECT count(DISTINCT right(g, 1)) FROM counted) AS pa, 1.0::DOUBLE / (SELECT count(DISTINCT right(g, 1)) FROM counted) AS pb FROM counted)"]
    for k in range(order + 1):
        mixed = lambda p, n, t, c: f"CASE WHEN {t} > 0 THEN ({n} + {c} * {p}) / ({t} + {c}) ELSE {p} END"
        steps.append(f"""
s{k} AS (SELECT right(g, {k + 1}) AS tail, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b FROM counted GROUP BY 1),
c{k} AS (SELECT left(tail, {k}) AS head, sum(a) AS ta, sum(b) AS tb, count(*) FILTER (a > 0) AS ka, count(*) FILTER (b > 0) AS kb FROM s{k} GROUP BY 1),
p{k + 1} AS (
  SELECT g, {mixed("pa", "s.a", "ta", "ka")} AS pa, {mixed("pb", "s.b", "tb", "kb")} AS pb
  FROM p{k} p JOIN s{k} s ON right(p.g, {k + 1}) = s.tail JOIN c{k} c ON left(s.tail, {k}) = c.head)""")
    return f"""WITH
parts AS (SELECT page_id, url, {host} AS host, {path} AS path FROM pages),
judged AS (SELECT *, {rule} AS rule, {verdict} AS by_rule FROM parts),
urls AS (
  SELECT DISTINCT url, by_rule, repeat(chr(2), {order}) || {_LOWER.format("regexp_replace(url, '(?s)^.*?://', '')")} || chr(3) AS body
  FROM judged WHERE url IS NOT NULL),
grams AS (
  SELECT url, by_rule, substring(body, i, {order + 1}) AS g
  FROM (SELECT url, by_rule, body, unnest(range(1, length(body) - {order} + 1)) AS i FROM urls)),
counted AS (SELECT g, count(*) FILTER (by_rule = 'allow') AS a, count(*) FILTER (by_rule = 'block') AS b FROM grams GROUP BY g),
{",".join(steps)},
means AS (SELECT url, any_value(by_rule) AS by_rule, avg(ln(pa) - ln(pb)) AS mean FROM grams JOIN p{order + 1} USING (g) GROUP BY url),
classes AS (
  SELECT avg(mean) FILTER (by_rule = 'allow') AS ma, stddev_pop(mean) FILTER (by_rule = 'allow') AS sa,
         avg(mean) FILTER (by_rule = 'block') AS mb, stddev_pop(mean) FILTER (by_rule = 'block') AS sb FROM means),
scored AS (
  SELECT url, mean - CASE WHEN sa + sb > 0 THEN (ma * sb + mb * sa) / (sa + sb) ELSE (ma + mb) / 2 END AS llr FROM means, classes)
SELECT page_id, host, path, rule,
       coalesce(by_rule, CASE WHEN llr <= 0 THEN 'block' ELSE 'allow' END) AS verdict, round(llr, 6) AS llr
FROM judged LEFT JOIN scored USING (url)"""


OP11 = """WITH
drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8) AS BIGINT)) AS h
  FROM documents),
cut AS (
  SELECT doc_id, text, units, len(units) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a,
         greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(units[1:a], ''), '') AS p,
         coalesce(array_to_string(units[a + 1:b], ''), '') AS m, coalesce(array_to_string(units[b + 1:], ''), '') AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
FROM parts"""

OP13 = f"""WITH
texts AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
runs AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM runs GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM runs, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
counts AS (SELECT lang, phrase, k AS words, count(*) AS f FROM grams GROUP BY lang, phrase, k),
cand AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words >= 2 AND f >= 30),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score
  FROM cuts c JOIN counts x ON c.lang = x.lang AND c.head = x.phrase JOIN counts y ON c.lang = y.lang AND c.rest = y.phrase),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, a, size, w, unnest(range(1, words - size + 2)) AS i
  FROM (SELECT *, unnest(range(2, words)) AS size FROM cand WHERE words >= 3)),
covers AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS cover FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN (SELECT lang, phrase, max(cover) AS cover FROM covers GROUP BY lang, phrase) c
  ON s.lang = c.lang AND s.phrase = c.phrase WHERE cover IS NULL OR 100::HUGEINT * cover < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT k.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked k JOIN totals t ON k.lang = t.lang WHERE rank <= 2000"""

ORACLE: dict[str, str] = {
    "op1_near_vectors": OP1,
    "op2_url_filter": _url_sql(),
    "op6_ngram_join": OP6,
    "op11_infill": OP11,
    "op13_collocations": OP13,
}
