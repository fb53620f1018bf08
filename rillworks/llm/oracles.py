"""Results stated in SQL, where SQL can state them."""

from __future__ import annotations

_RUNS = "[A-Za-z0-9+/_=-]{20,}"
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _kind(order: int, kind: str, pattern: str, group: int, passes: str) -> str:
    return f"""
      SELECT doc_id, owner, language, {order} AS ord, '{kind}' AS kind, v, s,
             sum(g + s) OVER (PARTITION BY doc_id ORDER BY i) AS stop
      FROM (SELECT doc_id, owner, language,
                   unnest(regexp_extract_all(text, '{pattern}', {group})) AS v,
                   unnest(list_transform(regexp_extract_all(text, '{pattern}', 0), lambda x: length(x))) AS s,
                   unnest(list_transform(string_split_regex(text, '{pattern}')[:-2], lambda x: length(x))) AS g,
                   generate_subscripts(regexp_extract_all(text, '{pattern}', 0), 1) AS i
            FROM d WHERE regexp_matches(text, '{pattern}'))
      QUALIFY {passes}"""


_SECRETS = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, coalesce(lang, '') AS language
  FROM documents),
hits AS (
  {_kind(1, "assign", _ASSIGN, 2, "length(v) >= 8")}
  UNION ALL {_kind(2, "access", "AKIA[A-Z0-9]+", 0, "s >= 16")}
  UNION ALL {_kind(3, "hex", "[0-9a-f]+", 0, "s >= 32")}
  UNION ALL {_kind(4, "bare", _RUNS, 0, "regexp_matches(v, '[0-9]')")}),
own AS (
  SELECT v, count(DISTINCT owner) AS n_owners, count(DISTINCT (owner, language)) AS n_repositories
  FROM hits GROUP BY v),
spans AS (
  SELECT h.doc_id, ord, kind, CAST(stop - s AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop,
         n_repositories, n_owners > 2 OR n_repositories > 4 AS copied,
         n_owners <= 2 AND n_repositories <= 4 AND len(list_distinct(string_split(h.v, ''))) >= 10 AS specific
  FROM hits h JOIN own USING (v)),
kept AS (
  SELECT *, kind || ':' || start || ':' || stop AS name FROM spans a
  WHERE ord <= 3 OR (specific AND NOT EXISTS (
    SELECT 1 FROM spans b
    WHERE b.doc_id = a.doc_id AND b.ord <= 3 AND b.start < a.stop AND b.stop > a.start)))
SELECT d.doc_id,
       count(*) FILTER (ord = 1) AS n_assign,
       count(*) FILTER (ord = 2) AS n_access,
       count(*) FILTER (ord = 3) AS n_hex,
       sha256(coalesce(string_agg(name, ',' ORDER BY start, ord) FILTER (ord <= 3), '')) AS base_sha256,
       coalesce(string_agg(name, ',' ORDER BY start, ord), '') AS spans,
       count(*) FILTER (specific) AS n_owner_specific,
       count(*) FILTER (copied) AS n_widely_copied,
       coalesce(max(n_repositories), 0) AS most_repositories
FROM d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id
"""

_COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
  SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS k)
  WHERE len(w) >= k),
f AS (
  SELECT lang, w[i:i + k - 1] AS p, k, count(*) AS a FROM runs GROUP BY ALL),
total AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (
  SELECT * FROM f WHERE k >= 2 AND a >= 30),
inner_parts AS (
  SELECT lang, p[x:x + m - 1] AS p, max(a) AS longer
  FROM (SELECT lang, p, k, a, m, unnest(generate_series(1, k - m + 1)) AS x
        FROM cand, (SELECT unnest([2, 3]) AS m) WHERE m < k)
  GROUP BY ALL),
cuts AS (
  SELECT lang, p, a, unnest(generate_series(1, k - 1)) AS c
  FROM cand LEFT JOIN inner_parts USING (lang, p)
  WHERE longer IS NULL OR CAST(longer AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80),
scored AS (
  SELECT cuts.lang, cuts.p, cuts.a, l.a AS l, r.a AS r,
         CAST((CAST(cuts.a AS HUGEINT) * 2000000) // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.p = cuts.p[:c]
            JOIN f r ON r.lang = cuts.lang AND r.p = cuts.p[c + 1:]
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.p ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM (SELECT *, array_to_string(p, ' ') AS phrase FROM scored) JOIN total USING (lang)
QUALIFY rank <= 2000
"""

_SOURCE_MIX = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 13) AS BIGINT) AS ticket
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER poorer, 0))::DOUBLE
            / (sum(w) OVER () - coalesce(sum(w) OVER poorer, 0)) AS level
  FROM src
  WINDOW poorer AS (ORDER BY source_size / w, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (
  SELECT min(level) AS level FROM (
    SELECT level FROM levels WHERE level * w <= 3 * source_size ORDER BY source_size / w, source NULLS LAST LIMIT 1)),
tgt AS (
  SELECT source, source_size,
         CASE WHEN 3 * source_size < water.level * w THEN CAST(3 * source_size AS DOUBLE) ELSE water.level * w END AS target
  FROM src, water),
cls AS (
  SELECT source, length(bin(size)) AS digits, CAST(sum(size) AS BIGINT) AS words, any_value(target) AS target
  FROM d JOIN tgt USING (source) WHERE size > 0 GROUP BY source, digits),
tried AS (
  SELECT *, (target - 3 * coalesce(sum(words) OVER above, 0)::BIGINT)
            / (sum(digits * words) OVER (PARTITION BY source) - coalesce(sum(digits * words) OVER above, 0))::BIGINT AS lv
  FROM cls
  WINDOW above AS (PARTITION BY source ORDER BY digits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
top AS (
  SELECT source, max(digits) AS d0, max_by(lv, digits) AS lv0 FROM tried WHERE lv * digits <= 3 GROUP BY source),
cop AS (
  SELECT source, digits, words, floor(c)::BIGINT AS whole, c - floor(c) AS part
  FROM (SELECT tried.*, CASE WHEN digits <= d0 THEN lv0 * digits ELSE 3.0::DOUBLE END AS c
        FROM tried LEFT JOIN top USING (source))),
bud AS (
  SELECT tgt.*, target - coalesce(c, 0)::BIGINT AS budget
  FROM tgt LEFT JOIN (SELECT source, sum(whole * words) AS c FROM cop GROUP BY source) USING (source)),
ranked AS (
  SELECT d.*, bud.source_size, bud.target, bud.budget, whole, CASE WHEN part > 0 THEN part END AS part,
         (ticket + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM d JOIN bud USING (source) LEFT JOIN cop ON cop.source = d.source AND cop.digits = length(bin(d.size))
       AND d.size > 0),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, ticket ROWS UNBOUNDED PRECEDING) AS reached
  FROM (SELECT *, coalesce(u * (1 - part) / ((1 - u) * part), 'inf'::DOUBLE) AS q FROM ranked)),
drawn AS (
  SELECT *, part IS NOT NULL AND reached <= budget AS chosen FROM summed),
gap0 AS (
  SELECT source, any_value(budget) - coalesce(sum(size) FILTER (chosen), 0)::BIGINT AS gap FROM drawn GROUP BY source),
fill0 AS (
  SELECT source, gap, -1 AS row FROM gap0),
FILLS
SELECT doc_id, size, source_size, target, copies * size AS taken, copies
FROM (SELECT *, coalesce(whole, 0) + CASE WHEN chosen OR doc_id IN (SELECT row FROM fills) THEN 1 ELSE 0 END AS copies FROM drawn)
"""

_FILL = """
fill{k} AS (
  SELECT drawn.source, gap - size AS gap, doc_id AS row
  FROM drawn JOIN fill{j} f ON f.source = drawn.source
  WHERE NOT chosen AND part IS NOT NULL AND size < 2 * gap AND doc_id NOT IN ({before})
  QUALIFY row_number() OVER (PARTITION BY drawn.source ORDER BY abs(gap - size), q, ticket) = 1),"""
_ADDED = [f"SELECT row FROM fill{k}" for k in range(5)]
_SOURCE_MIX = _SOURCE_MIX.replace(
    "FILLS",
    "".join(_FILL.format(k=k, j=k - 1, before=" UNION ALL ".join(_ADDED[:k])) for k in range(1, 5)).strip()
    + f"\nfills AS ({' UNION ALL '.join(_ADDED)})",
)

ORACLES: dict[str, str] = {
    "op12_source_mix": _SOURCE_MIX,
    "op8_secrets": _SECRETS,
    "op11_collocations": _COLLOCATIONS,
}
