"""DuckDB statements of the queries that SQL can express on whole tables."""

from __future__ import annotations

_URLS = r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), places AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
  SELECT host, path, max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, v := verdict)) AS won
  FROM (SELECT DISTINCT host, path FROM places) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, host, path, won.rule AS rule, coalesce(won.v, 'allow') AS verdict
FROM places LEFT JOIN fits USING (host, path)
"""



_DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), occurring AS (
  SELECT lang, source, doc, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS whole FROM occurring GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), sides AS (
  SELECT DISTINCT lang, source FROM d
), vocabulary AS (
  SELECT lang, count(*) AS v, sum(whole) AS lang_total FROM kept GROUP BY lang
), here AS (
  SELECT lang, source, term, count(*) AS n FROM occurring JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
  SELECT lang, source, sum(n) AS total FROM here GROUP BY lang, source
), grid AS (
  SELECT s.lang, s.source, k.term, coalesce(h.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(h.n, 0) + 2) // (coalesce(t.total, 0) + 2 * v.v) AS p,
    1 + 1000000000::HUGEINT * (k.whole + 2) // (v.lang_total + 2 * v.v) AS q
  FROM sides s JOIN kept k USING (lang) JOIN vocabulary v USING (lang)
    LEFT JOIN totals t ON t.lang = s.lang AND t.source = s.source
    LEFT JOIN here h ON h.lang = s.lang AND h.source = s.source AND h.term = k.term
), compared AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(c.value, 0)::BIGINT AS value
  FROM sides a JOIN sides b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN compared c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM grid WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def _clusters(clusters: int = 8, rounds: int = 10, size: int = 64) -> str:
    """k-means over whole numbers, a step of the statement for each round."""
    steps = [
        f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS c
  FROM embeddings
  WHERE len(embedding) = {size} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {size}
), x AS MATERIALIZED (
  SELECT row, unnest(c) AS value, unnest(range({size})) AS d FROM v
), named AS (
  SELECT row, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, c) - 1 AS k FROM v
), c0 AS MATERIALIZED (
  SELECT k, d, value FROM named JOIN x USING (row) WHERE k < {clusters}
)"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (
  SELECT row, min_by(k, (distance, k)) AS k, min(distance) AS distance
  FROM (SELECT row, k, sum((x.value - c.value) * (x.value - c.value)) AS distance
        FROM x JOIN c{n} c USING (d) GROUP BY row, k)
  GROUP BY row
)"""
        )
        if n < rounds:
            steps.append(
                f"""c{n + 1} AS MATERIALIZED (
  SELECT c.k, c.d, coalesce(m.value, c.value) AS value
  FROM c{n} c LEFT JOIN (
    SELECT k, d, CASE WHEN sum(value) < 0 THEN -((count(*) - 1 - sum(value)) // count(*)) ELSE sum(value) // count(*) END AS value
    FROM a{n} JOIN x USING (row) GROUP BY k, d
  ) m ON m.k = c.k AND m.d = c.d
)"""
            )
    return (
        ", ".join(steps)
        + f""", names AS (
  SELECT k, sha256(string_agg(value::BIGINT::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k
)
SELECT vec_id, k::INTEGER AS cluster, distance::BIGINT AS distance,
  (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  centroid_sha256
FROM a{rounds} JOIN v USING (row) JOIN names USING (k)
"""
    )


#: Kind, expression, least characters, expression of what does not count towards them.
_SECRETS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 8,
     r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""),
    ("access", r"AKIA[A-Z0-9]+", 16, None),
    ("hex", r"[0-9a-f]+", 32, None),
    ("github", r"gh[opsur]_[A-Za-z0-9]+", 40, None),
    ("google", r"AIza[A-Za-z0-9_-]+", 39, None),
    ("slack", r"xox[abeprs]-[A-Za-z0-9-]+", 20, None),
    ("stripe", r"[rs]k_live_[A-Za-z0-9]+", 24, None),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40, None),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, None),
    ("bearer", r"(?i:bearer) +[A-Za-z0-9+/_.=~-]+", 20, r"^(?i:bearer) +"),
]


def _secrets() -> str:
    """Places of matches are the summed lengths of what comes before them."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    kinds = []
    for order, (kind, pattern, least, head) in enumerate(_SECRETS):
        after = f"regexp_replace(m, {quoted(head)}, '')" if head else "m"
        kinds.append(
            f"""
  SELECT row, {order} AS o, '{kind}' AS kind, place AS start, place + length(m) AS stop
  FROM (SELECT row, m, sum(length(gap)) OVER w + coalesce(sum(length(m)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
        FROM (SELECT row, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap
              FROM (SELECT row, regexp_extract_all(text, {quoted(pattern)}) AS ms,
                      string_split_regex(text, {quoted(pattern)}) AS gaps
                    FROM d WHERE regexp_matches(text, {quoted(pattern)})))
        WINDOW w AS (PARTITION BY row ORDER BY i))
  WHERE length({after}) >= {least}"""
        )
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(kinds)}),
lists AS (
  SELECT row,
    count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < 3), '') AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN lists USING (row)
"""


def statements() -> dict[str, str]:
    return {
        "op5_url_filters": _URLS,
        "op11_source_divergence": _DIVERGENCE,
        "op12_centroid_clustering": _clusters(),
        "op13_secret_scan": _secrets(),
    }
