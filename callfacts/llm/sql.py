"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WS = r"[\x20\x09-\x0D]"

OP2 = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}+'), lambda x: x <> '') AS w,
         string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents),
win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM hit) GROUP BY r),
s AS (
  SELECT t.r, t.doc_id, t.text, t.ls, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
          - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR 10 * n_symbols > n_words
            OR 4 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
            OR 10 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 4 * word_chars
            OR 10 * n_dup_lines > 6 * len(ls)
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM s
"""


def _op6(rounds: int = 250, damping: float = 0.85) -> str:
    """Rules, then rounds of trust and distrust; after so many what is left to spread is under 1e-17 of all."""
    rules = [  # longest first: (verdict, host, path)
        ("block", "example.org", "/en/1"),
        ("block", "example.org", "/es/"),
        ("allow", "com", "/fr/"),
        ("block", "com", "/de/"),
        ("allow", "org", "/"),
    ]
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for _, h, p in rules]
    case = lambda pick: "CASE " + " ".join(f"WHEN {f} THEN '{pick(r)}'" for f, r in zip(fits, rules)) + " END"
    host = "translate(regexp_extract(coalesce(CASE WHEN instr({u}, '://') > 0 THEN substr({u}, instr({u}, '://') + 3) ELSE '' END, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = "regexp_extract(coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, ''), '^[^/?#]*([^?#]*)', 1)"
    parts = [
        f"judged AS (SELECT page_id, {host.format(u='url')} AS host, {path} AS path FROM pages)",
        f"ruled AS (SELECT page_id, host, path, {case(lambda r: r[1] + r[2])} AS rule, {case(lambda r: r[0])} AS said FROM judged)",
        "seeds AS (SELECT host, count(*) FILTER (said = 'allow') AS good, count(*) FILTER (said = 'block') AS bad FROM ruled WHERE said IS NOT NULL AND host <> '' GROUP BY host)",
        f"start AS (SELECT host, coalesce(good / nullif((SELECT sum(good) FROM seeds), 0), 0.0)::DOUBLE * {1 - damping} AS s, coalesce(bad / nullif((SELECT sum(bad) FROM seeds), 0), 0.0)::DOUBLE * {1 - damping} AS z FROM seeds)",
        rf"""hrefs AS (SELECT {host.format(u='url')} AS src, unnest(list_filter(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1), lambda x: regexp_matches(x, '^(?:[A-Za-z][\w+.-]*:)?//'))) AS u FROM pages)""",
        f"links AS (SELECT src, {host.format(u='u')} AS dst FROM (SELECT src, CASE WHEN starts_with(u, '//') THEN 'http:' || u ELSE u END AS u FROM hrefs))",
        "e AS (SELECT src, dst, count(*) AS w FROM links WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst)",
        "we AS MATERIALIZED (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS f, w / sum(w) OVER (PARTITION BY dst) AS r FROM e)",
        f"""r AS (
  SELECT 0 AS n, host, s AS trust, z AS distrust FROM start
  UNION ALL
  SELECT n, host, sum(t), sum(d) FROM (
    SELECT r.n + 1 AS n, u.host, u.wt * r.trust AS t, u.wd * r.distrust AS d
    FROM r JOIN (
      SELECT src AS frm, dst AS host, f * {damping} AS wt, 0.0::DOUBLE AS wd FROM we
      UNION ALL SELECT dst, src, 0.0, r * {damping} FROM we) u ON u.frm = r.host
    WHERE r.n < {rounds}
    UNION ALL SELECT k.n + 1, host, s, z FROM start, (SELECT max(n) AS n FROM r) k WHERE k.n < {rounds})
  GROUP BY n, host)""",
    ]
    return (
        "WITH RECURSIVE " + ",\n".join(parts) + f"\nSELECT page_id, ruled.host, path, rule, "
        f"coalesce(said, CASE WHEN distrust > trust * (1 + 1e-9) THEN 'block' ELSE 'allow' END) AS verdict "
        f"FROM ruled LEFT JOIN (SELECT * FROM r WHERE n = {rounds}) r ON ruled.host = r.host"
    )


OP6 = _op6()

_NAMES11 = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
OP11 = rf"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}+'), lambda x: x <> '') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
m AS (
  SELECT doc_id, part,
         [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
          regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first_id, false)] AS f
  FROM t),
l AS (SELECT doc_id, max(quality = 1) AS g, max(toxic = 1) AS x FROM labels GROUP BY doc_id),
c AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (g) AS good, count(*) FILTER (x) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, f),
k AS (SELECT unnest(range(1, 6)) AS k),
o AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS p FROM k a, k b, k c, k d, k e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (
  SELECT array_to_string([substr('ABCDE', x, 1) for x in p], '') AS filter_order, step,
         p[step] AS own, p[1:step - 1] AS prior
  FROM o, (SELECT k AS step FROM k)),
r AS (
  SELECT part, filter_order, step, own, n, good, toxic, f[own] AS fails,
         coalesce(list_bool_or([f[x] for x in prior]), false) AS gone,
         len(list_filter(f, lambda x: x)) AS n_fails
  FROM c, s),
g AS (
  SELECT part, filter_order, step, own,
         sum(n) FILTER (NOT fails AND NOT gone) AS kept, sum(n) FILTER (fails AND NOT gone) AS removed,
         sum(n) FILTER (fails AND gone) AS redundant, sum(n) FILTER (fails AND n_fails = 1) AS unique_fails,
         sum(good) FILTER (fails AND NOT gone) AS good_lost, sum(toxic) FILTER (fails AND NOT gone) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, own),
h AS (SELECT *, sum(removed) OVER (PARTITION BY part, own) AS shapley FROM g)
SELECT part, filter_order, step::INTEGER AS step, {", ".join(f"coalesce({x}, 0)::BIGINT AS {x}" for x in _NAMES11)}
FROM h
"""
