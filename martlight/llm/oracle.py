"""SQL counterparts of the registered queries that SQL can express."""

from __future__ import annotations

from martlight.llm.clustering import CENTROIDS, DIMENSIONS, SCALE, SEED
from martlight.llm.clustering import ROUNDS as CLUSTER_ROUNDS
from martlight.llm.decontaminate import WINDOW_WORDS as ITEM_WINDOW
from martlight.llm.queries import URL_RULES
from martlight.llm.quality import (
    MAX_LINE_PERCENT,
    MAX_REPEAT_PERCENT,
    MIN_LINE_DOCUMENTS,
    MIN_WORDS,
    REPEAT_WINDOW,
)
from martlight.llm.substring import WINDOW_WORDS
from martlight.llm.urlfilter import BLOCK_PERCENT, FOLLOW_PERCENT, STORE_ROUNDS, TOLERANCE, TOTAL_MASS

_SPACES = r"[ \t\n\x0b\x0c\r]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return rf"regexp_extract_all(coalesce({text}, ''), '[^ \t\n\x0b\x0c\r]+')"


QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         {_words("text")} AS w
  FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + {REPEAT_WINDOW - 1}], ' ') AS k
  FROM docs, unnest(range(1, len(w) - {REPEAT_WINDOW - 2})) AS s(i) WHERE len(w) >= {REPEAT_WINDOW}
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT r, count(DISTINCT i + d) AS n FROM twice, unnest(range(0, {REPEAT_WINDOW})) AS s(d) GROUP BY r
), lines AS (
  SELECT r, host, l AS raw, {_LOWER.format(f"trim(regexp_replace(l, '{_SPACES}+', ' ', 'g'))")} AS line
  FROM docs, unnest(string_split(t, chr(10))) AS s(l) WHERE regexp_matches(l, '[^ \t\n\x0b\x0c\r]')
), texts AS (
  SELECT min(r) AS r, host FROM docs GROUP BY host, t
), counted AS (
  SELECT host, line, count(DISTINCT r) AS n FROM lines SEMI JOIN texts USING (r, host) GROUP BY host, line
), frequent AS (
  SELECT host, line FROM counted JOIN (SELECT host, count(*) AS m FROM texts GROUP BY host) USING (host)
  WHERE n > {MIN_LINE_DOCUMENTS} AND n * 100 > m * {MAX_LINE_PERCENT}
), removed AS (
  SELECT r, sum(len(string_split(line, ' '))) AS n FROM lines JOIN frequent USING (host, line) GROUP BY r
), dups AS (
  SELECT r, count(*) - count(DISTINCT raw) AS n FROM lines GROUP BY r
), facts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(w) - coalesce(removed.n, 0) AS BIGINT) AS words_left
  FROM docs LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN removed USING (r)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM facts
)
SELECT *, NOT base_failed AND words_left >= {MIN_WORDS} AS kept FROM judged
"""

_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"



def _levels(source: str, width: int) -> str:
    """Steps from ``source`` (r, i, h1: a row's words) to keys of 2, 4, ... words, up to ``width``; the last is named ``keyed``."""
    steps, n, before = [], 1, source
    while 2 * n <= width:
        name = "keyed" if 4 * n > width else f"{source}_{2 * n}"
        steps.append(
            f"""{name} AS (
  SELECT *, md5(h{n} || ' ' || lead(h{n}, {n}) OVER (PARTITION BY r ORDER BY i)) AS h{2 * n} FROM {before})"""
        )
        before, n = name, 2 * n
    return ", ".join(steps)


def _window(width: int) -> str:
    """The key of ``width`` words from a place on: two overlapping keys of a power of two."""
    n = 1 << width.bit_length() - 1
    return f"h{n} || lead(h{n}, {width - n}) OVER (PARTITION BY r ORDER BY i)" if width > n else f"h{n}"


_SIZES = range(1, ITEM_WINDOW + 1)
# Documents and items are one table, items with negative numbers, so that both get their keys alike.
DECONTAMINATION = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ITEM_WORD}') AS w
  FROM documents
), items AS MATERIALIZED (
  SELECT -row_number() OVER () AS r, item_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ITEM_WORD}') AS w FROM benchmark
), places AS (
  SELECT r, len(w) AS size, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS h1
  FROM (SELECT r, w FROM docs UNION ALL SELECT r, w FROM items)
), {_levels("places", ITEM_WINDOW)}, windows AS MATERIALIZED (
  SELECT r, i, size, {", ".join(f"{_window(n)} AS k{n}" for n in _SIZES)} FROM keyed
), phrases AS MATERIALIZED (
  SELECT DISTINCT item_id, n, CASE n {" ".join(f"WHEN {n} THEN k{n}" for n in _SIZES)} END AS k
  FROM (SELECT *, least(size, {ITEM_WINDOW}) AS n FROM windows WHERE r < 0) JOIN items USING (r) WHERE i + n - 1 <= size
), met AS MATERIALIZED (
  {" UNION ALL ".join(
      f"SELECT r, i, {n} AS n, item_id FROM windows JOIN phrases ON phrases.n = {n} AND k = k{n} WHERE r > 0 AND i + {n - 1} <= size"
      for n in _SIZES)}
), reach AS (
  SELECT r, i, max(upto) OVER (PARTITION BY r ORDER BY i) AS upto
  FROM (SELECT r, i FROM windows WHERE r > 0) LEFT JOIN (SELECT r, i, max(i + n) AS upto FROM met GROUP BY r, i) USING (r, i)
), hits AS (
  SELECT r, count(*) AS n_hit FROM reach WHERE upto > i GROUP BY r
), names AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS list
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM met WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN names USING (r)
"""

SUBSTRINGS = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents
), places AS (
  SELECT r, doc_id, len(w) AS size, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS h1 FROM docs
), {_levels("places", WINDOW_WORDS)}, windows AS MATERIALIZED (
  SELECT r, doc_id, i, h1, CASE WHEN i + {WINDOW_WORDS - 1} <= size THEN {_window(WINDOW_WORDS)} END AS k FROM keyed
), firsts AS (
  SELECT k, min(doc_id) AS first FROM windows WHERE k IS NOT NULL GROUP BY k
), marked AS (
  SELECT r, i, h1, CASE WHEN first < doc_id OR (first IS NOT NULL AND doc_id IS NULL) THEN i + {WINDOW_WORDS} END AS upto
  FROM windows LEFT JOIN firsts USING (k)
), reach AS (
  SELECT r, i, h1, max(upto) OVER (PARTITION BY r ORDER BY i) AS upto FROM marked
), kept AS (
  SELECT r, count(*) AS n, string_agg(h1, ' ' ORDER BY i) AS t FROM reach WHERE upto IS NULL OR upto <= i GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

_DIGIT = "(CAST('0x' || substr(sha, 1 + 5 * (i // 4), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31"

WARC = f"""
WITH rows AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages), hashed AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS sha FROM rows
), firsts AS (SELECT sha, min(page_id) AS first FROM hashed GROUP BY sha), marked AS (
  SELECT *, coalesce(page_id > first, first IS NOT NULL) AS later FROM hashed JOIN firsts USING (sha)
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ({_DIGIT}), 1) FOR i IN range(0, 32)], '')
         AS payload_digest,
       CASE WHEN later THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN later THEN first END AS refers_to
FROM marked
"""


def _url_filters() -> str:
    rules = ", ".join(
        f"('{r.host}', '{r.path}', '{r.name}', '{r.verdict}', {len(r.name)})" for r in URL_RULES
    )
    link = r"""(?i)<a\s[^>]*?href\s*=\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s>]+)"""
    return f"""
WITH RECURSIVE rules(rhost, rpath, rule, rverdict, size) AS (VALUES {rules}), rows AS (
  SELECT row_number() OVER () AS r, page_id, html,
    {_LOWER.format("coalesce(regexp_extract(url, '^(?s).*?://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '^(?s).*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fits AS (
  SELECT r, arg_max(rule, size) AS rule, arg_max(rverdict, size) AS decided FROM rows, rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY r
), ruled AS (SELECT * FROM rows LEFT JOIN fits USING (r)), counts AS (
  SELECT host, count(*) FILTER (decided = 'allow') AS allowed, count(*) FILTER (decided = 'block') AS blocked
  FROM ruled WHERE host <> '' GROUP BY host
), edges AS (
  SELECT DISTINCT host AS source, {_LOWER.format("x")} AS target
  FROM rows, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) AS s(x)
  WHERE host <> '' AND x <> '' AND host <> {_LOWER.format("x")}
), ways AS (
  SELECT 'trust' AS kind, source AS host, target AS next, count(*) OVER (PARTITION BY source) AS degree FROM edges
  UNION ALL SELECT 'distrust', target, source, count(*) OVER (PARTITION BY target) FROM edges
), starts AS (
  SELECT 'trust' AS kind, host, CAST(CAST(allowed AS HUGEINT) * {TOTAL_MASS} // (SELECT sum(allowed) FROM counts) AS BIGINT) AS mass
  FROM counts WHERE allowed > 0
  UNION ALL
  SELECT 'distrust', host, CAST(CAST(blocked AS HUGEINT) * {TOTAL_MASS} // (SELECT sum(blocked) FROM counts) AS BIGINT)
  FROM counts WHERE blocked > 0
), kept AS (
  SELECT kind, host, mass * {100 - FOLLOW_PERCENT} // 100 AS mass FROM starts
), ranks AS (
  SELECT 0 AS n, kind, host, mass, CAST(sum(mass) OVER () AS BIGINT) AS last_sum, count(*) OVER () AS last_count, false AS settled
  FROM kept
  UNION ALL
  SELECT n, kind, host, mass, CASE WHEN n % {STORE_ROUNDS} = 0 THEN now_sum ELSE last_sum END,
    CASE WHEN n % {STORE_ROUNDS} = 0 THEN now_count ELSE last_count END,
    n % {STORE_ROUNDS} = 0 AND now_sum - last_sum <= {TOLERANCE} AND now_count = last_count
  FROM (
    SELECT *, CAST(sum(mass) OVER () AS BIGINT) AS now_sum, count(*) OVER () AS now_count FROM (
      SELECT n, kind, host, CAST(sum(mass) AS BIGINT) AS mass, max(last_sum) AS last_sum, max(last_count) AS last_count FROM (
        SELECT n + 1 AS n, kind, next AS host, (mass * {FOLLOW_PERCENT} // 100) // degree AS mass, last_sum, last_count
        FROM ranks JOIN ways USING (kind, host) WHERE NOT settled AND (mass * {FOLLOW_PERCENT} // 100) // degree > 0
        UNION ALL
        SELECT n + 1, k.kind, k.host, k.mass, last_sum, last_count
        FROM kept k, (SELECT DISTINCT n, last_sum, last_count FROM ranks WHERE NOT settled)
      ) GROUP BY n, kind, host))
), scores AS (
  SELECT host, CAST(coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS BIGINT) AS trust,
         CAST(coalesce(sum(mass) FILTER (kind = 'distrust'), 0) AS BIGINT) AS distrust
  FROM ranks WHERE n = (SELECT max(n) FROM ranks) GROUP BY host
)
SELECT page_id, host, path, rule,
  coalesce(decided, CASE WHEN coalesce(distrust, 0) > 0
    AND distrust * 100 >= (trust + distrust) * {BLOCK_PERCENT} THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM ruled LEFT JOIN scores USING (host)
"""


def _clusters() -> str:
    """Every distance to every centroid, in whole numbers; the rounds are written out one after another."""
    steps = []
    for n in range(CLUSTER_ROUNDS + 1):
        steps.append(
            f"""near{n} AS MATERIALIZED (
  SELECT r, min(ROW(d, number)) AS best FROM (
    SELECT r, number, list_sum(list_transform(range(1, {DIMENSIONS + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d
    FROM kept, centroids{n}) GROUP BY r)"""
        )
        if n < CLUSTER_ROUNDS:
            steps.append(
                f"""sums{n} AS (
  SELECT number, i, sum(x[i]) AS s, count(*) AS n
  FROM (SELECT r, best[2] AS number FROM near{n}) JOIN kept USING (r), unnest(range(1, {DIMENSIONS + 1})) AS u(i)
  GROUP BY number, i
), means{n} AS (
  SELECT number, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM sums{n} GROUP BY number
), centroids{n + 1} AS MATERIALIZED (
  SELECT number, coalesce(m, c) AS c FROM centroids{n} LEFT JOIN means{n} USING (number))"""
            )
    last = CLUSTER_ROUNDS
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * {SCALE}) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda e: isfinite(e))) = {DIMENSIONS}
), centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS number, x AS c
  FROM (SELECT x, sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) AS h FROM kept ORDER BY h NULLS LAST, x LIMIT {CENTROIDS})
), {", ".join(steps)}, found AS (
  SELECT vec_id, best[2] AS number, CAST(best[1] AS BIGINT) AS distance FROM near{last} JOIN kept USING (r)
)
SELECT vec_id, CAST(number AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY number) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found JOIN centroids{last} USING (number)
"""


ORACLES = {
    "op2_quality_rules": QUALITY,
    "op3_benchmark_decontamination": DECONTAMINATION,
    "op8_url_filters": _url_filters(),
    "op9_substring_dedup": SUBSTRINGS,
    "op10_warc": WARC,
    "op12_centroid_clusters": _clusters(),
}
