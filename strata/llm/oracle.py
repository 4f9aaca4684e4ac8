"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

from strata.llm import lexical_search as search
from strata.llm import quality_rules as quality
from strata.llm import url_filters as urls
from strata.llm import warc

SEP = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def url_filters_sql() -> str:
    """The propagation is unrolled: one common table expression per iteration."""
    rule = "CASE"
    for r in sorted(urls.RULES, key=lambda x: (-len(x), x)):
        host, path = r[: r.index("/")], r[r.index("/") :]
        rule += f" WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{r}'"
    rule += " END"
    blocked = ", ".join(f"'{r}'" for r, v in urls.RULES.items() if v == urls.BLOCK)
    link = urls.LINK_HOST.replace("'", "''")
    d = urls.DAMPING
    steps = ["r0 AS MATERIALIZED (SELECT * FROM base)"]
    for k in range(1, urls.ITERATIONS + 1):
        steps.append(
            f"r{k} AS MATERIALIZED (SELECT kind, host, sum(mass) AS mass FROM (SELECT * FROM base UNION ALL "
            f"SELECT s.kind, s.dst, {d} * s.share * r.mass FROM shares s JOIN r{k - 1} r "
            "ON r.kind = s.kind AND r.host = s.src) GROUP BY kind, host)"
        )
    return f"""
WITH split AS (
  SELECT page_id, coalesce(html, '') AS html,
         {lowered("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
judged AS MATERIALIZED (
  SELECT *, CASE WHEN rule IS NULL THEN NULL WHEN rule IN ({blocked}) THEN 'block' ELSE 'allow' END AS ruled
  FROM (SELECT *, {rule} AS rule FROM split)),
edges AS MATERIALIZED (
  SELECT src, dst, count(*) AS links FROM (
    SELECT host AS src, {lowered("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst FROM judged)
  WHERE src <> '' AND src <> dst GROUP BY src, dst),
both_ways AS (
  SELECT 't' AS kind, src, dst, links FROM edges UNION ALL SELECT 'd', dst, src, links FROM edges),
shares AS MATERIALIZED (
  SELECT kind, src, dst, CAST(links AS DOUBLE) / sum(links) OVER (PARTITION BY kind, src) AS share FROM both_ways),
evidence AS MATERIALIZED (
  SELECT host, count(*) FILTER (ruled = 'allow') AS allowed, count(*) FILTER (ruled = 'block') AS blocked,
         count(*) FILTER (ruled IS NULL) AS open FROM judged GROUP BY host),
base AS MATERIALIZED (
  SELECT 't' AS kind, host, {1 - d} * allowed AS mass FROM evidence WHERE allowed > 0
  UNION ALL SELECT 'd', host, {1 - d} * blocked FROM evidence WHERE blocked > 0),
{", ".join(steps)},
scores AS (
  SELECT host, sum(CASE WHEN kind = 't' THEN mass ELSE 0 END) AS trust,
         sum(CASE WHEN kind = 'd' THEN mass ELSE 0 END) AS distrust FROM r{urls.ITERATIONS} GROUP BY host),
bad AS (
  SELECT s.host FROM scores s LEFT JOIN evidence e ON e.host = s.host
  WHERE s.host <> '' AND distrust > {urls.THRESHOLD} * (trust + distrust + {1 - d} * coalesce(open, 0)))
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged"""


def warc_sql() -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_page FROM p),
r AS (SELECT *, strlen(html) >= {warc.REVISIT_FROM_BYTES} AND page_id IS DISTINCT FROM first_page AS again FROM g)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_page END AS refers_to
FROM r"""


def quality_rules_sql() -> str:
    normal = f"trim(regexp_replace(lower(line), '{SEP}+', ' ', 'g'))"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (
  SELECT row_no, regexp_extract_all(text, '{WORD}') AS words FROM d),
windows AS (
  SELECT row_no, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS gram
  FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
twins AS (
  SELECT row_no, i FROM (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, gram) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT row_no, count(DISTINCT i + k) AS n_repeat_words FROM twins, (VALUES (0), (1), (2)) AS t(k) GROUP BY row_no),
lines AS MATERIALIZED (
  SELECT row_no, doc_id, host, line, len(regexp_extract_all(line, '{WORD}')) AS n
  FROM (SELECT row_no, doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{WORD}')),
doubled AS (
  SELECT row_no, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY row_no),
normal AS MATERIALIZED (SELECT row_no, doc_id, host, {normal} AS line, n FROM lines),
host_size AS (SELECT host, count(DISTINCT coalesce(doc_id, -1)) AS host_docs FROM normal GROUP BY host),
frequent AS (
  SELECT c.host, c.line FROM (
    SELECT host, line, count(DISTINCT coalesce(doc_id, -1)) AS n_docs FROM normal GROUP BY host, line) c
  JOIN host_size h ON h.host IS NOT DISTINCT FROM c.host
  WHERE n_docs >= {quality.LINE_DOCS} AND n_docs > {quality.LINE_SHARE} * host_docs),
frequent_words AS (
  SELECT row_no, sum(n) AS in_frequent FROM normal l JOIN frequent f
  ON f.line = l.line AND f.host IS NOT DISTINCT FROM l.host GROUP BY row_no),
own AS (
  SELECT row_no FROM frequent_words JOIN w USING (row_no)
  WHERE in_frequent <= {quality.OWN_SHARE} * len(words)),
boilerplate AS (
  SELECT c.host, c.line FROM (
    SELECT l.host, l.line, count(DISTINCT coalesce(doc_id, -1)) AS n_docs
    FROM normal l JOIN own USING (row_no)
    JOIN frequent f ON f.line = l.line AND f.host IS NOT DISTINCT FROM l.host GROUP BY l.host, l.line) c
  JOIN host_size h ON h.host IS NOT DISTINCT FROM c.host
  WHERE n_docs >= {quality.LINE_DOCS} AND n_docs > {quality.LINE_SHARE} * host_docs),
removed AS (
  SELECT row_no, sum(n) AS removed_words FROM normal l JOIN boilerplate f
  ON f.line = l.line AND f.host IS NOT DISTINCT FROM l.host GROUP BY row_no),
figures AS (
  SELECT d.*, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, removed_words
  FROM d JOIN w USING (row_no) LEFT JOIN covered USING (row_no) LEFT JOIN doubled USING (row_no)
  LEFT JOIN removed USING (row_no)),
based AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words
         AS base_failed FROM figures)
SELECT doc_id, n_words,
       CAST(length(regexp_replace(text, '{SEP}', '', 'g')) AS BIGINT) AS word_chars,
       CAST(length(text) - length(translate(text, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND (removed_words IS NULL OR (n_words - removed_words >= {quality.LEFT_WORDS}
         AND n_words - removed_words >= {quality.LEFT_SHARE} * n_words)) AS kept
FROM based"""


def lexical_search_sql() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    found = lambda t: f"regexp_extract_all({lowered(f'coalesce({t}, {chr(39) * 2})')}, '{term}')"
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_no, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM (
    SELECT row_number() OVER () AS row_no, doc_id, {found("text")} AS terms FROM documents) WHERE len(terms) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
tf AS MATERIALIZED (
  SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM d) GROUP BY row_no, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({found("text")}) AS term FROM benchmark),
w AS (SELECT item_id, term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM q JOIN df USING (term), whole),
s AS (
  SELECT item_id, row_no, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * whole.docs) // whole.terms)))) AS BIGINT)
         AS score
  FROM w JOIN tf USING (term) JOIN d USING (row_no), whole GROUP BY item_id, row_no, doc_id),
r AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
         doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {search.TOP}"""


def exact_dedup_sql() -> str:
    return f"""
WITH d AS (SELECT doc_id, {lowered("coalesce(text, '')")} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
FROM d"""


ORACLES: dict[str, str] = {
    "op2_url_filters": url_filters_sql(),
    "op4_warc": warc_sql(),
    "op6_quality_rules": quality_rules_sql(),
    "op11_lexical_search": lexical_search_sql(),
    "op12_exact_dedup": exact_dedup_sql(),
}
