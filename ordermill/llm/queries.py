"""The operators as named queries over a folder of tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import (
    decontamination,
    lm_score,
    manifest,
    near_duplicates,
    neighbours,
    packing,
    periodic_runs,
    repeats,
    secrets,
    token_counts,
    token_files,
    toxicity,
    url_reputation,
)
from ordermill.llm.common import read_table
from ordermill.llm.manifest_sql import manifest_sql
from ordermill.session import scratch_path


def op1_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.update_ledger(spark, documents, scratch_path(spark, "secret-ledger"))
    return secrets.digest(secrets.findings(documents, ledger))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_contamination(documents, read_table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"), similarity=85)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    documents = read_table(spark, sf_dir, "documents")
    token_files.write_tokens(documents, folder)
    return token_files.digest(token_files.read_files(spark, folder, documents.schema["doc_id"].dataType.simpleString()))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_score(read_table(spark, sf_dir, "documents"))


def op8_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_reputation.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.find_repeats(read_table(spark, sf_dir, "documents")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(read_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.digest(manifest.manifest(read_table(spark, sf_dir, "documents")))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_ledger": op1_secret_ledger,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_neighbours": op5_neighbours,
    "op6_token_files": op6_token_files,
    "op7_lm_score": op7_lm_score,
    "op8_url_reputation": op8_url_reputation,
    "op9_toxicity": op9_toxicity,
    "op10_repeats": op10_repeats,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_counts": op13_token_counts,
}

_LONG = ", ".join(f"'{suffix}'" for suffix in url_reputation.TWO_LABEL_SUFFIXES)

_OP8 = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), named AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
    array_to_string(string_split(host, '.')[-2:], '.') AS two,
    CASE WHEN two IN ({_LONG}) THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE two END AS domain,
    CASE WHEN two IN ({_LONG}) THEN two ELSE string_split(host, '.')[-1] END AS suffix
  FROM parts
), hosts AS (
  SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum((rule IN ('net/', 'example.com/de/'))::INT)::DOUBLE AS bad
  FROM named WHERE rule IS NOT NULL GROUP BY ALL
), overall AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS rate FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT rate FROM overall) AS prior FROM hosts GROUP BY suffix),
s1 AS (SELECT 1 / coalesce(least(greatest((sum(n * (bad / n - prior) ** 2) - sum(prior * (1 - prior))) / nullif(sum(prior * (1 - prior) * (n - 1)), 0), 0.01), 0.99), 0.99) - 1 AS m FROM s0),
s AS (SELECT suffix, (bad + m * prior) / (n + m) AS rate FROM s0, s1),
d0 AS (SELECT domain, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS prior FROM hosts JOIN s USING (suffix) GROUP BY suffix, domain),
d1 AS (SELECT 1 / coalesce(least(greatest((sum(n * (bad / n - prior) ** 2) - sum(prior * (1 - prior))) / nullif(sum(prior * (1 - prior) * (n - 1)), 0), 0.01), 0.99), 0.99) - 1 AS m FROM d0),
d AS (SELECT domain, (bad + m * prior) / (n + m) AS rate FROM d0, d1),
h0 AS (SELECT host, n, bad, rate AS prior FROM hosts JOIN d USING (domain)),
h1 AS (SELECT 1 / coalesce(least(greatest((sum(n * (bad / n - prior) ** 2) - sum(prior * (1 - prior))) / nullif(sum(prior * (1 - prior) * (n - 1)), 0), 0.01), 0.99), 0.99) - 1 AS m FROM h0),
posterior AS (
  SELECT u.host, coalesce(h.bad, 0) + m * coalesce(d.rate, s.rate, (SELECT rate FROM overall)) AS alpha, coalesce(h.n, 0) + m AS size
  FROM (SELECT DISTINCT host, domain, suffix FROM named WHERE rule IS NULL) u CROSS JOIN h1
  LEFT JOIN hosts h ON u.host = h.host LEFT JOIN d ON u.domain = d.domain LEFT JOIN s ON u.suffix = s.suffix
)
SELECT page_id, named.host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN alpha / size - 1.645 * sqrt(alpha / size * (1 - alpha / size) / (size + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM named LEFT JOIN posterior ON named.host = posterior.host
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3 = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), patterns AS (
  SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[k:k + 9], ' ') AS pattern
  FROM (SELECT item, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS k FROM items WHERE len(words) > 0)
), places AS (
  SELECT doc_id, n, k, array_to_string(words[k:k + n - 1], ' ') AS pattern
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS k
        FROM docs, (SELECT DISTINCT n FROM patterns) WHERE len(words) >= n)
), matches AS (SELECT doc_id, k, n, item FROM places JOIN patterns USING (n, pattern)),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS word FROM matches) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM matches) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_OP4 = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[k:k + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS k FROM docs WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM docs
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

_OP10 = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT doc_id, p, hash(substr(h, 2 * p + 1, 800)) AS w
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS p FROM docs)
), shared AS (SELECT w FROM starts GROUP BY w HAVING count(*) > 1),
hits AS (SELECT doc_id, p FROM starts SEMI JOIN shared USING (w)),
marked AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400 THEN 0 ELSE 1 END AS fresh FROM hits
), numbered AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
runs AS (SELECT doc_id, run, min(p) AS a, max(p) + 400 AS b FROM numbered GROUP BY doc_id, run),
before AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS begin_at FROM runs),
cut AS (
  SELECT doc_id, any_value(h) AS h, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
         string_agg(substr(h, 2 * begin_at + 1, 2 * (a - begin_at)), '' ORDER BY a) AS kept
  FROM before JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN removed IS NULL THEN d.h ELSE kept || substr(d.h, 2 * last + 1) END)) AS kept_sha256, removed IS NOT NULL AS has_repeats
FROM docs d LEFT JOIN cut USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": _OP3,
    "op4_near_duplicates": _OP4,
    "op8_url_reputation": _OP8,
    "op10_repeats": _OP10,
    "op12_merkle_manifest": manifest_sql(),
}
