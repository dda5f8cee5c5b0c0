"""Registered queries of the training-data operators and their SQL.

Each query reads whole tables, calls its operator and derives the columns of
its contract.  ``__spark_entry__.py`` adds QUERIES and ORACLES to its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.chat_quotes import as_mail, link_quotes
from tessera.llm.decontam import contaminated
from tessera.llm.divergence import divergence
from tessera.llm.license_scan import scan_licenses
from tessera.llm.merkle import document_proofs
from tessera.llm.mixing import mix
from tessera.llm.quality_rules import fit_rules, quality_verdicts
from tessera.llm.recompression import repeat_digests
from tessera.llm.secret_scan import find_secrets, secret_digest
from tessera.llm.sharding import shard
from tessera.llm.simhash_dedup import simhash_dedup
from tessera.llm.url_filter import judge_urls, rule_table
from tessera.llm.warc import archive_pages
from tessera.session import scratch_path

SHARDS = 40

#: Fixed values of the contract: (verdict, host, path).
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op2_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


OP2_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
g AS (SELECT *, payload_bytes >= 100 AND first IS NOT NULL AND (page_id IS NULL OR page_id > first) AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to, TRUE AS intact
FROM g
"""


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "epochs")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || coalesce(md5(text), '~')), 1, 15) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2.0 * source_size::DOUBLE AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM s),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT source, source_size, least(cap, w * max(level) OVER ()) AS target FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
r AS (
  SELECT d.*, p.source_size, p.target, p.epochs, floor(p.target) - p.epochs * p.source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken, epochs
FROM r
"""


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


OP5_SQL = r"""
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
u AS (
  SELECT row_number() OVER () AS i, page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
m AS (
  SELECT u.i, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.i)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN m USING (i)
"""


def op6_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rules = fit_rules(docs, _table(spark, sf_dir, "labels"))
    return quality_verdicts(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as mail threads, two levels of quotes in each message, and back."""
    found = link_quotes(as_mail(_table(spark, sf_dir, "conversations")))
    digest = F.md5("body").alias("body_md5")
    return found.select("conv_id", "turn", "role", "n_quotes", "max_level", "n_linked", "parent_turn", "root_turn", "depth", digest)


OP8_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, role, regexp_replace(coalesce(text, ''), '^[\x20\x09\x0A\x0D]+|[\x20\x09\x0A\x0D]+$', '', 'g') AS body,
         trim(regexp_replace(lower(coalesce(text, '')), '[\x20\x09-\x0D]+', ' ', 'g')) <> '' AS said
  FROM conversations),
j AS (
  SELECT m.*, a.turn AS p1, b.turn AS p2, coalesce(a.said, FALSE) AS s1, coalesce(b.said, FALSE) AS s2
  FROM m LEFT JOIN m a ON a.conv_id = m.conv_id AND a.turn = m.turn - 1 LEFT JOIN m b ON b.conv_id = m.conv_id AND b.turn = m.turn - 2),
k AS (
  SELECT *, CASE WHEN s1 THEN p1 END AS parent_turn,
         max(CASE WHEN NOT s1 THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS root_turn
  FROM j)
SELECT conv_id, turn, role, CAST(s1 AS BIGINT) + CAST(s2 AS BIGINT) AS n_quotes,
       CASE WHEN s2 THEN 2 WHEN s1 THEN 1 ELSE 0 END::BIGINT AS max_level, CAST(s1 AS BIGINT) + CAST(s2 AS BIGINT) AS n_linked,
       parent_turn, root_turn, turn - root_turn AS depth, md5(body) AS body_md5
FROM k
"""


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(find_secrets(_table(spark, sf_dir, "documents")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_proofs(_table(spark, sf_dir, "documents"))


def _crc32(text: str) -> str:
    """DuckDB has no CRC-32: its bitwise form over the bytes of an ASCII text."""
    step = "lambda c, b: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    codes = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    byte = f"lambda crc, byte: list_reduce(range(8), {step}, xor(crc, byte))"
    return f"xor(list_reduce({codes}, {byte}, 4294967295), 4294967295)"


def _tree_sql(leaves: str, name: str) -> str:
    """Recursive CTEs: ``name`` holds all nodes (tree, level, pos, digest) over ``leaves`` (tree, pos, digest)."""
    return f"""
{name}(tree, level, pos, digest, n) AS (
  SELECT tree, 0, pos, digest, count(*) OVER (PARTITION BY tree) FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 2) // 3)
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 3)"""


def _fold_sql(start: str, tree: str, name: str) -> str:
    """``name``: (i, tree, level, pos, digest, proof) of each document of ``start``, one row a level, with all siblings so far."""
    left = "string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < f.pos)"
    right = "string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > f.pos)"
    return f"""
{name}(i, tree, level, pos, digest, proof) AS (
  SELECT i, tree, 0, pos, digest, proof FROM {start}
  UNION ALL
  SELECT f.i, f.tree, f.level + 1, f.pos // 3,
         sha256(coalesce({left}, '') || f.digest || coalesce({right}, '')),
         f.proof || coalesce({left}, '') || coalesce({right}, '')
  FROM {name} f JOIN {tree} y ON y.tree IS NOT DISTINCT FROM f.tree AND y.level = f.level AND y.pos // 3 = f.pos // 3 AND y.n > 1
  GROUP BY f.i, f.tree, f.level, f.pos, f.digest, f.proof)"""


_PART = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_LEAF = " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
OP11_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS i, doc_id, source AS tree, sha256({_LEAF} || {_PART.format("text")}) AS leaf,
         sha256({_LEAF} || {_PART.format("u")}) AS copy
  FROM (SELECT *, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS u FROM documents)),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, i) - 1 AS pos, leaf AS digest, '' AS proof FROM d),
{_tree_sql("l", "g")},
s AS (SELECT tree AS source, digest AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos FROM g WHERE n = 1),
t AS (SELECT CAST(NULL AS VARCHAR) AS tree, pos, subroot AS digest FROM s),
{_tree_sql("t", "h")},
a AS (SELECT i, tree, pos, copy AS digest, proof FROM l),
{_fold_sql("a", "g", "b")},
b1 AS (SELECT b.* FROM b JOIN g ON g.tree IS NOT DISTINCT FROM b.tree AND g.level = b.level AND g.n = 1),
c AS (SELECT b1.i, CAST(NULL AS VARCHAR) AS tree, s.pos, b1.digest, b1.proof FROM b1 JOIN s ON s.source IS NOT DISTINCT FROM b1.tree),
{_fold_sql("c", "h", "e")},
r AS (SELECT level, digest AS root FROM h WHERE n = 1)
SELECT d.doc_id, d.leaf, s.subroot, r.root, sha256(e.proof) AS proof_sha256, e.digest AS folded_root, e.digest = r.root AS verified
FROM d JOIN s ON s.source IS NOT DISTINCT FROM d.tree JOIN r ON TRUE JOIN e ON e.i = d.i AND e.level = r.level
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_table(spark, sf_dir, "documents"), min_docs=10, top=10)


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT i, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
a AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
  FROM a JOIN v USING (lang)),
l AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v)) AS q
  FROM a JOIN v USING (lang) GROUP BY lang, term),
f AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
  FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source GROUP BY ALL),
u AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0) AS value
  FROM g x JOIN g y ON y.lang = x.lang AND y.source <> x.source
  LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 10
"""


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(_table(spark, sf_dir, "documents"), window=13)


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
h AS (SELECT i, doc_id, list_transform(range(1, len(w) - 11), lambda p: md5(array_to_string(w[p:p + 12], ' '))) AS hs FROM d),
v AS (SELECT i, doc_id, unnest(hs) AS h, unnest(range(1, len(hs) + 1)) AS p FROM h),
a AS (SELECT i, p, min(doc_id) OVER (PARTITION BY h) < doc_id AS again FROM v),
r AS (SELECT DISTINCT i, unnest(range(p, p + 13)) AS p FROM a WHERE again),
x AS (SELECT i, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (
  SELECT x.i, count(r.p) AS n_removed, string_agg(CASE WHEN r.p IS NULL THEN word END, ' ' ORDER BY x.p) AS kept
  FROM x LEFT JOIN r ON r.i = x.i AND r.p = x.p GROUP BY x.i)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (i)
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_warc_chunks": op2_warc_chunks,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_source_mixing": op4_source_mixing,
    "op5_url_filter": op5_url_filter,
    "op6_ring_sharding": op6_ring_sharding,
    "op7_quality_rules": op7_quality_rules,
    "op8_quotation_linking": op8_quotation_linking,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_source_divergence": op12_source_divergence,
    "op13_substring_dedup": op13_substring_dedup,
    "pipeline": pipeline,
}
#: The others learn, walk a graph or follow a plan; tests/llm holds them against brute-force versions.
ORACLES: dict[str, str] = {
    "op2_warc_chunks": OP2_SQL,
    "op4_source_mixing": OP4_SQL,
    "op5_url_filter": OP5_SQL,
    "op8_quotation_linking": OP8_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_substring_dedup": OP13_SQL,
}
