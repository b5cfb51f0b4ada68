"""The registered queries of the numbered operators, with DuckDB SQL where SQL can tell the rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verigrid.llm import ann, hard_negatives, jaccard, licenses, mixing, packing, prefix_trie, quality, secrets, suffix_dedup, token_files, url_filter, vector_dedup
from verigrid.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = token_files.new_folder(work_dir(spark))
    manifest = token_files.write_tokens(table(spark, sf_dir, "documents"), folder, path, 50_257, end_id=2)
    read = token_files.read_documents(manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(table(spark, sf_dir, "documents")).drop("kept")


@register
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@register
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@register
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge_urls(table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def _op5_sql() -> str:
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    term = "CASE WHEN regexp_matches(u, '(^|[^a-z0-9]){}([^a-z0-9]|$)') THEN {} ELSE 0 END".format
    weight = " + ".join(term(t, w) for t, w in url_filter.TERMS.items())
    fit = "((host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}'))".format
    rules = sorted(url_filter.RULES, key=lambda r: -len(r.host + r.path))
    rule = " ".join(f"WHEN {fit(r.host, r.path)} THEN '{r.host}{r.path}'" for r in rules)
    verdict = " ".join(f"WHEN {fit(r.host, r.path)} THEN '{r.verdict}'" for r in rules)
    return f"""
    WITH cut AS (
      SELECT page_id, coalesce({low("url")}, '') AS u,
             coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest
      FROM pages
    ), parts AS (
      SELECT page_id, u, {low("regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1)")} AS host,
             regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
      FROM cut
    )
    SELECT page_id, host, path, CASE {rule} END AS rule,
           CASE {verdict} WHEN {weight} >= {url_filter.LIMIT} THEN 'block' ELSE 'allow' END AS verdict
    FROM parts"""


SQL["op5_url_filter"] = _op5_sql()


@register
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("bigint")
    base = F.filter("spans", lambda x: x["kind"] < secrets.KINDS.index("random"))
    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secrets.told(base), 256).alias("base_sha256"), secrets.told(F.col("spans")).alias("spans"))


@register
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs.select("doc_id", "text"), trees).drop("text", "score")


@register
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(table(spark, sf_dir, "documents"), path, end_id=1)
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


@register
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


SQL["op10_mixing"] = """
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM sizes
), weighed AS (
  SELECT *, [3, 1, 2][number % 3 + 1] AS weight, 2 * source_size AS cap FROM ranked
), ratios AS (
  SELECT *, cap::DOUBLE / weight AS ratio FROM weighed
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
             - (sum(cap) OVER (ORDER BY ratio, number) - cap)::DOUBLE)
            / (sum(weight) OVER () - sum(weight) OVER (ORDER BY ratio, number) + weight)::DOUBLE AS level
  FROM ratios
), aims AS (
  SELECT source, source_size,
         least(cap::DOUBLE, (SELECT arg_min(level, struct_pack(r := ratio, n := number)) FROM levels
                             WHERE ratio >= level) * weight) AS target
  FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM aims
), placed AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.target, r.rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id) - 1 AS i
  FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), trials AS (
  SELECT source, t, target,
         ('0x' || substr(md5('mix:' || t || ':' || coalesce('s' || source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM rates, range(16) AS x(t)
), tried AS (
  SELECT p.source, t.t, t.u,
         abs(sum((floor((p.i + 1) * p.rate + t.u) - floor(p.i * p.rate + t.u)) * p.size) - any_value(t.target)) AS off
  FROM placed p JOIN trials t ON p.source IS NOT DISTINCT FROM t.source GROUP BY 1, 2, 3
), best AS (
  SELECT source, arg_min(u, struct_pack(o := off, n := t)) AS u FROM tried GROUP BY source
)
SELECT p.doc_id, p.size, p.source_size, p.target,
       ((floor((p.i + 1) * p.rate + b.u) - floor(p.i * p.rate + b.u)) * p.size)::BIGINT AS taken
FROM placed p JOIN best b ON p.source IS NOT DISTINCT FROM b.source"""


@register
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


SQL["op11_hard_negatives"] = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.q, c.q)::BIGINT AS score
  FROM valid a JOIN valid c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 3"""


@register
def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.groups(table(spark, sf_dir, "embeddings"))


SQL["op12_vector_dedup"] = """
WITH RECURSIVE valid AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
), labels AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN labels l USING (vec_id) LEFT JOIN counts c ON c.a = e.vec_id"""


@register
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


SQL["op13_prefix_trie"] = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rank
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS n,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))) % 4 AS h
  FROM turns GROUP BY conv_id
), convs AS (
  SELECT s.conv_id, s.base, s.h, least(s.h, coalesce(b.n, 0)) AS m, least(s.h, coalesce(b.n, 0)) + greatest(s.n - s.h, 0) AS length
  FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.base
), rebuilt AS (
  SELECT c.conv_id, t.rank AS d, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.rank <= c.m
  UNION ALL
  SELECT c.conv_id, t.rank - c.h + c.m, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.rank > c.h
), prefixes AS (
  SELECT conv_id, d, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS words,
         string_agg(md5(md5(role) || md5(text)), '') OVER (PARTITION BY conv_id ORDER BY d) AS key
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
  SELECT p.key, p.d, count(*) AS n_convs, min(p.conv_id) AS conv_id, any_value(p.words) AS words,
         sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (c.length = p.d), '')) AS ends_sha256
  FROM prefixes p JOIN convs c USING (conv_id) GROUP BY p.key, p.d
), children AS (
  SELECT left(key, length(key) - 32) AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), below AS (
  SELECT n.key, sum((m.n_convs - 1) * m.words)::BIGINT AS saved_tokens, count(*) FILTER (k.n IS NULL) AS n_leaves
  FROM nodes n JOIN nodes m ON starts_with(m.key, n.key) LEFT JOIN children k ON k.key = m.key GROUP BY n.key
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
       b.n_leaves, b.saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (key) LEFT JOIN children k USING (key)
LEFT JOIN nodes p ON n.d > 0 AND p.key = left(n.key, length(n.key) - 32)"""
