"""The registered queries of this subpackage and their SQL.

Each query applies its operator, with production parameters, to its whole
table; the digest columns that a result asks for are derived here from the
operator's real output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ventana.llm import (
    bpe, filter_audit, grid_join, manifest, ngram_join, packing, pii, quality, sharding, token_counts, topk, toxicity, url_filter)
from ventana.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(spark, table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(spark, ids, ranks).select(
        "doc_id", bpe.n_tokens(F.col("token_ids")).alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


URL_SQL = r"""
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f AS (
  SELECT p.page_id, max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) AS best
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, f.best.rule AS rule,
       coalesce(f.best.verdict,
                CASE WHEN p.host LIKE '%spam%' OR p.host LIKE '%pills%' OR p.host LIKE '%casino%'
                     THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN f USING (page_id)"""


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(spark, table(spark, sf_dir, "documents"), threshold=0.8, words=5).select("doc_id", "class_id", "n_links")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(toxicity.fold() != 2)
    model = toxicity.train(spark, docs, labels)
    return toxicity.score(spark, docs, model).select(
        "doc_id", F.coalesce(toxicity.fold() == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.recognise(spark, docs, pii.train(spark, docs))
    return found.select(
        "doc_id", *[pii.count(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.joined(F.concat("base", "added")).alias("spans"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(spark, table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark, table(spark, sf_dir, "embeddings"), every=50, k=5)


TOPK_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def op10_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.join(spark, table(spark, sf_dir, "embeddings"), cosine=0.95)


GRID_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
m AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT d.vec_id, coalesce(n.n_links, 0) AS n_links, least(d.vec_id, coalesce(m.least, d.vec_id)) AS component_id,
       d.vec_id <= coalesce(m.least, d.vec_id) AS kept
FROM embeddings d LEFT JOIN n ON n.a = d.vec_id LEFT JOIN m ON m.a = d.vec_id"""


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(spark, table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(quality.fold() != 0)
    model = quality.train(spark, docs, labels)
    return quality.score(spark, docs, model).select(
        "doc_id", F.coalesce(quality.fold() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = filter_audit.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(counted, "".join(filter_audit.FAILURES) + filter_audit.COPY)


AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY text) AS least FROM d),
l AS (
  SELECT doc_id AS label_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN coalesce(least < doc_id, false) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.label_id),
c AS (SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT chr(65 + CAST(k AS INTEGER)) AS letter, 1 << CAST(k AS INTEGER) AS bit FROM range(5) t(k)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS own,
         CAST(coalesce(list_sum(bits[1:k - 1]), 0) AS INTEGER) AS earlier
  FROM o, range(1, 6) t(k)),
r AS (
  SELECT c.part, s.filter_order, s.step, s.own,
         CAST(sum(CASE WHEN mask & (earlier | own) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN mask & earlier = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN mask & earlier <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN mask & earlier = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN mask & earlier = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM c, s GROUP BY c.part, s.filter_order, s.step, s.own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r"""


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")

    def without_line_ends(doc_id, text):
        return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)

    m = manifest.manifest(spark, docs, without_line_ends)
    folded = manifest.folded(F.coalesce("tampered_leaf", "leaf"), F.col("proof"),
                             [(F.col("place"), F.col("n")), (F.col("source_place"), F.col("n_sources"))])
    rows = m.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


MANIFEST_SQL = r"""
WITH RECURSIVE
field AS (
  SELECT doc_id, coalesce(':' || source, '') AS tree, text,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
         list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
             lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS inverse_crc
  FROM documents),
changed AS (
  SELECT *, CASE WHEN xor(inverse_crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM field),
leaf AS (
  SELECT doc_id, tree, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(octet_length(encode(other)) || ':' || other, '-')) AS start
  FROM changed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n FROM leaf),
low AS (
  SELECT tree, 0 AS level, place, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, any_value(level) + 1, place // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place))
  FROM low WHERE n > 1 GROUP BY tree, place // 3),
sub AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n
  FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, place, n, subroot AS digest FROM sub
  UNION ALL
  SELECT any_value(level) + 1, place // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place))
  FROM high WHERE n > 1 GROUP BY place // 3),
top AS (SELECT digest AS root FROM high WHERE n = 1),
low_run AS (SELECT tree, level, place // 3 AS run, list(digest ORDER BY place) AS digests FROM low WHERE n > 1 GROUP BY ALL),
high_run AS (SELECT level, place // 3 AS run, list(digest ORDER BY place) AS digests FROM high WHERE n > 1 GROUP BY ALL),
rise AS (
  SELECT p.doc_id, p.leaf, p.tree, p.place AS own, 0 AS level, p.place, p.n, p.start AS folded, '' AS proof FROM placed p
  UNION ALL
  SELECT r.doc_id, r.leaf, r.tree, r.own, r.level + 1, r.place // 3, (r.n + 2) // 3,
         sha256(array_to_string(list_concat(list_concat(digests[1:r.place % 3], [r.folded]), digests[r.place % 3 + 2:]), '')),
         r.proof || array_to_string(list_concat(digests[1:r.place % 3], digests[r.place % 3 + 2:]), '')
  FROM rise r JOIN low_run x ON x.tree = r.tree AND x.level = r.level AND x.run = r.place // 3 WHERE r.n > 1),
over AS (
  SELECT r.doc_id, r.leaf, r.tree, r.own, 0 AS level, s.place, s.n, s.subroot, r.folded, r.proof
  FROM rise r JOIN sub s USING (tree) WHERE r.n = 1
  UNION ALL
  SELECT r.doc_id, r.leaf, r.tree, r.own, r.level + 1, r.place // 3, (r.n + 2) // 3, r.subroot,
         sha256(array_to_string(list_concat(list_concat(digests[1:r.place % 3], [r.folded]), digests[r.place % 3 + 2:]), '')),
         r.proof || array_to_string(list_concat(digests[1:r.place % 3], digests[r.place % 3 + 2:]), '')
  FROM over r JOIN high_run x ON x.level = r.level AND x.run = r.place // 3 WHERE r.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM over, top WHERE n = 1"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_url_filter": op2_url_filter,
    "op3_ngram_join": op3_ngram_join,
    "op4_toxicity": op4_toxicity,
    "op5_packing": op5_packing,
    "op6_pii": op6_pii,
    "op7_sharding": op7_sharding,
    "op8_topk": op8_topk,
    "op9_token_counts": op9_token_counts,
    "op10_grid_join": op10_grid_join,
    "op11_quality": op11_quality,
    "op12_filter_audit": op12_filter_audit,
    "op13_manifest": op13_manifest,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str | None] = {
    "op2_url_filter": URL_SQL,
    "op8_topk": TOPK_SQL,
    "op10_grid_join": GRID_SQL,
    "op12_filter_audit": AUDIT_SQL,
    "op13_manifest": MANIFEST_SQL,
    "pipeline": corpus_pipeline.ORACLE_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in ORACLES.items() if sql}
