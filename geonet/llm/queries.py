"""Registered queries of the training-data operators: name -> (Spark callable, oracle text or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from geonet.llm import (conversation_repair, language, line_chunks, mixing, periodic_runs, personal_data, quality, repeats, sentence_pieces,
                        simhash, token_files, topk, url_filter)
from geonet.llm.common import table
from geonet.session import scratch_path

#: Vocabulary files of the registered queries.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


OP1_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


OP2_SQL = """
WITH d AS (SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
    CAST(source_size * 2 AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT min_by(level, cap / w) AS fill FROM l WHERE cap > level * w),
t AS (SELECT source, source_size, CASE WHEN cap > level * w THEN (SELECT fill FROM f) * w ELSE cap END AS target FROM l),
n AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 2) ELSE 0 END AS copies FROM t),
g AS (SELECT source, h, sum(size) AS s FROM d GROUP BY source, h),
c AS (SELECT g.source, g.h, g.s, n.target - n.copies * n.source_size AS rest,
    coalesce(sum(g.s) OVER (PARTITION BY g.source ORDER BY g.h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM g JOIN n ON g.source IS NOT DISTINCT FROM n.source),
m AS (SELECT source, h, CASE WHEN before + s <= rest THEN 1 WHEN before <= rest AND 2 * (rest - before) >= s THEN 1 ELSE 0 END AS more FROM c)
SELECT d.doc_id, d.source, d.size, n.source_size, n.target, CAST(d.size * (n.copies + m.more) AS BIGINT) AS taken
FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source JOIN m ON d.source IS NOT DISTINCT FROM m.source AND d.h = m.h"""


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(table(spark, sf_dir, "documents"), PIECE_BPE)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4).select("doc_id", "fingerprint", "component_id")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    return token_files.token_index(token_files.write_tokens(table(spark, sf_dir, "documents"), folder, BYTE_BPE, end_id=2), folder)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), PIECE_BPE)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept").withColumnRenamed("kept_text", "text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return d.drop("stratum")


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_chunks.report(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.reports(conversation_repair.damaged(conversations), conversations)


QUERIES = {
    "op1_topk": (op1_topk, OP1_SQL),
    "op2_mixing": (op2_mixing, OP2_SQL),
    "op3_sentence_pieces": (op3_sentence_pieces, None),
    "op4_simhash": (op4_simhash, None),
    "op5_token_files": (op5_token_files, None),
    "op6_url_filter": (op6_url_filter, None),
    "op7_language": (op7_language, None),
    "op8_repeats": (op8_repeats, None),
    "op9_quality": (op9_quality, None),
    "op10_line_chunks": (op10_line_chunks, None),
    "op11_periodic_runs": (op11_periodic_runs, None),
    "op12_personal_data": (op12_personal_data, None),
    "op13_conversation_repair": (op13_conversation_repair, None),
}
