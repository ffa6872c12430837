"""The registered queries of this package, one a listed operator, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajkit.llm import chat, chunk_bpe, media, neardup, packing, pii, quality, records, topk, toxicity
from trajkit.llm.blocks import vocabulary
from trajkit.session import table


def op1_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.search(rows, rows.filter(F.col("vec_id") % 100 == 0), k=10)


def op2_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records.write_and_read(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_latent_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digests(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))


def op6_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op7_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op9_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_mjpeg_avi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pivot_topk": op1_pivot_topk,
    "op2_record_files": op2_record_files,
    "op3_latent_neighbours": op3_latent_neighbours,
    "op4_noisy_or_toxicity": op4_noisy_or_toxicity,
    "op5_chat_template": op5_chat_template,
    "op6_weak_supervision_pii": op6_weak_supervision_pii,
    "op7_bbit_minhash": op7_bbit_minhash,
    "op8_sum_of_squares_packing": op8_sum_of_squares_packing,
    "op9_chunk_reuse_bpe": op9_chunk_reuse_bpe,
    "op10_mjpeg_avi": op10_mjpeg_avi,
}

ORACLE_SQL = {
    "op1_pivot_topk": """
        WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
             r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op5_chat_template": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
                   UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
             e AS (SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS text_e,
                          replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\' || chr(10)) AS role_e,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i,
                          lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM c),
             j AS (SELECT *, coalesce(before, '^') || '>' || role NOT IN ('^>system', '^>user', 'system>user', 'user>assistant', 'assistant>user') AS wrong FROM e),
             g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
                          coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '') AS lost,
                          CAST(sum(length('<|im_start|>') + length(role_e) + 1 + length(text_e) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
                          min(CASE WHEN wrong THEN i END) AS error_turn, arg_max(role, i) AS last_role FROM j GROUP BY conv_id)
        SELECT conv_id, n_turns, turns_sha256, length(lost) AS loss_chars, sha256(lost) AS loss_sha256, formatted_chars,
               error_turn IS NULL AND last_role IN ('user', 'assistant') AS valid, error_turn FROM g
    """,
}
