"""Registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import search_queries
from wardlake.llm.exact_dedup import exact_duplicates
from wardlake.llm.kd_shards import kd_shards
from wardlake.llm.langid import identify
from wardlake.llm.mixing import mix
from wardlake.llm.packing import packed
from wardlake.llm.perplexity import quality_rules
from wardlake.llm.quality_net import quality
from wardlake.llm.shared import documents
from wardlake.llm.simhash import near_duplicates
from wardlake.llm.substrings import without_repeats
from wardlake.llm.toxicity import toxicity


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir))


def op4_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op6_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("shards")).alias("taken"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_toxicity,
        op3_repeated_substrings,
        op4_perplexity_rules,
        op5_simhash_near_dedup,
        op6_kd_tree_shards,
        op7_quality,
        op8_exact_dedup,
        op9_packing,
        op10_source_mix,
    )
} | search_queries.QUERIES

_WHITE, _WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"

_EXACT = f"""
WITH plain AS (
  SELECT doc_id,
    regexp_replace(coalesce(text, ''), '{_WHITE}', ' ', 'g') AS plain
  FROM documents
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
  sha256(plain) AS text_sha256
FROM plain JOIN (
  SELECT plain, min(doc_id) AS keep_id, count(*) AS group_size
  FROM plain GROUP BY plain
) USING (plain)
"""

_MIX = f"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT
      AS u
  FROM documents
), ranked AS (
  SELECT *, (ARRAY[1, 2, 3])[(sid - 1) % 3 + 1] AS weight FROM (
    SELECT source, count(*) AS n_rows, sum(size)::BIGINT AS source_size,
      row_number() OVER (ORDER BY source NULLS LAST) AS sid
    FROM sized GROUP BY source)
), totals AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weights,
    sum(n_rows) OVER () AS all_rows,
    coalesce(sum(source_size) OVER smaller, 0) AS size_before,
    coalesce(sum(weight) OVER smaller, 0) AS weight_before
  FROM ranked
  WINDOW smaller AS (ORDER BY source_size / weight, sid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stopped AS (
  SELECT *, 3 * source_size * (all_weights - weight_before)
    < weight * (total - 3 * size_before) AS stops
  FROM totals
), planned AS (
  SELECT sid, source, source_size,
    CASE WHEN stops THEN (3 * source_size)::DOUBLE ELSE
      (weight * (total - sum(CASE WHEN stops THEN 3 * source_size ELSE 0 END)
        OVER ()))::DOUBLE
      / (sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ())::DOUBLE
    END AS target,
    greatest(1, ceil(n_rows / greatest(64, ceil(all_rows / 50000))))::BIGINT
      AS n_blocks
  FROM stopped
), whole AS (
  SELECT *, target - whole * source_size AS part FROM (
    SELECT *, CASE WHEN source_size > 0
      THEN least(3, floor(target / source_size))::BIGINT ELSE 0 END AS whole
    FROM planned)
), placed AS (
  SELECT s.*, w.sid, w.source_size, w.target, w.whole, w.part,
    ((u >> 20) * n_blocks) >> 40 AS block
  FROM sized s JOIN whole w ON s.source IS NOT DISTINCT FROM w.source
), quota AS (
  SELECT sid, block,
    part - (sum(sum(size)) OVER (PARTITION BY sid ORDER BY block) - sum(size)) AS room
  FROM placed GROUP BY sid, block, part
), first AS (
  SELECT *, room > 0 AND sum(size) OVER (PARTITION BY sid, block
    ORDER BY u, doc_id, size ROWS UNBOUNDED PRECEDING) <= room AS more
  FROM placed JOIN quota USING (sid, block)
), second AS (
  SELECT * REPLACE (more OR (fits AND sum(size) OVER (PARTITION BY sid, block
    ORDER BY fits DESC, size DESC, u, doc_id ROWS UNBOUNDED PRECEDING) <= room_left)
    AS more)
  FROM (SELECT *, NOT more AND size <= room_left AS fits FROM (
    SELECT *, room - sum(CASE WHEN more THEN size ELSE 0 END)
      OVER (PARTITION BY sid, block) AS room_left FROM first))
), third AS (
  SELECT * REPLACE (more OR (fits AND sum(size) OVER (PARTITION BY sid, block
    ORDER BY fits DESC, size DESC, u, doc_id ROWS UNBOUNDED PRECEDING) <= room_left)
    AS more)
  FROM (SELECT * EXCLUDE (fits), NOT more AND size <= room_left AS fits FROM (
    SELECT * EXCLUDE (room_left), room - sum(CASE WHEN more THEN size ELSE 0 END)
      OVER (PARTITION BY sid, block) AS room_left FROM second))
)
SELECT doc_id, size, source_size, target,
  size * (whole + more::INTEGER)::BIGINT AS taken
FROM third
"""

ORACLES = {"op8_exact_dedup": _EXACT, "op10_source_mix": _MIX} | search_queries.ORACLES
