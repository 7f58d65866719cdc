"""Registered queries of the operators on word indexes and tokens, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlake.llm.alignment import alignment
from wardlake.llm.decontamination import contamination
from wardlake.llm.postings import CAPITALS, SMALL, TERM
from wardlake.llm.ranked_search import ranked
from wardlake.llm.shared import documents


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(documents(spark, sf_dir)).select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        "groups_sha256",
    )


QUERIES = {
    f.__name__: f
    for f in (op11_decontamination, op12_ranked_search, op13_token_alignment)
}

_TERMS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), "
    f"'{TERM}')"
)

_DECONTAMINATION = f"""
WITH word_lists AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents
), items AS (
  SELECT item_id, {_TERMS} AS words FROM benchmark
), phrases AS (
  SELECT DISTINCT item_id, words[pos : pos + 9] AS phrase
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos
    FROM items WHERE len(words) > 0)
), sizes AS (
  SELECT DISTINCT len(phrase) AS n FROM phrases
), places AS (
  SELECT r, n, unnest(range(1, len(words) - n + 2)) AS pos, words
  FROM word_lists, sizes WHERE len(words) >= n
), matches AS (
  SELECT r, pos, len(phrase) AS n, item_id
  FROM (SELECT r, pos, words[pos : pos + n - 1] AS phrase FROM places)
  JOIN phrases USING (phrase)
), hits AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT r, unnest(range(pos, pos + n)) AS place FROM matches) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM matches
    WHERE item_id IS NOT NULL)
  GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM word_lists LEFT JOIN hits USING (r) LEFT JOIN found USING (r)
"""

_RANKED = f"""
WITH word_lists AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents
), items AS (
  SELECT DISTINCT item_id, list_sort(list_distinct({_TERMS})) AS terms FROM benchmark
), asked AS (
  SELECT item_id, terms, unnest(terms) AS term FROM items
), totals AS (
  SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS all_terms
  FROM word_lists WHERE len(terms) > 0
), postings AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term
    FROM word_lists)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term,
    floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
), scores AS (
  SELECT item_id, asked.terms, r, doc_id, sum(w * ((1000000000 * tf)
    // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // all_terms)))))::BIGINT
    AS score
  FROM postings JOIN weights USING (term) JOIN asked USING (term), totals GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id, terms ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 50
"""

ORACLES = {"op11_decontamination": _DECONTAMINATION, "op12_ranked_search": _RANKED}
