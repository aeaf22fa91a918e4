"""Queries of problem 8: evaluation passages in the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.llm.leaks import EDITED_SEEDS, RUN, SEED_RUN, leaks
from codexmill.sources.tables import table


def _leaks(spark: SparkSession, d: str, **how) -> DataFrame:
    return leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "benchmark_items"), "item_id", "text", **how)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d, run=SEED_RUN).filter(F.col("longest_run") >= RUN).select("doc_id", "item_id").distinct()


def p8_leak_report(spark: SparkSession, d: str) -> DataFrame:
    """For each item the documents that hold it, whole or in part, with the best similarity."""
    scored = _leaks(spark, d, run=SEED_RUN, per_window=EDITED_SEEDS, whole=True).withColumn("similarity", F.col("score") / (2 * F.col("n_words")))
    return scored.groupBy("item_id").agg(
        F.count_if(F.col("longest_run") >= RUN).alias("n_exact"),
        F.count_if((F.col("longest_run") < RUN) & (F.col("similarity") >= 0.5)).alias("n_edited"),
        F.max("similarity").alias("best_similarity"),
    )


QUERIES = {"p8_found": p8_found, "p8_leak_report": p8_leak_report}
ORACLES = {
    "p8_found": r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark_items WHERE text IS NOT NULL),
ig AS (SELECT DISTINCT item_id, hash(array_to_string(w[p:p + 19], ' ')) AS h FROM (SELECT item_id, w, unnest(range(1, len(w) - 18)) AS p FROM i) x),
dg AS (SELECT doc_id, hash(array_to_string(w[p:p + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d) x)
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (h)"""
}
