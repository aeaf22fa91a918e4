"""Queries of problem 7: texts in containers of the permitted sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.llm.packing import VOCABULARY, pack_items, token_counts
from codexmill.sources.tables import table


def _capacities(spark: SparkSession, d: str) -> list[int]:
    """The permitted sizes, of which the table has a fixed few."""
    rows = table(spark, d, "size_limits").filter(F.col("purpose").startswith("pack")).select("max_size").distinct().collect()
    return sorted(r[0] for r in rows)


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    vocabulary = spark.conf.get("spark.codexmill.vocabulary", VOCABULARY)  # a path that every executor has
    packed = pack_items(token_counts(docs, "doc_id", "text", vocabulary), "doc_id", "n_tokens", _capacities(spark, d))
    return packed.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Bins, content and filled share for each capacity."""
    bins = p7_pack(spark, d).groupBy("bin_id", "capacity").agg(F.sum("n_tokens").alias("content"))
    return bins.groupBy("capacity").agg(
        F.count(F.lit(1)).alias("n_bins"), F.sum("content").alias("n_tokens"), (F.sum("content") / F.sum("capacity")).alias("filled")
    )


QUERIES = {"p7_pack": p7_pack, "p7_fill": p7_fill}
ORACLES: dict[str, str] = {}
