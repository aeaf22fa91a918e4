"""Queries of problems 4 and 9: pieces under a limit and sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.llm.pieces import split_items
from codexmill.llm.sentences import sentences
from codexmill.sources.tables import table


def _limit(spark: SparkSession, d: str, purpose: str) -> tuple[int, int]:
    """Size and overlap from the table of limits, which has one row for each purpose."""
    row = table(spark, d, "size_limits").filter(F.col("purpose") == purpose).agg(F.min("max_size"), F.max("overlap")).first()
    return row[0], row[1]


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    size, overlap = _limit(spark, d, "node_piece")
    found = split_items(table(spark, d, "nodes"), "node_id", "text_full", size, overlap, only_oversized=True)
    return found.filter(F.col("piece_no") == 0).select("node_id", "cut")


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    size, overlap = _limit(spark, d, "node_piece")
    return split_items(table(spark, d, "nodes"), "node_id", "text_full", size, overlap)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences(table(spark, d, "documents"), "doc_id", "text", F.col("source") == "scan")


QUERIES = {"p4_found": p4_found, "p4_pieces": p4_pieces, "p9_found": p9_found}
ORACLES: dict[str, str] = {}
