"""Queries of problem 5: one consistent form of each text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.llm.lookalikes import differing_rows, one_form
from codexmill.sources.tables import table


def _sources(spark: SparkSession, d: str) -> DataFrame:
    """Both texts in one table, so they share one pass; ``row_key`` carries the source."""
    nodes = table(spark, d, "nodes").select(F.lit("nodes").alias("src"), F.col("node_id").alias("k"), F.col("text_full").alias("t"))
    blocks = table(spark, d, "blocks").select(F.lit("blocks").alias("src"), F.concat_ws("#", "doc_id", F.col("dom_order").cast("string")).alias("k"), F.col("text").alias("t"))
    return nodes.unionByName(blocks)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = differing_rows(_sources(spark, d), F.struct("src", "k"), "t")
    return found.select("row_key.src", F.col("row_key.k").alias("row_key"))


def p5_one_form(spark: SparkSession, d: str) -> DataFrame:
    done = one_form(_sources(spark, d), F.struct("src", "k"), "t")
    return done.select("row_key.src", F.col("row_key.k").alias("row_key"), "text_form", "changed")


QUERIES = {"p5_found": p5_found, "p5_one_form": p5_one_form}
# The scripts of the engine itself: two letters of different alphabets side by side in one word.
_OTHER = r"[\p{Greek}\p{Cyrillic}\p{Armenian}\p{Cherokee}\p{Coptic}\p{Georgian}\x{1d400}-\x{1d7ff}]"
_MIXED = rf"\p{{Latin}}\p{{M}}*{_OTHER}|{_OTHER}\p{{M}}*\p{{Latin}}|\p{{Cyrillic}}\p{{M}}*\p{{Greek}}|\p{{Greek}}\p{{M}}*\p{{Cyrillic}}"
_SIGNS = r"[\x{00}-\x{09}\x{0b}\x{0c}\x{0e}-\x{1b}\x{7f}\x{a0}\x{ad}\x{34f}\x{61c}\x{115f}\x{1160}\x{1680}\x{17b4}\x{17b5}\x{180e}\x{2000}-\x{200f}\x{202a}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{3164}\x{fe00}-\x{fe0f}\x{feff}\x{ff10}-\x{ff19}\x{ff21}-\x{ff3a}\x{ff41}-\x{ff5a}\x{ff65}-\x{ffdc}\x{d0}\x{189}\x{256}\x{131}\x{261}\x{251}]"

ORACLES = {
    "p5_found": f"""SELECT src, row_key FROM (
  SELECT 'nodes' AS src, node_id AS row_key, text_full AS t FROM nodes UNION ALL SELECT 'blocks', doc_id || '#' || dom_order, text FROM blocks) x
WHERE nfc_normalize(t) <> t OR regexp_matches(t, '{_SIGNS}') OR regexp_matches(t, '{_MIXED}')"""
}
