"""Queries of problem 2: markup residue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.llm.markup import clean_plain, clean_source, markup_found, tag_paths
from codexmill.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return markup_found(table(spark, d, "nodes"), "node_id", "text")


def p2_clean_text(spark: SparkSession, d: str) -> DataFrame:
    done = clean_plain(table(spark, d, "nodes"), "node_id", "text")
    return done.select("node_id", "clean_text", F.array_join("markup", ",").alias("markup"))


def p2_clean_sources(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "nodes").select(F.col("node_id").alias("row_key"), "html_raw")
    blocks = table(spark, d, "blocks").select(F.concat_ws("#", "doc_id", "dom_order").alias("row_key"), "html_raw")
    part = lambda df, src: clean_source(df, "row_key", "html_raw").select(F.lit(src).alias("src"), "row_key", "clean_text")
    return part(nodes, "nodes").unionByName(part(blocks, "blocks"))


def p2_tag_paths(spark: SparkSession, d: str) -> DataFrame:
    """Tag paths of each document's nodes, with their score."""
    return tag_paths(table(spark, d, "nodes"), "doc_id", "html_raw")


QUERIES = {"p2_found": p2_found, "p2_clean_text": p2_clean_text, "p2_clean_sources": p2_clean_sources, "p2_tag_paths": p2_tag_paths}
_HTML = r"</?(?i:a|b|br|code|div|em|font|h[1-6]|i|img|li|o:p|ol|p|pre|s|small|span|strong|sub|sup|table|tbody|td|th|tr|u|ul)(?:\s+[^<>=]*=[^<>]*)?\s*/?>|<!--|&(?:nbsp|lt|gt|amp|quot|#[0-9]+);"
_MARKDOWN = r"(?m)```|`[^`\n]+`|\*\*[^\s*][^\n]*?\*\*|(?:^|[^_\pL\pN])__[^\s_][^\n]*?[^\s_]?__(?:[^_\pL\pN]|$)|~~[^~\n]+~~|^ {0,3}#{1,6}[ \t]+[^\n]*\pL|^ {0,3}>[ \t]?\S|\]\([#/.]|\]\(https?:"
_WIKI = r"(?m)'{2,5}[^\s'][^\n]*?[^\s']'{2,5}|(?:^|[^'])'{3,5}(?:[^']|$)|^[ \t]*={2,6}[ \t]*[^=\n]+?[ \t]*={2,6}[ \t]*$|\[\[[^\[\]\n]+\]\]|\{\{[^{}]+\}\}|^[ \t]*\{\|"
_LATEX = r"(?:^|[^:\\])\\(?:begin|end|textbf|emph|textit|section|footnote|underline|frac)\*?\s*\{|\\\(|\\\[|(?:^|[^\pL\pN:\\])\\item(?:[^a-zA-Z{]|$)|\$[^\s$][^$\n]*[\\^_={][^$\n]*\$"

ORACLES = {
    "p2_found": " UNION ALL ".join(
        f"SELECT node_id, '{kind}' AS markup FROM nodes WHERE regexp_matches(text, '{pattern.replace(chr(39), chr(39) * 2)}')"
        for kind, pattern in (("html", _HTML), ("markdown", _MARKDOWN), ("wiki", _WIKI), ("latex", _LATEX))
    )
}
