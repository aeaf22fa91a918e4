"""Roll-ups of quality tables: shares, pivots, issue combinations, transitions, and text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codexmill.functions.text import markdown_cell, or_unknown

VERDICTS = ("clean", "warn", "failed")


def verdict_shares(quality: DataFrame) -> DataFrame:
    counts = quality.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))
    # One row for each verdict, so the window over all rows is of bounded size.
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(F.lit(0))))


def verdict_pivot(quality: DataFrame, key: Column, name: str, top: int | None = None) -> DataFrame:
    """Counts of each verdict by ``key``; with ``top`` only the most frequent keys, equal counts by key."""
    rows = quality.groupBy(key.alias(name)).agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS], F.count(F.lit(1)).alias("total"))
    return rows.orderBy(F.desc("total"), name).limit(top) if top else rows


def issue_combinations(quality: DataFrame, top: int = 20) -> DataFrame:
    """The most frequent combinations of issues with their first document."""
    combo = F.coalesce(F.nullif(F.col("issues"), F.lit("")), F.lit("none"))
    rows = quality.groupBy(combo.alias("combination")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("example"))
    return rows.orderBy(F.desc("n"), "combination").limit(top)


def breakdown(quality: DataFrame) -> DataFrame:
    """Verdicts by type, by decade and by template in one pass, as grouping sets."""
    q = quality.select(or_unknown(F.col("loai_van_ban")).alias("loai_van_ban"), or_unknown(F.col("decade")).alias("decade"), F.substring("template_family", 1, 80).alias("template"), "verdict")
    sets = q.groupingSets([["loai_van_ban", "verdict"], ["decade", "verdict"], ["template", "verdict"]], "loai_van_ban", "decade", "template", "verdict")
    return sets.agg(F.grouping_id().cast("bigint").alias("gid"), F.count(F.lit(1)).alias("n")).select("gid", "loai_van_ban", "decade", "template", "verdict", "n")


def transitions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts of verdict before and after."""
    a = old.select("doc_id", F.col("verdict").alias("before"))
    b = new.select("doc_id", F.col("verdict").alias("after"))
    return a.join(b, "doc_id").groupBy("before", "after").agg(F.count(F.lit(1)).alias("n"))


def to_markdown(df: DataFrame, title: str) -> str:
    """A report's section as Markdown, with all of its rows.

    For results that are small by construction (top-k tables and roll-ups by type, decade or verdict): the text of a
    report is made in the driver, which takes the rows one partition at a time.
    """
    cols = df.columns
    rows = df.select(*[markdown_cell(F.col(c).cast("string")).alias(c) for c in cols]).toLocalIterator()
    head = f"## {title}\n\n| {' | '.join(cols)} |\n|{'---|' * len(cols)}\n"
    return head + "".join(f"| {' | '.join('' if v is None else v for v in r)} |\n" for r in rows)
