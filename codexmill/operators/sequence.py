"""Operators on the ordered blocks of a document: parts, quotation masks, context.

All windows are partitioned by ``doc_id`` or finer, so one exchange on ``doc_id`` serves a whole pipeline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codexmill.config import LOOK_AHEAD, LOOK_BACK
from codexmill.functions.text import strip, whole_number

# Patterns of article lines, annex headings and annex markers.
ARTICLE = r"(?iuU)^\s*Điều\s+(\d+)[a-zđ]?[.\s]"
ANNEX_HEADING = r"(?iuU)^\s*(QUY ĐỊNH|QUY CHẾ|ĐIỀU LỆ|DANH MỤC|PHỤ LỤC)\b"
ANNEX_MARKER = r"(?iuU)\(Ban hành kèm theo"


def in_order():
    """The blocks of a document in order."""
    return W.partitionBy("doc_id").orderBy("dom_order")


def article_number(c: Column) -> Column:
    return whole_number(F.regexp_extract(c, ARTICLE, 1))


def heading_signals(blocks: DataFrame) -> DataFrame:
    """``is_heading``: an annex heading with the annex marker in this or one of the next five blocks."""
    marker = F.col("text").rlike(ANNEX_MARKER)
    near = F.max(marker.cast("int")).over(in_order().rowsBetween(0, LOOK_AHEAD))
    return blocks.withColumn("is_heading", strip(F.col("text")).rlike(ANNEX_HEADING) & (near == 1))


def split_parts(blocks: DataFrame) -> DataFrame:
    """Blocks with ``part_no, part_id, part_heading, is_main``.

    A part begins at an annex heading, or where article numbers restart at 1: there at the nearest heading
    or marker of the last nine blocks, as far back as the last boundary. The look-back depends on the
    boundary before, so it folds over the sparse signals of a document, not over its blocks.
    """
    own = blocks.repartition("doc_id")
    signals = heading_signals(own).select(
        "doc_id",
        "dom_order",
        "is_heading",
        article_number(F.col("text")).alias("num"),
        (F.col("text").rlike(ANNEX_MARKER) | strip(F.col("text")).rlike(ANNEX_HEADING)).alias("is_mark"),
        F.row_number().over(in_order()).alias("n"),
    )
    signals = signals.withColumn("i", F.col("n") - 1)
    event = F.when(F.col("is_heading") | F.col("num").isNotNull(), F.struct("i", "is_heading", "num"))
    per_doc = signals.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(event)).alias("events"), F.array_sort(F.collect_list(F.when(F.col("is_mark"), F.col("i")))).alias("marks")
    )
    start = F.struct(F.array(F.lit(0)).alias("bounds"), F.lit(None).cast("int").alias("last"))

    def step(acc: Column, e: Column) -> Column:
        bounds, last = acc["bounds"], acc["last"]
        edge = F.element_at(bounds, -1)
        at = F.array_max(F.filter("marks", lambda j: (j < e["i"]) & (j >= F.greatest(e["i"] - LOOK_BACK, edge))))
        at = F.coalesce(at, e["i"])
        restart = (last > 1) & (e["num"] == 1) & (at > edge)
        return (
            F.when(e["is_heading"] & (e["i"] > edge), F.struct(F.concat(bounds, F.array(e["i"])).alias("bounds"), F.lit(None).cast("int").alias("last")))
            .when(e["num"].isNull(), acc)
            .when(restart, F.struct(F.concat(bounds, F.array(at)).alias("bounds"), e["num"].alias("last")))
            .otherwise(F.struct(bounds.alias("bounds"), e["num"].alias("last")))
        )

    bounds = per_doc.select("doc_id", F.aggregate("events", start, step)["bounds"].alias("bounds"))
    placed = own.withColumn("i", F.row_number().over(in_order()) - 1).join(bounds, "doc_id")
    placed = placed.withColumn("part_no", F.size(F.filter("bounds", lambda b: b <= F.col("i"))))
    first = F.first("text").over(W.partitionBy("doc_id", "part_no").orderBy("dom_order"))
    return placed.withColumns(
        {"part_id": F.concat(F.lit("p"), F.col("part_no").cast("string")), "part_heading": F.when(F.col("part_no") > 1, first), "is_main": F.col("part_no") == 1}
    ).drop("i", "bounds")


def mask_quotes(parted: DataFrame) -> DataFrame:
    """``is_masked``: an odd number of quotation marks stands in the earlier blocks of the part."""
    before = W.partitionBy("doc_id", "part_no").orderBy("dom_order").rowsBetween(W.unboundedPreceding, -1)
    count = F.sum(F.regexp_count("text", F.lit('"'))).over(before)
    return parted.withColumn("is_masked", F.coalesce(F.pmod(count, F.lit(2)) == 1, F.lit(False)))


def context(parted: DataFrame, near: int = 200, own: int = 400) -> DataFrame:
    """Text of the block and of its neighbours within the part, as an ambiguous block is shown to a judge."""
    w = W.partitionBy("doc_id", "part_no").orderBy("dom_order")
    return parted.withColumns(
        {"before": F.substring(F.lag("text").over(w), 1, near), "shown": F.substring("text", 1, own), "after": F.substring(F.lead("text").over(w), 1, near)}
    )
