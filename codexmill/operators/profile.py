"""Corpus profiling: class statistics, majority votes, templates, percentiles, presence rates.

Inputs are blocks or elements (``doc_id, dom_order, tag, classes, style_indent, is_bold, text``). Every
"first" has an explicit order (document, then position), every tie an explicit rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codexmill.operators.classify import PATTERNS
from codexmill.operators.sequence import ANNEX_MARKER, article_number

# Fixed value: profiling reads clauses more narrowly than the parser.
CLAUSE = r"(?U)^\s*(\d+)\.\s"


def class_rows(blocks: DataFrame) -> DataFrame:
    """One row for each class token of a block; a repeated token counts again."""
    return blocks.select("doc_id", "dom_order", "tag", "style_indent", "is_bold", "text", F.explode("classes").alias("class"))


def class_stats(blocks: DataFrame) -> DataFrame:
    """Occurrences, bold ones and the number of tags and indents of each class."""
    return class_rows(blocks).groupBy("class").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_bold").alias("bold"),
        F.count_distinct("tag").alias("n_tags"),
        F.count_distinct("style_indent").alias("n_indents"),
    )


def top_classes(stats: DataFrame, n: int = 200) -> DataFrame:
    return stats.orderBy(F.desc("total"), "class").limit(n)


def class_tags(blocks: DataFrame) -> DataFrame:
    return class_rows(blocks).groupBy("class", "tag").agg(F.count(F.lit(1)).alias("n"))


def top_indents(blocks: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent indents of each class; equal counts by the smaller indent."""
    counts = class_rows(blocks).filter(F.col("style_indent").isNotNull()).groupBy("class", "style_indent").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.row_number().over(W.partitionBy("class").orderBy(F.desc("n"), "style_indent"))).filter(F.col("rank") <= n)


def class_samples(blocks: DataFrame, n: int = 3, width: int = 200) -> DataFrame:
    """The first ``n`` texts of each class in corpus order.

    A window with a rank filter keeps ``n`` rows a class on the map side (window group limit), so no class gathers.
    """
    w = W.partitionBy("class").orderBy("doc_id", "dom_order", "text")
    rows = class_rows(blocks).withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= n)
    return rows.select("class", "nth", F.substring("text", 1, width).alias("sample"))


def profile_type(text: Column) -> Column:
    """Pattern type of a line as profiling reads it: the patterns of the parser in their order, clauses more narrowly."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS):
        kind = F.when(text.rlike(CLAUSE if name == "khoan" else pattern), name).otherwise(kind)
    return kind


def crosstab(blocks: DataFrame) -> DataFrame:
    """Counts of class and pattern type."""
    typed = class_rows(blocks).withColumn("type", profile_type(F.col("text"))).filter(F.col("type").isNotNull())
    return typed.groupBy("class", "type").agg(F.count(F.lit(1)).alias("n"))


def class_map(cross: DataFrame) -> DataFrame:
    """Majority type, purity and count of each class; equal counts by the smaller type name."""
    total = F.sum("n").alias("n")
    best = F.min(F.struct((-F.col("n")).alias("m"), "type")).alias("best")
    rows = cross.groupBy("class").agg(total, best)
    return rows.select("class", F.col("best.type").alias("type"), (-F.col("best.m") / F.col("n")).alias("purity"), "n")


def agreement(cross: DataFrame) -> DataFrame:
    """Share of typed class tokens whose type is the majority of their class; null without any."""
    per = cross.groupBy("class").agg(F.max("n").alias("best"), F.sum("n").alias("n"))
    return per.agg(F.try_divide(F.sum("best"), F.sum("n")).alias("agreement"))


def type_rates(blocks: DataFrame) -> DataFrame:
    """Share of documents with at least one line of each pattern type; a line counts for its first type."""
    kind = profile_type(F.col("text"))
    flags = [F.bool_or(kind.eqNullSafe(F.lit(name))).alias(name) for name, _ in PATTERNS]
    per_doc = blocks.groupBy("doc_id").agg(*flags)
    return per_doc.agg(F.count(F.lit(1)).alias("n_docs"), *[F.avg(F.col(n).cast("int")).alias(f"rate_{n}") for n, _ in PATTERNS])


def multi_part_rate(blocks: DataFrame) -> DataFrame:
    """Share of documents with an annex marker or with article numbers that go down."""
    num = article_number(F.col("text"))
    articles = blocks.select("doc_id", "dom_order", num.alias("num"), F.col("text").rlike(ANNEX_MARKER).alias("marker"))
    last = F.last("num", ignorenulls=True).over(W.partitionBy("doc_id").orderBy("dom_order").rowsBetween(W.unboundedPreceding, -1))
    per_doc = articles.withColumn("down", F.col("num") < last).groupBy("doc_id").agg((F.bool_or("marker") | F.coalesce(F.bool_or("down"), F.lit(False))).alias("multi"))
    return per_doc.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.col("multi").cast("int")).alias("rate"))


def presence_rates(blocks: DataFrame) -> DataFrame:
    """Share of documents with a table, an image and a link."""
    per_doc = blocks.groupBy("doc_id").agg(
        F.bool_or("is_table").alias("t"), F.bool_or(F.lower("html_raw").contains("<img")).alias("i"), F.bool_or(F.size("anchors") > 0).alias("a")
    )
    rate = lambda c: F.avg(F.coalesce(F.col(c), F.lit(False)).cast("int"))
    return per_doc.agg(F.count(F.lit(1)).alias("n_docs"), rate("t").alias("with_table"), rate("i").alias("with_image"), rate("a").alias("with_link"))


def template_families(blocks: DataFrame) -> DataFrame:
    """``doc_id, template_family``: sorted distinct class tokens of each document."""
    tokens = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("classes")))), "|")
    return blocks.groupBy("doc_id").agg(tokens.alias("template_family"))


def top_templates(families: DataFrame, n: int = 15, width: int = 300) -> DataFrame:
    return families.groupBy(F.substring("template_family", 1, width).alias("template")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "template").limit(n)


def percentiles(df: DataFrame, group: str, value: str, shares: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """The value at index ``least(n - 1, floor(n * p))`` of the sorted values of each group, with maximum and count.

    Equal values are counted first, so a group gathers its distinct values only as window rows, which spill.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(group).alias("g"), F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(W.partitionBy("g").orderBy("v"))
    total = F.sum("c").over(W.partitionBy("g"))
    ranked = counts.withColumns({"upto": upto, "n": total})

    def at(p: float) -> Column:
        index = F.least(F.col("n") - 1, F.floor(F.col("n") * p))
        return F.min(F.when(F.col("upto") > index, F.col("v"))).alias(f"p{round(p * 100)}")

    return ranked.groupBy(F.col("g").alias(group)).agg(*[at(p) for p in shares], F.max("v").alias("max_value"), F.max("n").alias("n"))
