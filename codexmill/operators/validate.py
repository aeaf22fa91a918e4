"""Quality of parsed documents: six measures, issues and a verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codexmill.config import CONFLICT_CONFIDENCE, CONFLICT_LIMIT, COVERAGE_CLEAN, COVERAGE_WARN, POINT_ALPHABET
from codexmill.functions.text import solid, whole_number
from codexmill.operators.sequence import ANNEX_MARKER


def sequence_ok(nodes: DataFrame, part: str = "part_no") -> DataFrame:
    """``doc_id, sequence_ok``: articles and clauses count up by one under each parent, points go up in the alphabet.

    Nodes without a parent form one group for the whole document, over all its parts.
    """
    order = W.partitionBy("doc_id", "parent_id", "node_type").orderBy(part, "order_index")
    numbers = nodes.filter(F.col("node_type").isin("dieu", "khoan", "diem"))
    lead = whole_number(F.regexp_extract("number_norm", r"(?U)^(\d+)", 1))
    place = F.nullif(F.when(F.length("number_norm") == 1, F.instr(F.lit(POINT_ALPHABET), F.lower("number_norm"))), F.lit(0))
    numbers = numbers.withColumn("__n", F.when(F.col("node_type") == "diem", place).otherwise(lead)).filter(F.col("__n").isNotNull())
    step = F.col("__n") - F.lag("__n").over(order)
    steps = numbers.withColumn("__step", step)
    wrong = F.when(F.col("node_type") == "diem", F.col("__step") <= 0).otherwise(F.col("__step") != 1)
    return steps.groupBy("doc_id").agg((~F.coalesce(F.bool_or(wrong), F.lit(False))).alias("sequence_ok"))


def hierarchy_ok(nodes: DataFrame) -> DataFrame:
    """``doc_id, hierarchy_ok``: points stand under clauses; clauses under articles, or under nothing where the document has no article."""
    parents = nodes.select(F.col("node_id").alias("__pid"), F.col("node_type").alias("__ptype"))
    # Roots have no parent; a key of their own keeps them from meeting in one partition.
    keyed = nodes.withColumn("__up", F.coalesce("parent_id", F.concat(F.lit("root of "), "node_id")))
    joined = keyed.join(parents, F.col("__up") == F.col("__pid"), "left")
    articles = F.coalesce(F.bool_or(F.col("node_type") == "dieu").over(W.partitionBy("doc_id")), F.lit(False))
    joined = joined.withColumn("__articles", articles)
    parent = F.coalesce(F.col("__ptype"), F.lit(""))
    wrong = ((F.col("node_type") == "diem") & (parent != "khoan")) | (
        (F.col("node_type") == "khoan") & ~((parent == "dieu") | ((parent == "") & ~F.col("__articles")))
    )
    return joined.groupBy("doc_id").agg((~F.bool_or(wrong)).alias("hierarchy_ok"))


def issues(q: DataFrame) -> Column:
    """Names of failed measures in their fixed order."""
    tests = [
        (F.col("char_coverage") < COVERAGE_CLEAN, "char_coverage"),
        (~F.col("sequence_ok"), "sequence"),
        (~F.col("hierarchy_ok"), "hierarchy"),
        (~F.col("part_count_ok"), "part_count"),
        (~F.col("table_preserved"), "table_preserved"),
        (F.col("conflict_rate") >= CONFLICT_LIMIT, "conflict_rate"),
    ]
    return F.filter(F.array(*[F.when(t, F.lit(n)) for t, n in tests]), lambda x: x.isNotNull())


def verdict(issue_list: Column) -> Column:
    return F.when(F.col("char_coverage") < COVERAGE_WARN, "failed").when(F.size(issue_list) == 0, "clean").otherwise("warn")


def quality(documents: DataFrame, blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row for each document: measures, issues and verdict.

    ``documents``: ``doc_id, n_tables, n_chars, template_family``. ``blocks``: parted blocks with
    ``raw_type, raw_confidence, is_table``. A document without blocks is clean with no node.
    """
    per_doc = blocks.groupBy("doc_id").agg(
        F.sum(F.length(solid(F.col("text")))).alias("__chars"),
        F.max("part_no").alias("__parts"),
        F.count_if(F.col("text").rlike(ANNEX_MARKER)).alias("__markers"),
        F.count_if("is_table").alias("__tables"),
        F.count_if(F.col("raw_type").isNotNull()).alias("__typed"),
        F.count_if(F.col("raw_type").isNotNull() & (F.col("raw_confidence") < CONFLICT_CONFIDENCE)).alias("__conflicts"),
    )
    counts = nodes.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("n_nodes"))
    q = documents.join(per_doc, "doc_id", "left").join(counts, "doc_id", "left").join(sequence_ok(nodes), "doc_id", "left").join(hierarchy_ok(nodes), "doc_id", "left")
    empty = F.col("__parts").isNull()
    q = q.select(
        "doc_id",
        F.coalesce("n_nodes", F.lit(0)).alias("n_nodes"),
        F.when(empty | (F.col("n_chars") == 0), 1.0).otherwise(F.col("__chars") / F.col("n_chars")).alias("char_coverage"),
        F.coalesce("sequence_ok", F.lit(True)).alias("sequence_ok"),
        F.coalesce("hierarchy_ok", F.lit(True)).alias("hierarchy_ok"),
        (empty | (F.col("__parts") == F.col("__markers") + 1)).alias("part_count_ok"),
        (empty | (F.col("__tables") == F.col("n_tables"))).alias("table_preserved"),
        F.when(F.coalesce("__typed", F.lit(0)) == 0, 0.0).otherwise(F.col("__conflicts") / F.col("__typed")).alias("conflict_rate"),
        F.when(empty, "").otherwise(F.col("template_family")).alias("template_family"),
    )
    q = q.withColumn("__issues", issues(q))
    return q.withColumns({"verdict": verdict(F.col("__issues")), "issues": F.array_join("__issues", ","), "template_family": F.substring("template_family", 1, 300)}).drop("__issues")
