"""Trees of nodes from classified blocks, by windows alone.

The top of the stack of open nodes is always the node pushed last, and the parent of a node
is the nearest earlier one of a smaller level. Both are window expressions, so no Python and no
loop over documents is needed: for each level the last node before a row is carried along, and
of these the ones that no node of a smaller level follows are the ancestors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codexmill.config import LEVELS

# Patterns of a signature block and of a dateline.
FOOTER = r"(?iuU)^\s*(TM\.|KT\.|Nơi nhận|\(?Đã ký\)?)"
DATELINE = r"(?iuU)^\s*[^,\n]{2,40},\s*ngày\s+\d{1,2}\s+tháng\s+\d{1,2}\s+năm\s+\d{4}\s*\.?\s*$"

RANKS = range(max(LEVELS.values()) + 1)
PART = ["doc_id", "part_no"]


def rank_of(kind: Column) -> Column:
    return reduce(lambda acc, x: F.when(kind == x[0], F.lit(x[1])).otherwise(acc), LEVELS.items(), F.lit(None).cast("int"))


def mark_nodes(classified: DataFrame) -> DataFrame:
    """What each block does: ``role`` is push, khoan0, footer, preamble or append; ``target`` the order index it belongs to."""
    order = W.partitionBy(*PART).orderBy("dom_order")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    is_push = F.col("node_type").isNotNull()
    is_footer = ~is_push & (F.col("text").rlike(FOOTER) | F.col("text").rlike(DATELINE))
    rows = classified.withColumns({"__push": is_push, "__foot": is_footer})
    rows = rows.withColumn("__group", F.sum(F.col("__push").cast("int")).over(upto))  # blocks since the last push
    rows = rows.withColumn("__last_type", F.last("node_type", ignorenulls=True).over(upto))
    plain = ~F.col("__push") & ~F.col("__foot")
    in_group = W.partitionBy(*PART, "__group").orderBy("dom_order").rowsBetween(W.unboundedPreceding, 0)
    nth_plain = F.sum(plain.cast("int")).over(in_group)
    nth_foot = F.sum(F.col("__foot").cast("int")).over(upto)
    role = (
        F.when(F.col("__push"), "push")
        .when(F.col("__foot"), F.when(nth_foot == 1, "footer").otherwise("to_footer"))
        .when((F.col("__group") > 0) & (F.col("__last_type") == "dieu") & (nth_plain == 1), "khoan0")
        .when(F.col("__group") > 0, "append")
        .otherwise(F.when(nth_plain == 1, "preamble").otherwise("to_preamble"))
    )
    rows = rows.withColumn("role", role)
    created = F.col("role").isin("push", "khoan0", "footer", "preamble")
    rows = rows.withColumn("order_index", (F.sum(created.cast("int")).over(upto) - 1).cast("int"))
    only = lambda r: F.max(F.when(F.col("role") == r, F.col("order_index"))).over(W.partitionBy(*PART))
    rows = rows.withColumn("target", F.when(F.col("role") == "to_footer", only("footer")).when(F.col("role") == "to_preamble", only("preamble")).otherwise(F.col("order_index")))
    return rows.drop("__push", "__foot", "__group", "__last_type")


def with_ancestors(nodes: DataFrame, payload: list[str], name: str) -> DataFrame:
    """``name``: ancestors of each node (columns ``rank, order_index``), outermost first, as structs of ``payload``.

    Nodes without a rank stand outside the tree and have none. The last node of each level is a column of its
    own, so each window function is evaluated once.
    """
    before = W.partitionBy(*PART).orderBy("order_index").rowsBetween(W.unboundedPreceding, -1)
    lasts = {f"__last{q}": F.last(F.when(F.col("rank") == q, F.struct("order_index", *payload)), ignorenulls=True).over(before) for q in RANKS}
    seen = nodes.withColumns(lasts)
    # An ancestor of level q lies behind every node of a smaller level.
    slots = []
    for q in RANKS:
        smaller = [F.coalesce(F.col(f"__last{p}.order_index"), F.lit(-1)) for p in range(q)]
        edge = F.greatest(*smaller) if len(smaller) > 1 else smaller[0] if smaller else F.lit(-1)
        slots.append(F.when((F.col("rank") > q) & (F.col(f"__last{q}.order_index") > edge), F.col(f"__last{q}")))
    return seen.withColumn(name, F.filter(F.array(*slots), lambda x: x.isNotNull())).drop(*lasts)


def build_tree(classified: DataFrame, slug: str = "doc_slug") -> DataFrame:
    """Nodes of parted and classified blocks (``doc_id, part_no, part_id, dom_order, text, html_raw`` and the classification).

    One row for each node with ids, path, breadcrumb, text and rolled-up text.
    """
    marked = mark_nodes(classified)
    # The block that creates a node is the first of those that belong to it, so one grouping gives
    # both the node and its text, in the partitioning that the windows already have.
    first = lambda c: F.min_by(c, "dom_order")
    nodes = marked.groupBy(*PART, F.col("target").alias("order_index")).agg(
        first("part_id").alias("part_id"),
        first(slug).alias("__slug"),
        first("role").alias("role"),
        first("node_type").alias("__type"),
        first("number_raw").alias("__number"),
        first("text").alias("first_text"),
        first("confidence").alias("__confidence"),
        first("classified_by").alias("__by"),
        F.array_sort(F.collect_list(F.struct("dom_order", "text", "html_raw"))).alias("__b"),
    )
    k0 = F.col("role") == "khoan0"
    other = F.col("role").isin("footer", "preamble")
    nodes = nodes.select(
        *PART,
        "part_id",
        "__slug",
        "order_index",
        F.when(k0, "khoan").when(other, F.col("role")).otherwise(F.col("__type")).alias("node_type"),
        F.when(k0, "0").when(~other, F.col("__number")).alias("number_raw"),
        "first_text",
        F.when(k0, 0.5).when(other, 0.6).otherwise(F.col("__confidence")).alias("confidence"),
        F.when(k0, "style").when(other, "regex").otherwise(F.col("__by")).alias("classified_by"),
        F.array_join(F.transform("__b", lambda b: b["text"]), "\n").alias("full_own"),
        F.array_join(F.transform("__b", lambda b: F.coalesce(b["html_raw"], F.lit(""))), "").alias("html_all"),
    )
    nodes = nodes.withColumns({"rank": rank_of(F.col("node_type")), "number_norm": F.when(F.col("node_type") == "diem", F.lower("number_raw")).otherwise(F.col("number_raw"))})
    nodes = with_ancestors(nodes, [], "__up")
    nodes = nodes.withColumn("__parent", F.coalesce(F.try_element_at(F.transform("__up", lambda x: x["order_index"]), F.lit(-1)), F.lit(-1))).drop("__up")
    unnumbered = F.coalesce(F.col("number_norm"), F.lit("")) == ""
    siblings = W.partitionBy(*PART, "__parent", "node_type", unnumbered).orderBy("order_index")
    tail = (
        F.when(F.col("rank").isNull(), F.col("node_type"))
        .when(unnumbered, F.concat(F.col("node_type"), F.lit("-u"), F.row_number().over(siblings).cast("string")))
        .otherwise(F.concat_ws("-", "node_type", "number_norm"))
    )
    nodes = nodes.withColumn("tail", tail)
    repeat = F.row_number().over(W.partitionBy(*PART, "__parent", "tail").orderBy("order_index"))
    nodes = nodes.withColumn("id_tail", F.when((repeat > 1) & F.col("rank").isNotNull(), F.concat("tail", F.lit("~"), repeat.cast("string"))).otherwise(F.col("tail")))
    nodes = nodes.withColumn("crumb", F.substring("first_text", 1, 60))
    nodes = with_ancestors(nodes, ["tail", "id_tail", "crumb"], "__anc")
    chain = lambda f: F.transform("__anc", lambda x: x[f])
    root = F.concat_ws("/", "__slug", "part_id")
    nodes = nodes.withColumns(
        {
            "node_id": F.concat_ws("/", root, chain("id_tail"), "id_tail"),
            "parent_id": F.when(F.size("__anc") > 0, F.concat_ws("/", root, chain("id_tail"))),
            "path": F.replace(F.concat_ws(".", chain("tail"), "tail"), F.lit("-"), F.lit("_")),
            "breadcrumb": F.concat_ws(" › ", chain("crumb"), "crumb"),
            "depth": F.size("__anc"),
            "heading": F.when(F.col("node_type").isin("dieu", "chuong", "muc", "tieu_muc", "phan"), F.col("first_text")),
        }
    )
    # Every node gives its text to itself and to its ancestors, in order of creation.
    kept = ["node_id", "part_id", "parent_id", "path", "depth", "node_type", "number_raw", "number_norm", "heading", "full_own", "breadcrumb", "html_all", "confidence", "classified_by"]
    own = F.struct(*kept)
    # Only a node's own row carries its columns; the rows for its ancestors carry the text alone.
    empty = F.lit(None).cast(nodes.select(own).schema[0].dataType)
    up = F.transform("__anc", lambda x: F.struct(x["order_index"].alias("to"), empty.alias("own")))
    to = F.concat(F.array(F.struct(F.col("order_index").alias("to"), own.alias("own"))), up)
    given = nodes.select(*PART, F.struct("order_index", "full_own").alias("t"), F.explode(to).alias("g"))
    rolled = given.groupBy(*PART, F.col("g.to").alias("order_index")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["full_own"]), "\n").alias("text_full"),
        F.first("g.own", ignorenulls=True).alias("n"),
    )
    return rolled.select("order_index", "text_full", *PART, "n.*").select(
        "node_id", "doc_id", "part_no", "part_id", "parent_id", "path", F.col("depth").cast("int").alias("depth"), "order_index", "node_type", "number_raw", "number_norm", "heading",
        F.col("full_own").alias("text"), "text_full", "breadcrumb", F.col("html_all").alias("html_raw"), "confidence", "classified_by",
    )


def subtree(nodes: DataFrame, prefix: str) -> DataFrame:
    """All nodes below ``prefix``; the prefix test reaches the Parquet scan."""
    return nodes.filter(F.col("node_id").startswith(prefix + "/"))


def outline(nodes: DataFrame) -> DataFrame:
    """One printable line for each node, indented by depth."""
    number = F.coalesce(F.concat(F.lit(" "), F.col("number_norm")), F.lit(""))
    line = F.concat(F.expr("repeat('  ', depth)"), F.lit("["), F.col("node_type"), number, F.lit("] "), F.substring("text", 1, 80))
    return nodes.select("doc_id", "part_id", "order_index", line.alias("line"))
