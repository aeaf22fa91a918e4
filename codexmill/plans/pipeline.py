"""The document pipeline: HTML to blocks, parts, classified blocks, trees and quality."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.functions.text import doc_slug, or_unknown
from codexmill.operators.classify import apply_mask, cascade, class_tier, judge
from codexmill.operators.html import explode_blocks, flatten_documents
from codexmill.operators.sequence import context, mask_quotes, split_parts
from codexmill.operators.tree import build_tree
from codexmill.operators.validate import quality
from codexmill.session import cut
from codexmill.sources.tables import latest_per_key


def classify_blocks(blocks: DataFrame, class_map: DataFrame | None = None, provider: Callable | None = None) -> DataFrame:
    """Parted, classified and masked blocks; the exchange on ``doc_id`` serves every step."""
    parted = split_parts(blocks)
    typed = class_tier(parted, class_map) if class_map is not None else parted.withColumn("class_type", F.lit(None).cast("string"))
    masked = apply_mask(mask_quotes(cascade(typed)))
    return judge(context(masked), provider).drop("before", "shown", "after") if provider else masked


def nodes_of(classified: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Nodes of classified blocks; ``metadata`` (``id, so_ky_hieu``) gives the readable part of ids, its last row counts.

    Slugs are made once a document, not once a block, and join by ``doc_id``, so the blocks keep their partitioning.
    """
    docs = classified.select(F.col("doc_id").alias("__doc")).distinct()
    number = F.lit(None).cast("string")
    if metadata is not None:
        order = ["doc_id"] if "doc_id" in metadata.columns else ["so_ky_hieu"]
        last = latest_per_key(metadata.select(*{"id", "so_ky_hieu", *order}), "id", order).select(F.col("id").alias("__id"), F.col("so_ky_hieu").alias("__number"))
        docs = docs.join(last, docs["__doc"] == last["__id"], "left")
        number = F.col("__number")
    slugs = docs.select("__doc", doc_slug(number, F.col("__doc")).alias("doc_slug"))
    return build_tree(classified.join(slugs, classified["doc_id"] == slugs["__doc"]).drop("__doc"))


def parse_documents(content: DataFrame, key: str, source: str, metadata: DataFrame | None = None, class_map: DataFrame | None = None, provider: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and quality of HTML documents.

    HTML is read once, blocks are classified once and nodes are built once: all three are written to the shared
    folder, because the tree and the measures of quality look at them several times.
    """
    flat = cut(flatten_documents(content, key, source))
    kept = ("doc_id", "dom_order", "part_no", "part_id", "text", "html_raw", "is_table", "node_type", "number_raw", "confidence", "classified_by", "raw_type", "raw_confidence")
    classified = cut(classify_blocks(explode_blocks(flat), class_map, provider).select(*kept))
    nodes = cut(nodes_of(classified, metadata))
    measures = flat.select("doc_id", "flat.n_tables", "flat.n_chars", "flat.template_family")
    return nodes, quality(measures, classified, nodes)


def enrich(q: DataFrame, metadata: DataFrame) -> DataFrame:
    """Quality with document type and decade of issue, ``unknown`` where there is none."""
    order = ["doc_id"] if "doc_id" in metadata.columns else ["loai_van_ban"]
    last = latest_per_key(metadata, "id", order)
    year = F.year("ngay_ban_hanh")
    rows = last.select(
        F.col("id").alias("__id"),
        or_unknown(F.col("loai_van_ban")).alias("__type"),
        F.when(year.isNull(), "unknown").otherwise(F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s"))).alias("__decade"),
    )
    joined = q.join(rows, q["doc_id"] == rows["__id"], "left")
    return joined.select(*q.columns, F.coalesce("__type", F.lit("unknown")).alias("loai_van_ban"), F.coalesce("__decade", F.lit("unknown")).alias("decade"))
