"""Queries of problem 6: references to records that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.operators.orphans import Entity, ForeignKey, orphan_cascade, orphan_report
from codexmill.sources.tables import table


def _documents(spark: SparkSession, d: str) -> Entity:
    df = table(spark, d, "documents").select("doc_id", "id", "ingested_at", "deleted_at")
    return Entity("documents", df, F.col("doc_id"), key="id", born="ingested_at", died="deleted_at")


def _relationships(spark: SparkSession, d: str) -> Entity:
    df = table(spark, d, "document_relationships").select("rel_id", "doc_id", "other_doc_id", "recorded_at")
    return Entity("document_relationships", df, F.col("rel_id"), at="recorded_at")


RELATIONS = [ForeignKey("document_relationships", "doc_id", "documents"), ForeignKey("document_relationships", "other_doc_id", "documents")]


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    found = orphan_cascade([_documents(spark, d), _relationships(spark, d)], RELATIONS)
    return found.filter(F.col("kind") == "direct").select(
        F.col("row_key").cast("bigint").alias("rel_id"), "field", F.date_format("at", "yyyy-MM").alias("period"), "reason"
    )


def p6_cascade_report(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "nodes").select("node_id", "doc_id", "parent_id")
    entities = [
        _documents(spark, d),
        _relationships(spark, d),
        Entity("nodes", nodes, F.col("node_id"), key="node_id"),
        Entity("blocks", table(spark, d, "blocks").select("doc_id", "dom_order"), F.concat_ws("#", "doc_id", "dom_order")),
        Entity("parse_quality", table(spark, d, "parse_quality").select("doc_id"), F.col("doc_id")),
    ]
    keys = [
        *RELATIONS,
        ForeignKey("nodes", "doc_id", "documents"),
        ForeignKey("nodes", "parent_id", "nodes"),
        ForeignKey("blocks", "doc_id", "documents"),
        ForeignKey("parse_quality", "doc_id", "documents"),
    ]
    return orphan_report(orphan_cascade(entities, keys))


QUERIES = {"p6_found": p6_found, "p6_cascade_report": p6_cascade_report}

_PARENTS = r"""
par AS (
  SELECT lower(regexp_replace(id, '^\s+|\s+$', '', 'g')) AS k, min(ingested_at) AS born, min(deleted_at) AS died
  FROM documents WHERE id IS NOT NULL AND regexp_replace(id, '^\s+|\s+$', '', 'g') <> '' GROUP BY 1
)"""

_DIRECT = r"""
refs AS (
  SELECT rel_id, field, recorded_at, lower(regexp_replace(k, '^\s+|\s+$', '', 'g')) AS k FROM (
    SELECT rel_id, 'doc_id' AS field, recorded_at, doc_id AS k FROM document_relationships
    UNION ALL SELECT rel_id, 'other_doc_id', recorded_at, other_doc_id FROM document_relationships) s
), direct AS (
  SELECT rel_id, field, recorded_at,
    CASE WHEN par.k IS NULL THEN 'missing' WHEN born > recorded_at THEN 'late' WHEN died <= recorded_at THEN 'deleted' END AS reason
  FROM refs LEFT JOIN par ON refs.k = par.k WHERE refs.k IS NOT NULL AND refs.k <> ''
)"""

ORACLES = {
    "p6_found": f"""WITH {_PARENTS}, {_DIRECT}
SELECT rel_id, field, strftime(recorded_at, '%Y-%m') AS period, reason FROM direct WHERE reason IS NOT NULL""",
    "p6_cascade_report": rf"""WITH RECURSIVE {_PARENTS}, {_DIRECT},
nd AS (
  SELECT node_id, lower(regexp_replace(node_id, '^\s+|\s+$', '', 'g')) AS own,
    lower(regexp_replace(doc_id, '^\s+|\s+$', '', 'g')) AS dk, nullif(lower(regexp_replace(parent_id, '^\s+|\s+$', '', 'g')), '') AS pk
  FROM nodes
), nodedirect AS (
  SELECT node_id, own, 'doc_id' AS field FROM nd WHERE dk <> '' AND dk NOT IN (SELECT k FROM par)
  UNION ALL
  SELECT node_id, own, 'parent_id' FROM nd WHERE pk IS NOT NULL AND pk NOT IN (SELECT own FROM nd)
), reach AS (
  SELECT node_id, own, pk FROM (SELECT nd.* FROM nd JOIN nodedirect d ON nd.node_id = d.node_id) x
  UNION
  SELECT nd.node_id, nd.own, nd.pk FROM nd JOIN reach ON nd.pk = reach.own
), alls AS (
  SELECT 'document_relationships' AS "table", field, strftime(recorded_at, '%Y-%m') AS period, reason, 'direct' AS kind FROM direct WHERE reason IS NOT NULL
  UNION ALL SELECT 'nodes', field, NULL, 'missing', 'direct' FROM nodedirect
  UNION ALL SELECT 'nodes', 'parent_id', NULL, 'inherited', 'inherited' FROM nd
    WHERE pk IN (SELECT own FROM reach) AND node_id NOT IN (SELECT node_id FROM nodedirect WHERE field = 'parent_id')
  UNION ALL SELECT 'blocks', 'doc_id', NULL, 'missing', 'direct' FROM blocks
    WHERE trim(doc_id) <> '' AND lower(trim(doc_id)) NOT IN (SELECT k FROM par)
  UNION ALL SELECT 'parse_quality', 'doc_id', NULL, 'missing', 'direct' FROM parse_quality
    WHERE trim(doc_id) <> '' AND lower(trim(doc_id)) NOT IN (SELECT k FROM par)
)
SELECT "table", field, period, reason, kind, count(*) AS n_references FROM alls GROUP BY ALL""",
}
