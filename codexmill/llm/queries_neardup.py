"""Queries of problem 1: near-duplicate articles and titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.llm.neardup import all_pairs, classes
from codexmill.sources.tables import table

THRESHOLD = 0.70
LEAST_CHARACTERS = 300


def _rows(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "nodes").filter((F.col("node_type") == "dieu") & (F.length("text_full") >= LEAST_CHARACTERS))
    nodes = nodes.select(F.lit("nodes.text_full").alias("field"), F.col("node_id").alias("key"), F.col("text_full").alias("text"))
    titles = table(spark, d, "documents").select(F.lit("documents.title").alias("field"), F.col("id").alias("key"), F.col("title").alias("text"))
    return nodes.unionByName(titles)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return all_pairs(_rows(spark, d), THRESHOLD)


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    return classes(_rows(spark, d), THRESHOLD)


QUERIES = {"p1_found": p1_found, "p1_classes": p1_classes}
ORACLES = {
    "p1_found": r"""WITH t AS (
  SELECT 'nodes.text_full' AS field, node_id AS k, text_full AS t FROM nodes WHERE node_type = 'dieu' AND length(text_full) >= 300
  UNION SELECT 'documents.title', id, title FROM documents WHERE title IS NOT NULL AND id IS NOT NULL
), n AS (SELECT row_number() OVER () AS r, field, k, trim(regexp_replace(lower(t), '[\s\p{Z}\x{85}]+', ' ', 'g')) AS t FROM t),
g AS (SELECT DISTINCT r, hash(field, substr(t, p, 5)) AS h FROM (SELECT r, field, t, unnest(range(1, length(t) - 3)) AS p FROM n) x),
c AS (SELECT r, count(*) AS n FROM g GROUP BY 1),
b AS (SELECT a.r AS x, b.r AS y, count(*) AS shared FROM g a JOIN g b ON a.h = b.h AND a.r < b.r GROUP BY 1, 2)
SELECT DISTINCT n1.field, least(n1.k, n2.k) AS key_a, greatest(n1.k, n2.k) AS key_b
FROM b JOIN c c1 ON c1.r = x JOIN c c2 ON c2.r = y JOIN n n1 ON n1.r = x JOIN n n2 ON n2.r = y
WHERE shared * 10 >= 7 * (c1.n + c2.n - shared) AND n1.field = n2.field AND n1.k <> n2.k""",
    # Classes of equal texts, compared once each.
    "p1_classes": r"""WITH t AS (
  SELECT 'nodes.text_full' AS field, node_id AS k, text_full AS t FROM nodes WHERE node_type = 'dieu' AND length(text_full) >= 300
  UNION ALL SELECT 'documents.title', id, title FROM documents WHERE title IS NOT NULL AND id IS NOT NULL
), n AS (SELECT field, k, trim(regexp_replace(lower(t), '[\s\p{Z}\x{85}]+', ' ', 'g')) AS t FROM t),
m AS (SELECT * FROM n WHERE length(t) >= 5),
k AS (SELECT row_number() OVER () AS r, field, t, min(k) AS class_id, count(*) AS n_copies FROM m GROUP BY field, t),
g AS (SELECT DISTINCT r, hash(field, substr(t, p, 5)) AS h FROM (SELECT r, field, t, unnest(range(1, length(t) - 3)) AS p FROM k) x),
c AS (SELECT r, count(*) AS n FROM g GROUP BY 1),
b AS (SELECT a.r AS x, b.r AS y, count(*) AS shared FROM g a JOIN g b ON a.h = b.h AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT x, y FROM b JOIN c c1 ON c1.r = x JOIN c c2 ON c2.r = y JOIN k k1 ON k1.r = x JOIN k k2 ON k2.r = y WHERE shared * 10 >= 7 * (c1.n + c2.n - shared) AND k1.field = k2.field),
d AS (SELECT r, count(*) AS n_links FROM (SELECT x AS r FROM l UNION ALL SELECT y FROM l) s GROUP BY 1)
SELECT m.field, m.k AS key, k.class_id, k.n_copies, coalesce(d.n_links, 0) AS n_links FROM m JOIN k ON m.field = k.field AND m.t = k.t LEFT JOIN d ON d.r = k.r""",
}
