"""Queries of sources, joins, quality roll-ups and samples."""

from __future__ import annotations

import uuid
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.config import SAMPLE_DEV, SAMPLE_GOLDEN
from codexmill.functions.text import decade, markdown_cell, or_unknown, parse_date
from codexmill.operators import reports as R
from codexmill.operators.html import explode_blocks, flatten_documents
from codexmill.operators.sample import round_robin, two_samples
from codexmill.operators.validate import issues, verdict
from codexmill.plans.pipeline import classify_blocks, nodes_of
from codexmill.session import checkpoint_root, cut
from codexmill.sources.store import Store, columns, duplicate_keys, indexable, load_documents, with_missing
from codexmill.sources.tables import latest_per_key, lookup, pick, row_count, table
from codexmill.streaming.incremental import stream_into


def _quality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parse_quality").dropDuplicates()


def _as_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Documents with their dates as strings, as metadata deliver them."""
    docs = table(spark, d, "documents")
    dates = ("ngay_ban_hanh", "ngay_co_hieu_luc", "ngay_het_hieu_luc")
    return docs.select("doc_id", *[F.date_format(c, "d/M/yyyy").alias(c) if c in dates else F.col(c) for c in columns("documents")])


def documents_load(spark, d):
    loaded = load_documents(_as_metadata(spark, d))
    return loaded.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date" else F.col(c) for c, t in loaded.dtypes])


def lenient_dates(spark, d):
    """Dates in strings of several shapes, most of them dates, some not."""
    docs = table(spark, d, "documents").select("doc_id", "ngay_ban_hanh")
    shaped = F.when(F.col("doc_id") % 4 == 0, F.date_format("ngay_ban_hanh", "dd/MM/yyyy")).when(F.col("doc_id") % 4 == 1, F.date_format("ngay_ban_hanh", "d/M/yyyy")).when(
        F.col("doc_id") % 4 == 2, F.concat(F.lit("31/02/"), F.date_format("ngay_ban_hanh", "yyyy"))
    )
    return docs.select("doc_id", F.date_format(parse_date(shaped.otherwise(F.lit(""))), "yyyy-MM-dd").alias("parsed"), decade(shaped.otherwise(F.lit("x"))).alias("decade"))


def last_metadata(spark, d):
    docs = table(spark, d, "documents")
    return latest_per_key(docs.select("id", "doc_id", "title", "loai_van_ban", "ingested_at"), "id", ["ingested_at", "doc_id"])


def metadata_left_join(spark, d):
    last = latest_per_key(table(spark, d, "documents").select("id", "doc_id", "loai_van_ban"), "id", ["doc_id"])
    q = _quality(spark, d).select("doc_id", "verdict")
    joined = q.join(last.select(F.col("id").alias("k"), "loai_van_ban"), F.col("doc_id") == F.col("k"), "left")
    return joined.select("doc_id", "verdict", or_unknown(F.col("loai_van_ban")).alias("loai_van_ban"))


def index_gate_semi(spark, d):
    nodes = table(spark, d, "nodes").select("node_id", "doc_id")
    return nodes.join(indexable(table(spark, d, "parse_quality")), "doc_id", "left_semi")


def resume_anti(spark, d):
    ids = table(spark, d, "documents").select("id").distinct()
    loaded = table(spark, d, "nodes").select(F.col("doc_id").alias("id")).distinct()
    return ids.join(loaded, "id", "left_anti")


def missing_content(spark, d):
    docs = table(spark, d, "documents").filter(F.col("text").isNull()).select("id").distinct()
    content = table(spark, d, "documents").filter(F.col("text").isNotNull()).select("id").distinct()
    return docs.join(content, "id", "left_anti")


def wanted_blocks(spark, d):
    """Blocks of documents that failed, an empty list where there are none."""
    ids = table(spark, d, "parse_quality").filter(F.col("verdict") == "failed").select("doc_id").distinct()
    return with_missing(ids, table(spark, d, "blocks")).select("doc_id", "n_blocks")


def point_lookup(spark, d):
    docs = table(spark, d, "documents")
    first = docs.agg(F.min("doc_id")).first()[0]
    return lookup(docs, "doc_id", first).select("doc_id", "id", "title")


def in_list_scan(spark, d):
    wanted = table(spark, d, "parse_quality").filter(F.col("verdict") == "failed").select("doc_id")
    return pick(table(spark, d, "nodes"), "doc_id", wanted).select("node_id")


def footer_counts(spark, d):
    parts = [row_count(table(spark, d, t)).select(F.lit(t).alias("table"), "n_rows") for t in ("documents", "document_relationships", "nodes", "blocks")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def key_check(spark, d):
    return duplicate_keys(table(spark, d, "documents"), "id")


def relationship_degrees(spark, d):
    """Outgoing and incoming references of each document key."""
    rel = table(spark, d, "document_relationships")
    ends = F.explode(F.array(F.struct(F.col("doc_id").alias("k"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("other_doc_id").alias("k"), F.lit(0).alias("o"), F.lit(1).alias("i"))))
    rows = rel.select(ends.alias("e")).select("e.*").filter(F.col("k").isNotNull())
    return rows.groupBy(F.col("k").alias("doc_key")).agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def relationship_labels(spark, d):
    rel = table(spark, d, "document_relationships")
    return rel.groupBy(F.lower(or_unknown(F.col("relationship"))).alias("relationship")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_docs"))


def verdict_shares(spark, d):
    return R.verdict_shares(_quality(spark, d))


def quality_by_type(spark, d):
    return R.verdict_pivot(_quality(spark, d), or_unknown(F.col("loai_van_ban")), "loai_van_ban")


def quality_by_decade(spark, d):
    return R.verdict_pivot(_quality(spark, d), or_unknown(F.col("decade")), "decade")


def quality_by_template(spark, d):
    return R.verdict_pivot(_quality(spark, d), F.substring("template_family", 1, 80), "template", top=15)


def quality_grouping_sets(spark, d):
    return R.breakdown(_quality(spark, d))


def issue_combos_topk(spark, d):
    return R.issue_combinations(_quality(spark, d))


def issue_counts(spark, d):
    one = _quality(spark, d).select(F.explode(F.split("issues", ",")).alias("issue")).filter(F.col("issue") != "")
    return one.groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


def recomputed_verdicts(spark, d):
    q = _quality(spark, d)
    listed = issues(q)
    return q.select("doc_id", F.array_join(listed, ",").alias("issues"), verdict(listed).alias("verdict"), "n_nodes")


def verdict_transition(spark, d):
    """Stored verdicts against verdicts that ignore conflicts."""
    q = _quality(spark, d)
    new = q.withColumn("conflict_rate", F.lit(0.0))
    return R.transitions(q, new.withColumn("verdict", verdict(issues(new))))


def first_clean(spark, d):
    """The first fifteen clean documents that have nodes."""
    q = _quality(spark, d).filter((F.col("verdict") == "clean") & (F.col("n_nodes") > 0))
    return q.select("doc_id", "n_nodes").orderBy("doc_id").limit(15)


def stratified_round_robin(spark, d):
    return round_robin(table(spark, d, "documents").select("doc_id", "loai_van_ban", "lang"), "doc_id", ["loai_van_ban", "lang"], 200).select("doc_id", "turn")


STRATA = ("loai_van_ban", "decade", "template")


def dev_and_golden(spark, d):
    """The two samples in their full sizes over type, decade and class signature; documents that are not parsed have no signature."""
    parsed = _quality(spark, d).groupBy(F.col("doc_id").alias("id")).agg(F.min("template_family").alias("template"))
    year = F.year("ngay_ban_hanh")
    docs = table(spark, d, "documents").select("doc_id", "id", or_unknown(F.col("loai_van_ban")).alias("loai_van_ban"), F.when(year.isNull(), "unknown").otherwise(F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s"))).alias("decade"))
    return two_samples(docs.join(parsed, "id", "left"), "doc_id", list(STRATA), SAMPLE_DEV, SAMPLE_GOLDEN)


def report_cells(spark, d):
    return _quality(spark, d).select("doc_id", markdown_cell(F.col("template_family")).alias("cell"))


def quality_json(spark, d):
    """Rows as JSON, as the JSON sink writes them."""
    return _quality(spark, d).select("doc_id", F.to_json(F.struct("verdict", "n_nodes")).alias("json"))


def _fresh_store(spark: SparkSession) -> Store:
    store = Store(spark, f"{checkpoint_root(spark)}/store-{uuid.uuid4().hex}")
    store.create()
    return store


#: Columns whose contents are compared after a load.
LOADED = {
    "documents": ("id", "title", "so_ky_hieu", "ngay_ban_hanh", "loai_van_ban", "ngay_co_hieu_luc", "ngay_het_hieu_luc", "co_quan_ban_hanh", "nguoi_ky", "tinh_trang_hieu_luc"),
    "document_relationships": ("doc_id", "other_doc_id", "relationship"),
    "parse_quality": ("doc_id", "n_nodes", "sequence_ok", "hierarchy_ok", "part_count_ok", "table_preserved", "verdict", "issues", "loai_van_ban", "decade", "template_family"),
    "nodes": ("node_id", "doc_id", "part_id", "parent_id", "path", "depth", "order_index", "node_type", "number_raw", "number_norm", "heading", "text", "text_full", "breadcrumb", "html_raw", "classified_by"),
}


def _whole_sum(value: Column) -> Column:
    """Sum of non-negative longs, as a long. Past the largest long it goes on from the smallest (the sum modulo 2^64), so it depends on every row and never fails."""
    total = F.sum(value.cast("decimal(28,0)"))
    return ((total + Decimal(2**63)) % Decimal(2**64) - Decimal(2**63)).cast("bigint")


def _digest(df: DataFrame, name: str) -> DataFrame:
    """Rows of a table and the sum of the digests of their contents; of about 65,000 rows or more the sum no longer fits a long, see ``_whole_sum``."""
    row = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in LOADED[name]])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), _whole_sum(F.conv(F.substring(F.md5(row), 1, 12), 16, 10).cast("bigint")).alias("contents")).select(F.lit(name).alias("table"), "n_rows", "contents")


def store_load(spark, d):
    """Rows and contents of the store after a bulk load, and a node load that stopped half way and was resumed."""
    store = _fresh_store(spark)
    store.load("documents", load_documents(_as_metadata(spark, d)))
    store.load("document_relationships", table(spark, d, "document_relationships"))
    store.load("parse_quality", table(spark, d, "parse_quality"))
    nodes, wanted = table(spark, d, "nodes"), indexable(store.read("parse_quality"))
    store.load_nodes(nodes, wanted.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0))
    store.load_nodes(nodes, wanted)
    counts = [_digest(store.complete_nodes() if t == "nodes" else store.read(t), t) for t in LOADED]
    edges = row_count(store.read("edges")).select(F.lit("edges").alias("table"), "n_rows", F.lit(0).cast("bigint").alias("contents"))
    return reduce(DataFrame.unionByName, [*counts, edges])


def stream_load(spark, d):
    """Nodes of each type after a file stream has brought the blocks' documents into a store, run twice."""
    store = _fresh_store(spark)
    inbox = f"{store.folder}/inbox"
    table(spark, d, "blocks").select("doc_id", "dom_order", "html_raw").groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dom_order", "html_raw"))), lambda b: b["html_raw"]), "").alias("content_html")
    ).write.parquet(inbox)

    def parse(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        flat = cut(flatten_documents(batch, "doc_id", "content_html"))
        return nodes_of(classify_blocks(explode_blocks(flat))), flat.select("doc_id")

    for _ in range(2):
        stream_into(spark, inbox, "doc_id string, content_html string", store, parse, f"{store.folder}/progress").awaitTermination()
    return store.complete_nodes().groupBy("node_type").agg(F.count(F.lit(1)).alias("n_nodes"), F.count_distinct("doc_id").alias("n_docs"))


QUERIES = {
    f.__name__: f
    for f in (
        documents_load, lenient_dates, last_metadata, metadata_left_join, index_gate_semi, resume_anti, missing_content, wanted_blocks, point_lookup, in_list_scan, footer_counts, key_check,
        relationship_degrees, relationship_labels, verdict_shares, quality_by_type, quality_by_decade, quality_by_template, quality_grouping_sets, issue_combos_topk, issue_counts,
        recomputed_verdicts, verdict_transition, first_clean, stratified_round_robin, dev_and_golden, report_cells, quality_json, store_load, stream_load,
    )
}

_Q = "q AS (SELECT DISTINCT * FROM parse_quality)"
_COLS = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" if c.startswith("ngay_") else c for c in columns("documents"))
_PIVOT = "count(*) FILTER (verdict = 'clean') AS clean, count(*) FILTER (verdict = 'warn') AS warn, count(*) FILTER (verdict = 'failed') AS failed, count(*) AS total"
_ISSUES = """concat_ws(',', CASE WHEN char_coverage < 0.97 THEN 'char_coverage' END, CASE WHEN NOT sequence_ok THEN 'sequence' END, CASE WHEN NOT hierarchy_ok THEN 'hierarchy' END,
 CASE WHEN NOT part_count_ok THEN 'part_count' END, CASE WHEN NOT table_preserved THEN 'table_preserved' END, CASE WHEN {c} >= 0.05 THEN 'conflict_rate' END)"""
_VERDICT = "CASE WHEN char_coverage < 0.90 THEN 'failed' WHEN {i} = '' THEN 'clean' ELSE 'warn' END"


def _robin(source: str, n: int, seed: int, strata: tuple[str, ...] = ("loai_van_ban", "lang")) -> str:
    label = " || '|' || ".join(f"coalesce({c}, '')" for c in strata)
    return f"""SELECT doc_id, turn FROM (SELECT doc_id, row_number() OVER (PARTITION BY {', '.join(strata)} ORDER BY md5(doc_id || ':{seed}'), doc_id) AS turn, md5({label} || ':{seed}') AS lot FROM {source}) x ORDER BY turn, lot, doc_id LIMIT {n}"""


_SOURCES = {"nodes": "(SELECT * FROM nodes WHERE doc_id IN (SELECT doc_id FROM parse_quality WHERE verdict IN ('clean', 'warn'))) x"}


def _row(name: str) -> str:
    return " || chr(31) || ".join(f"coalesce({c}::varchar, chr(0))" for c in LOADED[name])


ORACLES = {
    "documents_load": f"SELECT {_COLS} FROM documents",
    "lenient_dates": """WITH s AS (SELECT doc_id, coalesce(CASE doc_id % 4 WHEN 0 THEN strftime(ngay_ban_hanh, '%d/%m/%Y') WHEN 1 THEN strftime(ngay_ban_hanh, '%-d/%-m/%Y') WHEN 2 THEN '31/02/' || strftime(ngay_ban_hanh, '%Y') ELSE '' END, NULL) AS s FROM documents)
SELECT doc_id, strftime(try_strptime(s, '%d/%m/%Y'), '%Y-%m-%d') AS parsed, CASE WHEN doc_id % 4 < 3 AND regexp_extract(s, '([0-9]{4})$', 1) <> '' THEN substr(regexp_extract(s, '([0-9]{4})$', 1), 1, 3) || '0s' ELSE 'unknown' END AS decade FROM s""",
    "last_metadata": "SELECT id, doc_id, title, loai_van_ban, ingested_at FROM documents WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, doc_id DESC) = 1",
    "metadata_left_join": f"WITH {_Q}, m AS (SELECT id, loai_van_ban FROM documents WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY doc_id DESC) = 1) SELECT q.doc_id, q.verdict, coalesce(nullif(m.loai_van_ban, ''), 'unknown') AS loai_van_ban FROM (SELECT doc_id, verdict FROM q) q LEFT JOIN m ON q.doc_id = m.id",
    "index_gate_semi": "SELECT node_id, doc_id FROM nodes WHERE doc_id IN (SELECT doc_id FROM parse_quality WHERE verdict IN ('clean', 'warn'))",
    "resume_anti": "SELECT DISTINCT id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM nodes n WHERE n.doc_id = d.id)",
    "missing_content": "SELECT DISTINCT id FROM documents d WHERE text IS NULL AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.id = d.id AND e.text IS NOT NULL)",
    "wanted_blocks": "SELECT i.doc_id, count(b.dom_order)::int AS n_blocks FROM (SELECT DISTINCT doc_id FROM parse_quality WHERE verdict = 'failed') i LEFT JOIN blocks b ON i.doc_id = b.doc_id GROUP BY 1",
    "point_lookup": "SELECT doc_id, id, title FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents)",
    "in_list_scan": "SELECT node_id FROM nodes WHERE doc_id IN (SELECT doc_id FROM parse_quality WHERE verdict = 'failed')",
    "footer_counts": "SELECT 'documents' AS \"table\", count(*) AS n_rows FROM documents UNION ALL SELECT 'document_relationships', count(*) FROM document_relationships UNION ALL SELECT 'nodes', count(*) FROM nodes UNION ALL SELECT 'blocks', count(*) FROM blocks",
    "key_check": "SELECT id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "relationship_degrees": "SELECT k AS doc_key, sum(o)::bigint AS n_out, sum(i)::bigint AS n_in FROM (SELECT doc_id AS k, 1 AS o, 0 AS i FROM document_relationships UNION ALL SELECT other_doc_id, 0, 1 FROM document_relationships) x WHERE k IS NOT NULL GROUP BY 1",
    "relationship_labels": "SELECT lower(coalesce(nullif(relationship, ''), 'unknown')) AS relationship, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM document_relationships GROUP BY 1",
    "verdict_shares": f"WITH {_Q} SELECT verdict, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM q GROUP BY 1",
    "quality_by_type": f"WITH {_Q} SELECT coalesce(nullif(loai_van_ban, ''), 'unknown') AS loai_van_ban, {_PIVOT} FROM q GROUP BY 1",
    "quality_by_decade": f"WITH {_Q} SELECT coalesce(nullif(decade, ''), 'unknown') AS decade, {_PIVOT} FROM q GROUP BY 1",
    "quality_by_template": f"WITH {_Q} SELECT substr(template_family, 1, 80) AS template, {_PIVOT} FROM q GROUP BY 1 ORDER BY total DESC, template LIMIT 15",
    "quality_grouping_sets": f"WITH {_Q}, s AS (SELECT coalesce(nullif(loai_van_ban, ''), 'unknown') AS loai_van_ban, coalesce(nullif(decade, ''), 'unknown') AS decade, substr(template_family, 1, 80) AS template, verdict FROM q) SELECT grouping(loai_van_ban, decade, template, verdict)::bigint AS gid, loai_van_ban, decade, template, verdict, count(*) AS n FROM s GROUP BY GROUPING SETS ((loai_van_ban, verdict), (decade, verdict), (template, verdict))",
    "issue_combos_topk": f"WITH {_Q} SELECT coalesce(nullif(issues, ''), 'none') AS combination, count(*) AS n, min(doc_id) AS example FROM q GROUP BY 1 ORDER BY n DESC, combination LIMIT 20",
    "issue_counts": f"WITH {_Q} SELECT issue, count(*) AS n FROM (SELECT unnest(string_split(issues, ',')) AS issue FROM q) x WHERE issue <> '' GROUP BY 1",
    "recomputed_verdicts": f"WITH {_Q} SELECT doc_id, {_ISSUES.format(c='conflict_rate')} AS issues, {_VERDICT.format(i=_ISSUES.format(c='conflict_rate'))} AS verdict, n_nodes FROM q",
    "verdict_transition": f"WITH {_Q}, n AS (SELECT doc_id, {_VERDICT.format(i=_ISSUES.format(c='0.0'))} AS after FROM q) SELECT q.verdict AS before, n.after, count(*) AS n FROM q JOIN n ON q.doc_id = n.doc_id GROUP BY 1, 2",
    "first_clean": f"WITH {_Q} SELECT doc_id, n_nodes FROM q WHERE verdict = 'clean' AND n_nodes > 0 ORDER BY doc_id LIMIT 15",
    "stratified_round_robin": _robin("documents", 200, 42),
    "dev_and_golden": f"""WITH t AS (SELECT doc_id AS id, min(template_family) AS template FROM parse_quality GROUP BY 1),
s AS (SELECT d.doc_id, coalesce(nullif(loai_van_ban, ''), 'unknown') AS loai_van_ban, CASE WHEN ngay_ban_hanh IS NULL THEN 'unknown' ELSE (floor(year(ngay_ban_hanh) / 10) * 10)::bigint || 's' END AS decade, template FROM documents d LEFT JOIN t ON d.id = t.id),
a AS ({_robin('s', SAMPLE_DEV, 42, STRATA)}), r AS (SELECT * FROM s WHERE doc_id NOT IN (SELECT doc_id FROM a)), b AS ({_robin('r', SAMPLE_GOLDEN, 43, STRATA)}) SELECT doc_id, 'dev' AS sample FROM a UNION ALL SELECT doc_id, 'golden' FROM b""",
    "report_cells": f"WITH {_Q} SELECT doc_id, substr(replace(replace(template_family, '|', '/'), chr(10), ' '), 1, 80) AS cell FROM q",
    "store_load": " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n_rows, sum(('0x' || substr(md5({_row(t)}), 1, 12))::bigint)::bigint AS contents FROM {_SOURCES.get(t, t)}" for t in LOADED
    )
    + " UNION ALL SELECT 'edges', 0, 0",
    "quality_json": f"WITH {_Q} SELECT doc_id, '{{\"verdict\":\"' || verdict || '\",\"n_nodes\":' || n_nodes || '}}' AS json FROM q",
}
