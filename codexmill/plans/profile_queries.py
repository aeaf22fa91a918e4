"""Queries of corpus profiling, on blocks and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.functions.text import or_unknown
from codexmill.operators import profile as P
from codexmill.sources.tables import table


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "blocks")


def class_stats(spark, d):
    return P.class_stats(_blocks(spark, d))


def class_tags(spark, d):
    return P.class_tags(_blocks(spark, d))


def top_classes(spark, d):
    return P.top_classes(P.class_stats(_blocks(spark, d))).select("class", "total")


def top_indents(spark, d):
    return P.top_indents(_blocks(spark, d))


def class_samples(spark, d):
    return P.class_samples(_blocks(spark, d))


def class_crosstab(spark, d):
    return P.crosstab(_blocks(spark, d))


def class_majority(spark, d):
    return P.class_map(P.crosstab(_blocks(spark, d)))


def class_agreement(spark, d):
    return P.agreement(P.crosstab(_blocks(spark, d)))


def type_rates(spark, d):
    return P.type_rates(_blocks(spark, d))


def multi_part_rate(spark, d):
    return P.multi_part_rate(_blocks(spark, d))


def presence_rates(spark, d):
    return P.presence_rates(_blocks(spark, d))


def template_family(spark, d):
    return P.template_families(_blocks(spark, d))


def top_templates(spark, d):
    return P.top_templates(P.template_families(_blocks(spark, d)))


def length_percentiles(spark, d):
    docs = table(spark, d, "documents").select(or_unknown(F.col("loai_van_ban")).alias("loai_van_ban"), "n_chars")
    return P.percentiles(docs, "loai_van_ban", "n_chars")


def decade_percentiles(spark, d):
    year = F.year("ngay_ban_hanh")
    decade = F.when(year.isNull(), "unknown").otherwise(F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s")))
    return P.percentiles(table(spark, d, "documents").select(decade.alias("decade"), "n_chars"), "decade", "n_chars")


def article_percentiles(spark, d):
    """Articles in each parsed document, by type."""
    nodes = table(spark, d, "nodes").groupBy("doc_id").agg(F.count_if(F.col("node_type") == "dieu").alias("n_dieu"))
    types = table(spark, d, "parse_quality").select("doc_id", or_unknown(F.col("loai_van_ban")).alias("loai_van_ban")).distinct()
    return P.percentiles(nodes.join(types, "doc_id"), "loai_van_ban", "n_dieu")


QUERIES = {
    f.__name__: f
    for f in (
        class_stats, class_tags, top_classes, top_indents, class_samples, class_crosstab, class_majority, class_agreement, type_rates, multi_part_rate, presence_rates,
        template_family, top_templates, length_percentiles, decade_percentiles, article_percentiles,
    )
}

_E = "e AS (SELECT doc_id, dom_order, tag, style_indent, is_bold, text, unnest(classes) AS class FROM blocks)"
# The line patterns of profiling; a clause needs a full stop.
_KIND = r"""CASE WHEN regexp_matches(text, '(?i)^[\s\p{Z}]*Điều[\s\p{Z}]+\p{Nd}+[a-zđ]?[.\s\p{Z}]') THEN 'dieu' WHEN regexp_matches(text, '(?i)^[\s\p{Z}]*Chương[\s\p{Z}]+[IVXLC]+') THEN 'chuong'
  WHEN regexp_matches(text, '(?i)^[\s\p{Z}]*Mục[\s\p{Z}]+\p{Nd}+') THEN 'muc' WHEN regexp_matches(text, '^[\s\p{Z}]*\p{Nd}+\.[\s\p{Z}]') THEN 'khoan' WHEN regexp_matches(text, '^[\s\p{Z}]*[a-zđ]\)[\s\p{Z}]') THEN 'diem' END"""
_C = f"k AS (SELECT class, {_KIND} AS type FROM e), c AS (SELECT class, type, count(*) AS n FROM k WHERE type IS NOT NULL GROUP BY 1, 2)"


def _percentile(source: str, group: str, value: str) -> str:
    return f"""WITH s AS ({source}), l AS (SELECT {group}, list_sort(list({value})) AS v FROM s WHERE {value} IS NOT NULL GROUP BY 1)
SELECT {group}, v[least(len(v) - 1, floor(len(v) * 0.5)::bigint) + 1] AS p50, v[least(len(v) - 1, floor(len(v) * 0.9)::bigint) + 1] AS p90, v[len(v)] AS max_value, len(v) AS n FROM l"""


_FAMILY = "SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(flatten(list(classes)))), '|'), '') AS template_family FROM blocks GROUP BY 1"
_HAS = "regexp_matches(text, '(?i)^[\\s\\p{Z}]*Điều[\\s\\p{Z}]+\\p{Nd}+[a-zđ]?[.\\s\\p{Z}]')"

ORACLES = {
    "class_stats": f"WITH {_E} SELECT class, count(*) AS total, count(*) FILTER (is_bold) AS bold, count(DISTINCT tag) AS n_tags, count(DISTINCT style_indent) AS n_indents FROM e GROUP BY 1",
    "class_tags": f"WITH {_E} SELECT class, tag, count(*) AS n FROM e GROUP BY 1, 2",
    "top_classes": f"WITH {_E} SELECT class, count(*) AS total FROM e GROUP BY 1 ORDER BY total DESC, class LIMIT 200",
    "top_indents": f"WITH {_E}, i AS (SELECT class, style_indent, count(*) AS n FROM e WHERE style_indent IS NOT NULL GROUP BY 1, 2) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY n DESC, style_indent) AS rank FROM i) x WHERE rank <= 5",
    "class_samples": f"WITH {_E} SELECT class, nth, substr(text, 1, 200) AS sample FROM (SELECT class, text, row_number() OVER (PARTITION BY class ORDER BY doc_id, dom_order, text) AS nth FROM e) x WHERE nth <= 3",
    "class_crosstab": f"WITH {_E}, {_C} SELECT * FROM c",
    "class_majority": f"WITH {_E}, {_C} SELECT class, arg_min(type, (-n, type)) AS type, max(n) / sum(n) AS purity, sum(n)::bigint AS n FROM c GROUP BY 1",
    "class_agreement": f"WITH {_E}, {_C}, p AS (SELECT max(n) AS best, sum(n) AS n FROM c GROUP BY class) SELECT sum(best) / sum(n) AS agreement FROM p",
    "type_rates": r"""WITH p AS (SELECT doc_id, bool_or(regexp_matches(text, '(?i)^[\s\p{Z}]*Điều[\s\p{Z}]+\p{Nd}+[a-zđ]?[.\s\p{Z}]')) AS a, bool_or(regexp_matches(text, '(?i)^[\s\p{Z}]*Chương[\s\p{Z}]+[IVXLC]+')) AS b,
  bool_or(regexp_matches(text, '(?i)^[\s\p{Z}]*Mục[\s\p{Z}]+\p{Nd}+')) AS c, bool_or(regexp_matches(text, '^[\s\p{Z}]*\p{Nd}+\.[\s\p{Z}]')) AS k, bool_or(regexp_matches(text, '^[\s\p{Z}]*[a-zđ]\)[\s\p{Z}]')) AS m FROM blocks GROUP BY 1)
SELECT count(*) AS n_docs, avg(a::int) AS rate_dieu, avg(b::int) AS rate_chuong, avg(c::int) AS rate_muc, avg(k::int) AS rate_khoan, avg(m::int) AS rate_diem FROM p""",
    "multi_part_rate": f"""WITH n AS (SELECT doc_id, dom_order, CASE WHEN {_HAS} THEN translate(regexp_extract(text, '(?i)^[\\s\\p{{Z}}]*Điều[\\s\\p{{Z}}]+(\\p{{Nd}}+)', 1), '０１２３４５６７８９', '0123456789')::int END AS num, regexp_matches(text, '(?i)\\(Ban hành kèm theo') AS marker FROM blocks),
a AS (SELECT doc_id, num < lag(num) OVER (PARTITION BY doc_id ORDER BY dom_order) AS down FROM n WHERE num IS NOT NULL),
p AS (SELECT n.doc_id, bool_or(marker) OR coalesce((SELECT bool_or(down) FROM a WHERE a.doc_id = n.doc_id), false) AS multi FROM n GROUP BY 1)
SELECT count(*) AS n_docs, avg(multi::int) AS rate FROM p""",
    "presence_rates": "WITH p AS (SELECT doc_id, bool_or(is_table) AS t, bool_or(contains(lower(html_raw), '<img')) AS i, bool_or(len(anchors) > 0) AS a FROM blocks GROUP BY 1) SELECT count(*) AS n_docs, avg(coalesce(t, false)::int) AS with_table, avg(coalesce(i, false)::int) AS with_image, avg(coalesce(a, false)::int) AS with_link FROM p",
    "template_family": _FAMILY,
    "top_templates": f"WITH f AS ({_FAMILY}) SELECT substr(template_family, 1, 300) AS template, count(*) AS n FROM f GROUP BY 1 ORDER BY n DESC, template LIMIT 15",
    "length_percentiles": _percentile("SELECT coalesce(nullif(loai_van_ban, ''), 'unknown') AS loai_van_ban, n_chars FROM documents", "loai_van_ban", "n_chars"),
    "decade_percentiles": _percentile("SELECT CASE WHEN ngay_ban_hanh IS NULL THEN 'unknown' ELSE (floor(year(ngay_ban_hanh) / 10) * 10)::bigint || 's' END AS decade, n_chars FROM documents", "decade", "n_chars"),
    "article_percentiles": _percentile("SELECT loai_van_ban, n_dieu FROM (SELECT doc_id, count(*) FILTER (node_type = 'dieu') AS n_dieu FROM nodes GROUP BY 1) a JOIN (SELECT DISTINCT doc_id, coalesce(nullif(loai_van_ban, ''), 'unknown') AS loai_van_ban FROM parse_quality) b USING (doc_id)", "loai_van_ban", "n_dieu"),
}
