"""Queries on blocks and nodes: parts, masks, classification, trees, sequence checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codexmill.functions.text import doc_slug, solid, strip
from codexmill.operators.classify import apply_mask, cascade, class_tier, pattern_tier
from codexmill.operators.html import clean_text
from codexmill.operators.profile import class_map, crosstab
from codexmill.operators.reports import transitions
from codexmill.operators.sequence import context, heading_signals, mask_quotes, split_parts
from codexmill.operators.tree import FOOTER, mark_nodes, outline, rank_of, subtree, with_ancestors
from codexmill.operators.validate import hierarchy_ok, sequence_ok
from codexmill.plans.profiling import CorpusProfile
from codexmill.plans.pipeline import classify_blocks, nodes_of, parse_documents
from codexmill.session import cut
from codexmill.sources.tables import table


def _blocks(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "blocks").select("doc_id", "dom_order", *columns)


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "nodes")
    return nodes.withColumn("part_no", F.regexp_extract("part_id", r"(\d+)$", 1).cast("int"))


def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d, "text").select("doc_id", "dom_order", strip(clean_text(F.col("text"))).alias("clean"))


def line_blocks(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    lines = lines.withColumn("line", strip(F.col("line"))).filter(F.col("line") != "")
    return lines.select("doc_id", "line_no", F.length("line").alias("n_chars"), F.length(solid(F.col("line"))).alias("n_solid"))


def heading_lookahead(spark: SparkSession, d: str) -> DataFrame:
    return heading_signals(_blocks(spark, d, "text")).filter("is_heading").select("doc_id", "dom_order")


def parts(spark: SparkSession, d: str) -> DataFrame:
    return split_parts(_blocks(spark, d, "text")).select("doc_id", "dom_order", "part_no", "part_id", "part_heading", "is_main")


def part_ranges(spark: SparkSession, d: str) -> DataFrame:
    placed = split_parts(_blocks(spark, d, "text"))
    return placed.groupBy("doc_id", "part_no").agg(F.min("dom_order").alias("start_block"), F.max("dom_order").alias("end_block"), F.min("part_heading").alias("heading"))


# A document with quotations that go on over blocks, once closed and once not; the test tables have none.
QUOTED = ['Điều 1. a', '1. b "c', '2. d', '3. e" f', '4. g "h" i', 'Điều 2. "j', 'a) k', '5. l', 'b) m', '"Chương I" n', 'Mục 1']


def _with_quoted(spark: SparkSession, d: str) -> DataFrame:
    """Stored blocks and those of a document with odd quotation marks."""
    quoted = spark.createDataFrame([("quoted", i, t) for i, t in enumerate(QUOTED)], "doc_id string, dom_order int, text string")
    return _blocks(spark, d, "text").unionByName(quoted)


def quote_parity_mask(spark: SparkSession, d: str) -> DataFrame:
    one = _with_quoted(spark, d).withColumns({"part_no": F.lit(1), "text": F.translate("text", "“”", '""')})
    return mask_quotes(one).filter("is_masked").select("doc_id", "dom_order")


def pattern_types(spark: SparkSession, d: str) -> DataFrame:
    kind, number = pattern_tier(F.col("text"))
    return _blocks(spark, d, "text").select("doc_id", "dom_order", kind.alias("node_type"), number.alias("number_raw")).filter(F.col("node_type").isNotNull())


def classify_cascade(spark: SparkSession, d: str) -> DataFrame:
    blocks = _blocks(spark, d, "text", "classes", "tag", "style_indent", "is_bold")
    typed = cascade(class_tier(blocks, class_map(crosstab(blocks))))
    return typed.select("doc_id", "dom_order", "node_type", "number_raw", "confidence", "classified_by", "conflict")


def judge_context(spark: SparkSession, d: str) -> DataFrame:
    shown = context(_blocks(spark, d, "text").withColumn("part_no", F.lit(1)))
    return shown.select("doc_id", "dom_order", "before", "shown", "after")


def footer_lines(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d, "text").filter(F.col("text").rlike(FOOTER)).select("doc_id", "dom_order")


def parent_previous_smaller(spark: SparkSession, d: str) -> DataFrame:
    """Parents found again from the order and the levels of stored nodes."""
    nodes = _nodes(spark, d).withColumn("rank", rank_of(F.col("node_type")))
    found = with_ancestors(nodes, ["node_id"], "__a")
    return found.select("node_id", F.try_element_at("__a", F.lit(-1))["node_id"].alias("parent_id"), F.size("__a").alias("depth"))


def text_full_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Length of each node's text with all nodes below, by exploding ancestors once."""
    nodes = _nodes(spark, d).withColumn("rank", rank_of(F.col("node_type")))
    found = with_ancestors(nodes, ["node_id"], "__a")
    given = found.withColumn("__to", F.concat(F.array("node_id"), F.transform("__a", lambda x: x["node_id"])))
    given = given.select(F.explode("__to").alias("node_id"), F.length("text").alias("n"))
    return given.groupBy("node_id").agg((F.sum("n") + F.count(F.lit(1)) - 1).alias("n_chars"), F.count(F.lit(1)).alias("n_nodes"))


def node_breadcrumbs(spark: SparkSession, d: str) -> DataFrame:
    nodes = _nodes(spark, d).withColumns({"rank": rank_of(F.col("node_type")), "crumb": F.substring("text", 1, 60)})
    found = with_ancestors(nodes, ["crumb"], "__a")
    return found.select("node_id", F.concat_ws(" › ", F.transform("__a", lambda x: x["crumb"]), "crumb").alias("breadcrumb"))


def sibling_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Ordinals of siblings of one type and how often a number came before under the same parent."""
    own = W.partitionBy("doc_id", "part_id", "parent_id", "node_type")
    return table(spark, d, "nodes").select(
        "node_id",
        F.row_number().over(own.orderBy("order_index")).alias("ordinal"),
        F.row_number().over(W.partitionBy("doc_id", "part_id", "parent_id", "node_type", "number_norm").orderBy("order_index")).alias("repeat"),
    )


def subtree_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Size of the subtree below each article, by the prefix test on ids."""
    nodes = table(spark, d, "nodes").select("doc_id", "node_id", "node_type")
    roots = nodes.filter(F.col("node_type") == "dieu").select(F.col("doc_id").alias("d2"), F.col("node_id").alias("root"))
    below = roots.join(nodes, (F.col("d2") == F.col("doc_id")) & F.col("node_id").startswith(F.concat("root", F.lit("/"))))
    return below.groupBy("root").agg(F.count(F.lit(1)).alias("n_below"))


def subtree_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The subtree of the first chapter in order of ids."""
    nodes = table(spark, d, "nodes")
    first = nodes.filter(F.col("node_type") == "chuong").agg(F.min("node_id")).first()[0] or ""
    return subtree(nodes, first).select("node_id", "depth", "order_index")


def outlines(spark: SparkSession, d: str) -> DataFrame:
    return outline(table(spark, d, "nodes"))


def sequence_check(spark: SparkSession, d: str) -> DataFrame:
    return sequence_ok(_nodes(spark, d))


def hierarchy_check(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy_ok(table(spark, d, "nodes"))


def slugs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "id", "so_ky_hieu")
    return docs.select("doc_id", doc_slug(F.col("so_ky_hieu"), F.coalesce("id", F.lit(""))).alias("slug"))


def full_tree(spark: SparkSession, d: str) -> DataFrame:
    """Trees built from stored blocks."""
    blocks = _blocks(spark, d, "text", "tag", "classes", "style_indent", "is_bold", "is_table", "html_raw")
    return nodes_of(classify_blocks(blocks), table(spark, d, "documents"))


def _content(spark: SparkSession, d: str) -> DataFrame:
    """HTML of whole documents, put together from their blocks."""
    blocks = _blocks(spark, d, "html_raw").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("dom_order", "html_raw"))).alias("b"))
    return blocks.select("doc_id", F.array_join(F.transform("b", lambda x: x["html_raw"]), "").alias("content_html"))


def full_parse(spark: SparkSession, d: str) -> DataFrame:
    return parse_documents(_content(spark, d), "doc_id", "content_html", table(spark, d, "documents"))[0]


def full_quality(spark: SparkSession, d: str) -> DataFrame:
    return parse_documents(_content(spark, d), "doc_id", "content_html", table(spark, d, "documents"))[1]


def tree_marks(spark: SparkSession, d: str) -> DataFrame:
    """What each block does in its tree and which node it belongs to."""
    return mark_nodes(classify_blocks(_blocks(spark, d, "text"))).select("doc_id", "dom_order", "part_no", "role", "target")


def corpus_profile(spark: SparkSession, d: str) -> DataFrame:
    return CorpusProfile(_content(spark, d), "doc_id", "content_html").summary()


def profile_class_map(spark: SparkSession, d: str) -> DataFrame:
    """Class map learned from raw HTML."""
    return CorpusProfile(_content(spark, d), "doc_id", "content_html").class_map()


def offline_judge(before: str, text: str, after: str) -> dict | None:
    """A judge with fixed rules in place of a model: it answers, abstains, gives a type that is not permitted, and fails."""
    if text.endswith(";"):
        return {"node_type": "gach_dau_dong", "number_raw": None, "confidence": 0.6}
    if text.endswith(":"):
        return {"node_type": "poem", "number_raw": None, "confidence": 0.9}
    if not before:
        raise TimeoutError("no answer")
    if after.startswith("Điều"):
        return {"node_type": "muc", "number_raw": str(len(text)), "confidence": 0.55}
    return None


def judged_types(spark: SparkSession, d: str) -> DataFrame:
    """Classification after a judge was asked about blocks without a type or with a conflict."""
    blocks = _blocks(spark, d, "text", "classes", "tag", "style_indent", "is_bold")
    typed = classify_blocks(blocks, class_map(crosstab(blocks)), offline_judge)
    return typed.select("doc_id", "dom_order", "node_type", "number_raw", "confidence", "classified_by")


def judged_transition(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts before and after documents are validated again with a judge."""
    content, docs = cut(_content(spark, d)), table(spark, d, "documents")
    old, new = (parse_documents(content, "doc_id", "content_html", docs, provider=p)[1] for p in (None, offline_judge))
    return transitions(old, new)


def full_tree_with_classes(spark: SparkSession, d: str) -> DataFrame:
    """Trees with the class tier: the map is learned from the same blocks."""
    blocks = _blocks(spark, d, "text", "tag", "classes", "style_indent", "is_bold", "is_table", "html_raw")
    return nodes_of(classify_blocks(blocks, class_map(crosstab(blocks))), table(spark, d, "documents"))


def masked_types(spark: SparkSession, d: str) -> DataFrame:
    """Types that quotation masks take away."""
    parted = split_parts(_with_quoted(spark, d)).withColumn("class_type", F.lit(None).cast("string"))
    masked = apply_mask(mask_quotes(cascade(parted)))
    return masked.filter(F.col("is_masked") & F.col("raw_type").isNotNull()).groupBy("raw_type").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_text, line_blocks, heading_lookahead, parts, part_ranges, quote_parity_mask, pattern_types, classify_cascade, judge_context, footer_lines,
        parent_previous_smaller, text_full_rollup, node_breadcrumbs, sibling_numbers, subtree_prefix, subtree_lookup, outlines, sequence_check, hierarchy_check,
        slugs, tree_marks, full_tree, full_tree_with_classes, full_parse, corpus_profile, profile_class_map, full_quality, masked_types, judged_types, judged_transition,
    )
}

_HEADING = r"regexp_matches(regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '(?i)^(QUY ĐỊNH|QUY CHẾ|ĐIỀU LỆ|DANH MỤC|PHỤ LỤC)([^\p{L}\p{N}_\p{M}]|$)')"
_MARKER = r"regexp_matches(text, '(?i)\(Ban hành kèm theo')"
_RANK = "CASE node_type WHEN 'phan' THEN 0 WHEN 'phu_luc' THEN 0 WHEN 'chuong' THEN 1 WHEN 'muc' THEN 2 WHEN 'tieu_muc' THEN 3 WHEN 'dieu' THEN 4 WHEN 'khoan' THEN 5 WHEN 'diem' THEN 6 WHEN 'gach_dau_dong' THEN 7 END"
_S = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"
_TYPE = r"""CASE WHEN regexp_matches(text, '(?i)^[\s\p{Z}]*Điều[\s\p{Z}]+\p{Nd}+[a-zđ]?[.\s\p{Z}]') THEN 'dieu'
  WHEN regexp_matches(text, '(?i)^[\s\p{Z}]*Chương[\s\p{Z}]+[IVXLC]+') THEN 'chuong'
  WHEN regexp_matches(text, '(?i)^[\s\p{Z}]*Mục[\s\p{Z}]+\p{Nd}+') THEN 'muc'
  WHEN regexp_matches(text, '^[\s\p{Z}]*\p{Nd}+[.\-][\s\p{Z}]') THEN 'khoan'
  WHEN regexp_matches(text, '^[\s\p{Z}]*[a-zđ]\)[\s\p{Z}]') THEN 'diem' END"""
# Profiling, which makes the class map, reads clauses more narrowly.
_NARROW = _TYPE.replace("[.\\-]", "\\.")
_NUMBER = r"""CASE WHEN regexp_matches(text, '(?i)^[\s\p{Z}]*Điều[\s\p{Z}]+\p{Nd}+[a-zđ]?[.\s\p{Z}]') THEN regexp_extract(text, '(?i)^[\s\p{Z}]*Điều[\s\p{Z}]+(\p{Nd}+[a-zđ]?)[.\s\p{Z}]', 1)
  WHEN regexp_matches(text, '(?i)^[\s\p{Z}]*Chương[\s\p{Z}]+[IVXLC]+') THEN regexp_extract(text, '(?i)^[\s\p{Z}]*Chương[\s\p{Z}]+([IVXLC]+)', 1)
  WHEN regexp_matches(text, '(?i)^[\s\p{Z}]*Mục[\s\p{Z}]+\p{Nd}+') THEN regexp_extract(text, '(?i)^[\s\p{Z}]*Mục[\s\p{Z}]+(\p{Nd}+)', 1)
  WHEN regexp_matches(text, '^[\s\p{Z}]*\p{Nd}+[.\-][\s\p{Z}]') THEN regexp_extract(text, '^[\s\p{Z}]*(\p{Nd}+)[.\-][\s\p{Z}]', 1)
  WHEN regexp_matches(text, '^[\s\p{Z}]*[a-zđ]\)[\s\p{Z}]') THEN regexp_extract(text, '^[\s\p{Z}]*([a-zđ])\)[\s\p{Z}]', 1) END"""
_ANC = f"""nd AS (SELECT node_id, doc_id, part_id, order_index, text, {_RANK} AS r FROM nodes),
par AS (
  SELECT a.node_id, arg_max(b.node_id, b.order_index) AS parent_id FROM nd a JOIN nd b
  ON a.doc_id = b.doc_id AND a.part_id = b.part_id AND b.order_index < a.order_index AND b.r < a.r GROUP BY 1
), anc AS (
  SELECT node_id, node_id AS up, 0 AS step FROM nd
  UNION ALL SELECT anc.node_id, par.parent_id, step + 1 FROM anc JOIN par ON anc.up = par.node_id
)"""

_QUOTED = "SELECT 'quoted', i, t FROM (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(QUOTED)) + ") v(i, t)"

ORACLES = {
    "normalize_text": r"""SELECT doc_id, dom_order, regexp_replace(regexp_replace(replace(translate(nfc_normalize(translate(text, chr(160) || chr(8239), '  ')), '“”‘’–—', '""''''--'), '…', '...'), '[ \t]+', ' ', 'g'), '^[\s\p{Z}\x{85}]+|[\s\p{Z}\x{85}]+$', '', 'g') AS clean FROM blocks""",
    "line_blocks": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, line_no, regexp_replace(line, '^[\s\p{Z}\x{85}]+|[\s\p{Z}\x{85}]+$', '', 'g') AS line FROM l)
SELECT doc_id, line_no, length(line) AS n_chars, length(regexp_replace(line, '[\s\p{Z}\x{85}]+', '', 'g')) AS n_solid FROM s WHERE line <> ''""",
    "heading_lookahead": f"""SELECT doc_id, dom_order FROM (SELECT doc_id, dom_order, {_HEADING} AND max({_MARKER}::int) OVER (PARTITION BY doc_id ORDER BY dom_order ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) = 1 AS h FROM blocks) x WHERE h""",
    "quote_parity_mask": f"""SELECT doc_id, dom_order FROM (SELECT doc_id, dom_order, sum(length(text) - length(replace(translate(text, '“”', '""'), '"', ''))) OVER (PARTITION BY doc_id ORDER BY dom_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n FROM (SELECT doc_id, dom_order, text FROM blocks UNION ALL {_QUOTED}) q) x WHERE n % 2 = 1""",
    "pattern_types": f"SELECT doc_id, dom_order, {_TYPE} AS node_type, {_NUMBER} AS number_raw FROM blocks WHERE {_TYPE} IS NOT NULL",
    "classify_cascade": f"""WITH b AS (SELECT doc_id, dom_order, classes, {_TYPE} AS a, {_NARROW} AS p, {_NUMBER} AS num FROM blocks),
e AS (SELECT doc_id, dom_order, p, unnest(classes) AS class, generate_subscripts(classes, 1) AS pos FROM b),
c AS (SELECT class, p AS type, count(*) AS n FROM e WHERE p IS NOT NULL GROUP BY 1, 2),
m AS (SELECT class, arg_min(type, (-n, type)) AS type, max(n) / sum(n) AS purity FROM c GROUP BY 1),
t AS (SELECT doc_id, dom_order, arg_min(m.type, pos) AS ct FROM e JOIN m ON e.class = m.class AND purity >= 0.7 GROUP BY 1, 2)
SELECT b.doc_id, b.dom_order, coalesce(a, ct) AS node_type, num AS number_raw,
  CASE WHEN a = ct THEN 0.95 WHEN a IS NOT NULL AND ct IS NOT NULL THEN 0.4 WHEN a IS NOT NULL THEN 0.8 WHEN ct IS NOT NULL THEN 0.7 ELSE 0.0 END::double AS confidence,
  CASE WHEN a IS NOT NULL THEN 'regex' WHEN ct IS NOT NULL THEN 'css_class' END AS classified_by, coalesce(a <> ct, false) AS conflict
FROM b LEFT JOIN t ON b.doc_id = t.doc_id AND b.dom_order = t.dom_order""",
    "judge_context": """SELECT doc_id, dom_order, substr(lag(text) OVER w, 1, 200) AS before, substr(text, 1, 400) AS shown, substr(lead(text) OVER w, 1, 200) AS after FROM blocks WINDOW w AS (PARTITION BY doc_id ORDER BY dom_order)""",
    "footer_lines": r"""SELECT doc_id, dom_order FROM blocks WHERE regexp_matches(text, '(?i)^[\s\p{Z}]*(TM\.|KT\.|Nơi nhận|\(?Đã ký\)?)')""",
    "parent_previous_smaller": f"""WITH RECURSIVE {_ANC}
SELECT nd.node_id, any_value(par.parent_id) AS parent_id, max(step)::int AS depth FROM nd LEFT JOIN par ON nd.node_id = par.node_id JOIN anc ON anc.node_id = nd.node_id GROUP BY 1""",
    "text_full_rollup": f"""WITH RECURSIVE {_ANC}
SELECT up AS node_id, sum(length(text)) + count(*) - 1 AS n_chars, count(*) AS n_nodes FROM anc JOIN nd ON anc.node_id = nd.node_id GROUP BY 1""",
    "node_breadcrumbs": f"""WITH RECURSIVE {_ANC}
SELECT anc.node_id, string_agg(substr(u.text, 1, 60), ' › ' ORDER BY step DESC) AS breadcrumb FROM anc JOIN nd u ON anc.up = u.node_id GROUP BY 1""",
    "sibling_numbers": """SELECT node_id, row_number() OVER (PARTITION BY doc_id, part_id, parent_id, node_type ORDER BY order_index) AS ordinal,
row_number() OVER (PARTITION BY doc_id, part_id, parent_id, node_type, number_norm ORDER BY order_index) AS repeat FROM nodes""",
    "subtree_prefix": """SELECT r.node_id AS root, count(*) AS n_below FROM nodes r JOIN nodes n ON r.doc_id = n.doc_id AND starts_with(n.node_id, r.node_id || '/') WHERE r.node_type = 'dieu' GROUP BY 1""",
    "subtree_lookup": """SELECT node_id, depth, order_index FROM nodes WHERE starts_with(node_id, (SELECT min(node_id) FROM nodes WHERE node_type = 'chuong') || '/')""",
    "outlines": """SELECT doc_id, part_id, order_index, repeat('  ', depth) || '[' || node_type || coalesce(' ' || number_norm, '') || '] ' || substr(text, 1, 80) AS line FROM nodes""",
    "sequence_check": r"""WITH n AS (SELECT doc_id, parent_id, node_type, order_index, regexp_extract(part_id, '([0-9]+)$', 1)::int AS part_no,
  CASE WHEN node_type = 'diem' THEN CASE WHEN length(number_norm) = 1 THEN nullif(instr('abcdđeghiklmnopqrstuvxy', lower(number_norm)), 0) END
  ELSE try_cast(nullif(translate(regexp_extract(number_norm, '^(\p{Nd}+)', 1), '０１２３４５６７８９', '0123456789'), '') AS int) END AS v FROM nodes WHERE node_type IN ('dieu', 'khoan', 'diem')),
s AS (SELECT doc_id, node_type, v - lag(v) OVER (PARTITION BY doc_id, parent_id, node_type ORDER BY part_no, order_index) AS step FROM n WHERE v IS NOT NULL)
SELECT doc_id, NOT coalesce(bool_or(CASE WHEN node_type = 'diem' THEN step <= 0 ELSE step <> 1 END), false) AS sequence_ok FROM s GROUP BY 1""",
    "hierarchy_check": """WITH j AS (SELECT n.doc_id, n.node_type, coalesce(p.node_type, '') AS pt, coalesce(bool_or(n.node_type = 'dieu') OVER (PARTITION BY n.doc_id), false) AS art FROM nodes n LEFT JOIN nodes p ON n.parent_id = p.node_id)
SELECT doc_id, NOT bool_or((node_type = 'diem' AND pt <> 'khoan') OR (node_type = 'khoan' AND NOT (pt = 'dieu' OR (pt = '' AND NOT art)))) AS hierarchy_ok FROM j GROUP BY 1""",
}

_SLUG = r"coalesce(nullif(lower(trim(regexp_replace(regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g'), '[^a-zA-Z0-9]+', '-', 'g'), '-')), ''), 'doc')"
_PARTS = rf"""RECURSIVE b AS (
  SELECT doc_id, dom_order, text, row_number() OVER (PARTITION BY doc_id ORDER BY dom_order) - 1 AS i,
    {_HEADING} AND max({_MARKER}::int) OVER (PARTITION BY doc_id ORDER BY dom_order ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) = 1 AS head,
    {_MARKER} OR {_HEADING} AS mark,
    try_cast(nullif(translate(regexp_extract(text, '(?i)^[\s\p{{Z}}]*Điều[\s\p{{Z}}]+(\p{{Nd}}+)[a-zđ]?[.\s\p{{Z}}]', 1), '０１２３４５６７８９', '0123456789'), '') AS int) AS num
  FROM blocks
), m AS (SELECT doc_id, coalesce(list(i) FILTER (mark), []) AS marks FROM b GROUP BY 1),
ev AS (SELECT doc_id, i, head, num, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM b WHERE head OR num IS NOT NULL),
st AS (
  SELECT doc_id, 0::bigint AS k, [0::bigint] AS bounds, NULL::int AS last, marks FROM m
  UNION ALL
  SELECT doc_id, k, CASE WHEN head AND i > edge THEN list_append(bounds, i) WHEN num IS NOT NULL AND last > 1 AND num = 1 AND spot > edge THEN list_append(bounds, spot) ELSE bounds END,
    CASE WHEN head AND i > edge THEN NULL WHEN num IS NULL THEN last ELSE num END, marks
  FROM (SELECT e.doc_id, e.k, e.i, e.head, e.num, s.bounds, s.last, s.marks, s.bounds[-1] AS edge,
      coalesce(list_max(list_filter(s.marks, lambda j: j < e.i AND j >= greatest(e.i - 9, s.bounds[-1]))), e.i) AS spot
    FROM st s JOIN ev e ON s.doc_id = e.doc_id AND e.k = s.k + 1) x
), fin AS (SELECT doc_id, arg_max(bounds, k) AS bounds FROM st GROUP BY 1),
placed AS (SELECT b.doc_id, b.dom_order, b.text, len(list_filter(f.bounds, lambda x: x <= b.i))::int AS part_no FROM b JOIN fin f ON b.doc_id = f.doc_id),
named AS (SELECT doc_id, dom_order, part_no, 'p' || part_no AS part_id, CASE WHEN part_no > 1 THEN first_value(text) OVER (PARTITION BY doc_id, part_no ORDER BY dom_order) END AS part_heading, part_no = 1 AS is_main FROM placed)"""

ORACLES |= {
    "slugs": f"SELECT doc_id, CASE WHEN coalesce(so_ky_hieu, '') <> '' THEN {_SLUG.format(x='so_ky_hieu')} || '-' ELSE '' END || {_SLUG.format(x='id')} AS slug FROM documents",
    "parts": f"WITH {_PARTS} SELECT * FROM named",
    "part_ranges": f"WITH {_PARTS} SELECT doc_id, part_no, min(dom_order) AS start_block, max(dom_order) AS end_block, min(part_heading) AS heading FROM named GROUP BY 1, 2",
}

_FOOT = r"(regexp_matches(text, '(?i)^[\s\p{Z}]*(TM\.|KT\.|Nơi nhận|\(?Đã ký\)?)') OR regexp_matches(text, '(?i)^[\s\p{Z}]*[^,\n]{2,40},[\s\p{Z}]*ngày[\s\p{Z}]+\p{Nd}{1,2}[\s\p{Z}]+tháng[\s\p{Z}]+\p{Nd}{1,2}[\s\p{Z}]+năm[\s\p{Z}]+\p{Nd}{4}[\s\p{Z}]*\.?[\s\p{Z}]*$'))"
_MARKED = rf"""{_PARTS}, typed AS (
  SELECT n.doc_id, n.dom_order, n.part_no, n.part_id, o.text, o.html_raw, {_TYPE.replace('text', 'o.text')} AS a, NULL::varchar AS ct, {_NUMBER.replace('text', 'o.text')} AS num,
    coalesce(sum(length(o.text) - length(replace(o.text, '"', ''))) OVER (PARTITION BY n.doc_id, n.part_no ORDER BY n.dom_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS masked
  FROM named n JOIN blocks o ON n.doc_id = o.doc_id AND n.dom_order = o.dom_order
), cl AS (SELECT *, CASE WHEN NOT masked THEN coalesce(a, ct) END AS t, CASE WHEN NOT masked THEN num END AS nr FROM typed),
g AS (SELECT *, t IS NULL AND {_FOOT} AS foot, count(t) OVER w AS grp, last_value(t IGNORE NULLS) OVER w AS lt FROM cl WINDOW w AS (PARTITION BY doc_id, part_no ORDER BY dom_order ROWS UNBOUNDED PRECEDING)),
nth AS (SELECT *, sum((t IS NULL AND NOT foot)::int) OVER (PARTITION BY doc_id, part_no, grp ORDER BY dom_order) AS np, sum(foot::int) OVER (PARTITION BY doc_id, part_no ORDER BY dom_order) AS nf FROM g),
roles AS (SELECT *, CASE WHEN t IS NOT NULL THEN 'push' WHEN foot THEN CASE WHEN nf = 1 THEN 'footer' ELSE 'to_footer' END WHEN grp > 0 AND lt = 'dieu' AND np = 1 THEN 'khoan0'
  WHEN grp > 0 THEN 'append' WHEN np = 1 THEN 'preamble' ELSE 'to_preamble' END AS role FROM nth),
ord AS (SELECT *, (sum((role IN ('push', 'khoan0', 'footer', 'preamble'))::int) OVER (PARTITION BY doc_id, part_no ORDER BY dom_order) - 1)::int AS order_index FROM roles),
marked AS (SELECT *, CASE role WHEN 'to_footer' THEN max(CASE WHEN role = 'footer' THEN order_index END) OVER p WHEN 'to_preamble' THEN max(CASE WHEN role = 'preamble' THEN order_index END) OVER p ELSE order_index END AS target
  FROM ord WINDOW p AS (PARTITION BY doc_id, part_no))"""
_TREE = rf"""{_MARKED}, made AS (
  SELECT doc_id, part_no, part_id, order_index, text, CASE role WHEN 'khoan0' THEN 'khoan' WHEN 'push' THEN t ELSE role END AS node_type, CASE role WHEN 'khoan0' THEN '0' WHEN 'push' THEN nr END AS number_raw,
    CASE role WHEN 'khoan0' THEN 0.5 WHEN 'push' THEN CASE WHEN a = ct THEN 0.95 WHEN a IS NOT NULL AND ct IS NOT NULL THEN 0.4 WHEN a IS NOT NULL THEN 0.8 ELSE 0.7 END ELSE 0.6 END::double AS confidence,
    CASE WHEN role = 'khoan0' THEN 'style' WHEN role = 'push' AND a IS NULL THEN 'css_class' ELSE 'regex' END AS classified_by
  FROM marked WHERE role IN ('push', 'khoan0', 'footer', 'preamble')
), lev AS (SELECT *, {_RANK} AS r, CASE WHEN node_type = 'diem' THEN lower(number_raw) ELSE number_raw END AS number_norm FROM made),
pa AS (SELECT a.doc_id, a.part_no, a.order_index, max(b.order_index) AS up FROM lev a LEFT JOIN lev b ON a.doc_id = b.doc_id AND a.part_no = b.part_no AND b.order_index < a.order_index AND b.r < a.r GROUP BY 1, 2, 3),
tl AS (SELECT lev.*, up, CASE WHEN r IS NULL THEN node_type WHEN coalesce(number_norm, '') = '' THEN node_type || '-u' || row_number() OVER (PARTITION BY lev.doc_id, lev.part_no, up, node_type, coalesce(number_norm, '') = '' ORDER BY lev.order_index)
  ELSE node_type || '-' || number_norm END AS tail FROM lev JOIN pa USING (doc_id, part_no, order_index)),
it AS (SELECT *, CASE WHEN r IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, part_no, up, tail ORDER BY order_index) > 1 THEN tail || '~' || row_number() OVER (PARTITION BY doc_id, part_no, up, tail ORDER BY order_index) ELSE tail END AS id_tail FROM tl),
meta AS (SELECT id, so_ky_hieu FROM documents WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY doc_id DESC) = 1),
sl AS (SELECT doc_id, CASE WHEN coalesce(so_ky_hieu, '') <> '' THEN {_SLUG.format(x='so_ky_hieu')} || '-' ELSE '' END || {_SLUG.format(x='doc_id')} AS slug FROM (SELECT DISTINCT doc_id FROM it) d LEFT JOIN meta ON d.doc_id = meta.id),
tree AS (
  SELECT it.doc_id, part_no, order_index, slug || '/' || part_id || '/' || id_tail AS node_id, NULL::varchar AS parent_id, replace(tail, '-', '_') AS path, substr(text, 1, 60) AS breadcrumb, 0 AS depth, [order_index] AS chain FROM it JOIN sl ON it.doc_id = sl.doc_id WHERE up IS NULL
  UNION ALL
  SELECT it.doc_id, it.part_no, it.order_index, t.node_id || '/' || it.id_tail, t.node_id, t.path || '.' || replace(it.tail, '-', '_'), t.breadcrumb || ' › ' || substr(it.text, 1, 60), t.depth + 1, list_append(t.chain, it.order_index)
  FROM tree t JOIN it ON it.doc_id = t.doc_id AND it.part_no = t.part_no AND it.up = t.order_index
), tx AS (SELECT doc_id, part_no, target AS order_index, string_agg(text, chr(10) ORDER BY dom_order) AS text, string_agg(html_raw, '' ORDER BY dom_order) AS html_raw FROM marked GROUP BY 1, 2, 3),
fu AS (SELECT c.doc_id, c.part_no, c.to_node AS order_index, string_agg(tx.text, chr(10) ORDER BY c.order_index) AS text_full FROM (SELECT doc_id, part_no, order_index, unnest(chain) AS to_node FROM tree) c JOIN tx USING (doc_id, part_no, order_index) GROUP BY 1, 2, 3)"""

_NODES = """
SELECT tree.node_id, it.doc_id, it.part_no, it.part_id, tree.parent_id, tree.path, tree.depth, it.order_index, it.node_type, it.number_raw, it.number_norm,
  CASE WHEN it.node_type IN ('dieu', 'chuong', 'muc', 'tieu_muc', 'phan') THEN it.text END AS heading, tx.text, fu.text_full, tree.breadcrumb, tx.html_raw, it.confidence, it.classified_by
FROM it JOIN tree USING (doc_id, part_no, order_index) JOIN tx USING (doc_id, part_no, order_index) JOIN fu USING (doc_id, part_no, order_index)"""
_JOINED = "JOIN blocks o ON n.doc_id = o.doc_id AND n.dom_order = o.dom_order"
_BOTH = f"RECURSIVE both_blocks AS (SELECT doc_id, dom_order, text, html_raw FROM blocks UNION ALL SELECT *, NULL FROM ({_QUOTED}) q), "
# The class tier: the type of the first class that is pure enough.
_CLASSED = f"""RECURSIVE tokens AS (SELECT doc_id, dom_order, {_NARROW} AS p, unnest(classes) AS class, generate_subscripts(classes, 1) AS pos FROM blocks),
learned AS (SELECT class, arg_min(type, (-n, type)) AS type, max(n) / sum(n) AS purity FROM (SELECT class, p AS type, count(*) AS n FROM tokens WHERE p IS NOT NULL GROUP BY 1, 2) c GROUP BY 1),
tiers AS (SELECT doc_id, dom_order, arg_min(learned.type, pos) AS ct FROM tokens JOIN learned ON tokens.class = learned.class AND purity >= 0.7 GROUP BY 1, 2), """

ORACLES |= {
    "tree_marks": f"WITH {_MARKED} SELECT doc_id, dom_order, part_no, role, target FROM marked",
    "masked_types": f"WITH {_MARKED.replace('blocks', 'both_blocks').replace('RECURSIVE ', _BOTH, 1)} SELECT a AS raw_type, count(*) AS n FROM marked WHERE masked AND a IS NOT NULL GROUP BY 1",
    "full_tree": f"WITH {_TREE}{_NODES}",
    "full_tree_with_classes": f"WITH {_TREE.replace('RECURSIVE ', _CLASSED, 1).replace('NULL::varchar AS ct', 'w.ct').replace(_JOINED, _JOINED + ' LEFT JOIN tiers w ON n.doc_id = w.doc_id AND n.dom_order = w.dom_order')}{_NODES}",
    "judged_types": rf"""WITH {_MARKED.replace('RECURSIVE ', _CLASSED, 1).replace('NULL::varchar AS ct', 'w.ct').replace(_JOINED, _JOINED + ' LEFT JOIN tiers w ON n.doc_id = w.doc_id AND n.dom_order = w.dom_order')},
asked AS (SELECT *, coalesce(substr(lag(text) OVER p, 1, 200), '') AS b4, substr(text, 1, 400) AS sh, coalesce(substr(lead(text) OVER p, 1, 200), '') AS af, t IS NULL OR (NOT masked AND coalesce(a <> ct, false)) AS open FROM cl WINDOW p AS (PARTITION BY doc_id, part_no ORDER BY dom_order)),
said AS (SELECT *, CASE WHEN NOT open THEN 'none' WHEN sh LIKE '%;' THEN 'dash' WHEN sh LIKE '%:' OR b4 = '' THEN 'none' WHEN af LIKE 'Điều%' THEN 'muc' ELSE 'none' END AS answer FROM asked)
SELECT doc_id, dom_order, CASE answer WHEN 'dash' THEN 'gach_dau_dong' WHEN 'muc' THEN 'muc' ELSE t END AS node_type, CASE answer WHEN 'dash' THEN NULL WHEN 'muc' THEN length(sh)::varchar ELSE nr END AS number_raw,
  CASE answer WHEN 'dash' THEN 0.6 WHEN 'muc' THEN 0.55 ELSE CASE WHEN t IS NULL THEN 0.0 WHEN a = ct THEN 0.95 WHEN a IS NOT NULL AND ct IS NOT NULL THEN 0.4 WHEN a IS NOT NULL THEN 0.8 ELSE 0.7 END END::double AS confidence,
  CASE WHEN answer <> 'none' THEN 'llm' WHEN t IS NULL THEN NULL WHEN a IS NULL THEN 'css_class' ELSE 'regex' END AS classified_by FROM said""",
}
