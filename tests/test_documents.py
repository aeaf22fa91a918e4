"""HTML, parts, masks, classification, trees and validation on small documents."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.functions.text import slug
from codexmill.operators import profile as P
from codexmill.operators.classify import judge
from codexmill.operators.html import flatten_one, parse, profile_one
from codexmill.operators.sequence import mask_quotes, split_parts
from codexmill.operators.tree import outline, subtree
from codexmill.plans.pipeline import classify_blocks, enrich, nodes_of, parse_documents


def blocks_of(html):
    return flatten_one(html)["blocks"]


def frame(spark, texts, doc="d"):
    rows = [(doc, i, t, "p", [], None, False, False, f"<p>{t}</p>") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id string, dom_order int, text string, tag string, classes array<string>, style_indent double, is_bold boolean, is_table boolean, html_raw string")


def test_clean_removes_and_normalises():
    html = "<html><head><style>p{}</style></head><body><p>a b – c… <span>d</span> <span class='x'>e</span></p></body></html>"
    (b,) = blocks_of(html)
    assert b["text"] == "a b - c... d e"


def test_blank_and_null_html():
    assert blocks_of(None) == blocks_of("") == blocks_of(" \n ") == []
    assert flatten_one("  ")["template_family"] == ""


def test_flatten_innermost_blocks_tables_and_anchors():
    html = "loose<p>one</p><table><tr><td>x<table><tr><td>y</td></tr></table></td></tr></table><div><p>two <a href='/v/1'>link</a></p></div><p></p><div>three</div>"
    got = blocks_of(html)
    assert [(b["tag"], b["is_table"]) for b in got] == [("p", False), ("table", True), ("p", False), ("div", False)]
    assert got[2]["anchors"] == ["/v/1"]
    assert flatten_one(html)["n_tables"] == 2


def test_blank_table_suppresses_its_ancestor():
    assert blocks_of("<div>text<table><tr><td> </td></tr></table></div>") == []


def test_style_flags():
    (b,) = blocks_of("<p class='a  b' style='margin-left: 36pt; text-align:center; font-weight:700'><i>x</i></p>tail <b>z</b>")
    assert (b["classes"], b["style_indent"], b["is_bold"], b["is_italic"], b["is_center"]) == (["a", "b"], 36.0, True, True, True)
    assert b["html_raw"].endswith("</p>tail ")
    (b,) = blocks_of("<p style='text-indent: .'>x</p>")
    assert b["style_indent"] is None


def test_unclosed_and_odd_markup():
    assert [b["text"] for b in blocks_of("<p>a<p>b<br>c</p></div></b><li>d<li>e")] == ["a", "bc", "d", "e"]
    assert blocks_of("<p>1 < 2 & 3 > 2</p>")[0]["text"] == "1 < 2 & 3 > 2"
    assert parse("<p a='<b>'>x").text() == "x"


def test_style_signals_follow_the_fixed_patterns():
    flags = lambda style: (lambda b: (b["style_indent"], b["is_bold"], b["is_center"]))(blocks_of(f"<p style='{style}'>x</p>")[0])
    assert flags("TEXT-ALIGN: CENTER") == (None, False, True)
    assert flags("MARGIN-LEFT: 5pt") == (None, False, False) and flags("margin-left : 5pt") == (None, False, False)
    assert flags("FONT-WEIGHT: Bold") == (None, True, False) and flags("font-weight : bold") == (None, False, False) and flags("font-weight:600") == (None, True, False)
    assert flags("margin-left: 2; text-indent: 3") == (2.0, False, False) and flags("vertical-align:center") == (None, False, True)


def test_markup_of_a_block_is_that_of_the_cleaned_tree():
    html = "<div><p class='a' title='x > y'>a\u00a0<span>b <font>“c”</font></span><span class='k'>d &amp; e</span><br>f<script>no()</script></p>tail <b>z</b></div>"
    (b,) = blocks_of(html)
    assert b["html_raw"] == '<p class="a" title="x &gt; y">a b "c"<span class="k">d &amp; e</span><br>f</p>tail '
    assert b["text"] == 'a b "c"d & ef' and b["tag"] == "p"
    # A bare wrapper with a class or a style stays; one with blank ones goes.
    (b,) = blocks_of("<p><span class=' ' style=''>x</span><font style='color:red'>y</font></p>")
    assert b["html_raw"] == '<p>x<font style="color:red">y</font></p>'


def test_blocks_read_again_from_their_markup_are_the_same():
    html = "<body><p style='text-indent: 1.5cm; font-weight: 700' class='c1 c2'>Điều 1. <i>A &lt; B</i></p>\n <table border=1><tr><td>1<td><b>2</b></table><div align=center>x<p>y</p>lost</div><li><a href='/v?a=1&amp;b=2'>l</a><h2>H</h2>"
    got = blocks_of(html)
    assert [(b["tag"], b["text"], b["style_indent"], b["is_bold"], b["is_italic"], b["is_table"], b["classes"], b["anchors"]) for b in got] == [
        ("p", "Điều 1. A < B", 1.5, True, True, False, ["c1", "c2"], []),
        ("table", "12", None, True, False, True, [], []),
        ("p", "y", None, False, False, False, [], []),
        ("h2", "H", None, False, False, False, [], []),
    ]
    for b in got:
        (again,) = blocks_of(b["html_raw"]) if b["tag"] != "p" or b["text"] != "y" else blocks_of("<div>" + b["html_raw"] + "</div>")
        assert {k: v for k, v in again.items() if k != "html_raw"} == {k: v for k, v in b.items() if k != "html_raw"}
    assert got[2]["html_raw"] == "<p>y</p>lost"


@pytest.mark.parametrize("size", [2_500, 100_000])
def test_attributes_comments_and_sections_of_any_length(size):
    long = "a > b <i> " * (size // 10)
    assert [b["text"] for b in blocks_of(f'<p title="{long}">x</p><!-- {long} --><p title=\'{long}\'>y</p><![CDATA[ {long} ]]><p>z</p>')] == ["x", "y", "z"]


def test_profile_elements_are_nested():
    got = profile_one("<div class='k'><p>a</p><img><p> </p></div><a href='x'>l</a>")
    assert [e["tag"] for e in got["elements"]] == ["div", "p"] and got["has_img"] and got["has_link"] and not got["has_table"]
    assert got["template_family"] == "k" and not got["parse_error"]
    assert profile_one(" ")["template_family"] is None and profile_one(None)["elements"] == []


def test_profile_reads_bold_from_the_style_and_text_indent_first():
    got = profile_one("<p style='margin-left: 2; text-indent: 3'><b>x</b></p><p style='font-weight:bold; margin-left: 4'>y</p><div class='c'> </div>")["elements"]
    assert [(e["style_indent"], e["is_bold"]) for e in got] == [(3.0, False), (4.0, True)]


def test_corpus_profile(spark, monkeypatch):
    from codexmill.operators import html as H
    from codexmill.plans.profiling import CorpusProfile

    docs = [
        ("a", "<p class='k'>Điều 1. x</p><p class='k'>1. y</p><p class='k'>2- z</p><table><tr><td class='m'>a) w</td></tr></table>"),
        ("b", "<p class='k'>Điều 2. x</p><p class='k'>Điều 1. y</p><div><p class='k'>3. v</p><img></div><a href='q'>l</a>"),
        ("c", " "), ("d", None), ("boom", "<p class='z'>1. x</p>"),
    ]
    real = H.parse

    def parse(source):
        if ">1. x" in source:
            raise ValueError("boom")
        return real(source)

    monkeypatch.setattr(H, "parse", parse)
    flat = spark.createDataFrame([(k, H.profile_one(h)) for k, h in docs], T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("p", H.PROFILE)]))
    monkeypatch.setattr(CorpusProfile, "__init__", lambda self: None)
    profile = CorpusProfile()
    profile.flat = flat
    profile.elements = flat.select("doc_id", F.posexplode("p.elements").alias("dom_order", "e")).select("doc_id", "dom_order", "e.*")
    profile.crosstab = P.crosstab(profile.elements)
    # "2- z" is a clause to the parser, not to profiling; "3. v" counts for the paragraph and for the division around it, which has no class.
    assert {(r["class"], r.type): r.n for r in profile.crosstab.collect()} == {("k", "dieu"): 3, ("k", "khoan"): 2, ("m", "diem"): 1}
    assert {r["class"]: (r.type, r.purity, r.n) for r in profile.class_map().collect()} == {"k": ("dieu", 0.6, 5), "m": ("diem", 1.0, 1)}
    got = {(r.metric, r.name): r.value for r in profile.summary().collect()}
    assert got["totals", "n_docs"] == 5 and got["totals", "parse_errors"] == 1 and got["agreement", "agreement"] == 4 / 6
    assert got["presence", "with_table"] == got["presence", "with_image"] == got["presence", "with_link"] == 0.2
    assert got["types", "rate_dieu"] == got["types", "rate_khoan"] == 0.4 and got["types", "rate_diem"] == 0.2
    assert got["multi_part", "rate"] == 0.5
    assert {r.template: r.n for r in profile.families().collect()} == {"k|m": 1, "k": 1}
    assert {(r["class"], r.nth): r.sample for r in profile.samples().collect() if r["class"] == "m"} == {("m", 1): "a) w"}


def parts(spark, texts):
    return [r.part_no for r in split_parts(frame(spark, texts)).orderBy("dom_order").collect()]


def test_parts_heading_and_restart(spark):
    assert parts(spark, ["Điều 1. a", "Điều 2. b", "QUY CHẾ", "(Ban hành kèm theo Quyết định 1)", "Điều 1. c", "Điều 2. d"]) == [1, 1, 2, 2, 2, 2]
    assert parts(spark, ["Điều 1. a", "x", "Điều 2. b", "Điều 1. c"]) == [1, 1, 1, 2]
    assert parts(spark, ["QUY CHẾ (Ban hành kèm theo", "Điều 1. c"]) == [1, 1]  # a heading at block 0 is no boundary
    assert parts(spark, ["QUY ĐỊNH CHUNG", "Điều 1. a", "Điều 3. b", "Điều 2. c"]) == [1, 1, 1, 1]


def test_parts_look_back_to_the_last_boundary_only(spark):
    # The nearest mark is the last boundary itself: no boundary is added.
    assert parts(spark, ["PHỤ LỤC", "Điều 1. a", "Điều 2. b", "Điều 1. c"]) == [1, 1, 1, 1]
    far = ["a", "PHỤ LỤC", *["x"] * 9, "Điều 2. b", "PHỤ LỤC 2", "y", "Điều 1. c"]
    assert parts(spark, far) == [1] * 12 + [2] * 3


def test_quote_mask(spark):
    df = frame(spark, ["1. a", '2. b "c', "3. d", '4. e" f', "5. g"]).withColumn("part_no", F.lit(1))
    assert [r.is_masked for r in mask_quotes(df).orderBy("dom_order").collect()] == [False, False, True, True, False]


def tree(spark, texts, **kw):
    nodes = nodes_of(classify_blocks(frame(spark, texts)), **kw)
    return {r.order_index + 100 * r.part_no: r for r in nodes.collect()}


def test_tree_ids_and_roll_up(spark):
    t = tree(spark, ["Căn cứ", "Chương I", "Điều 1. x", "intro", "more", "1. k", "a) p", "đ) q", "Điều 2. y", "TM. UBND", "after"])
    got = [r.node_id for _, r in sorted(t.items())]
    assert got == [
        "d/p1/preamble", "d/p1/chuong-I", "d/p1/chuong-I/dieu-1", "d/p1/chuong-I/dieu-1/khoan-0", "d/p1/chuong-I/dieu-1/khoan-1", "d/p1/chuong-I/dieu-1/khoan-1/diem-a",
        "d/p1/chuong-I/dieu-1/khoan-1/diem-đ", "d/p1/chuong-I/dieu-2", "d/p1/footer", "d/p1/chuong-I/dieu-2/khoan-0",
    ]
    article = t[102]
    assert article.text_full == "Điều 1. x\nintro\nmore\n1. k\na) p\nđ) q" and t[103].text == "intro\nmore" and article.depth == 1
    assert t[105].path == "chuong_I.dieu_1.khoan_1.diem_a" and t[105].breadcrumb.startswith("Chương I › Điều 1. x › 1. k")


def test_tree_repeats_and_unnumbered(spark):
    t = tree(spark, ["Điều 1. a", "1. b", "1. c", "a) d"])
    assert [r.node_id for _, r in sorted(t.items())][1:] == ["d/p1/dieu-1/khoan-1", "d/p1/dieu-1/khoan-1~2", "d/p1/dieu-1/khoan-1~2/diem-a"]
    cm = spark.createDataFrame([("art", "dieu", 0.9), ("poor", "diem", 0.5)], "class string, type string, purity double")
    df = frame(spark, ["x", "y", "z"]).withColumn("classes", F.when(F.col("dom_order") < 2, F.array(F.lit("poor"), F.lit("art"))).otherwise(F.array(F.lit("poor"))))
    got = {r.order_index: (r.node_id, r.classified_by, r.confidence) for r in nodes_of(classify_blocks(df, cm)).collect()}
    assert got[0] == ("d/p1/dieu-u1", "css_class", 0.7) and got[1][0] == "d/p1/dieu-u2" and got[2][0] == "d/p1/dieu-u2/khoan-0"


def test_every_block_is_kept(spark):
    texts = ["a", "TM. x", "Điều 1. b", "c", "TM. y", "d", "1. e", "Nơi nhận", "f"]
    t = tree(spark, texts)
    assert sorted("\n".join(r.text for r in t.values()).split("\n")) == sorted(texts)
    assert len({r.node_id for r in t.values()}) == len(t)


def test_slugs():
    assert slug("14/2018/QĐ-UBND") == "14-2018-q-ubnd" and slug("") == slug(None) == "doc"


@pytest.mark.parametrize(
    "texts,verdict,issues",
    [
        (["Điều 1. a", "1. b", "2. c", "Điều 2. d"], "clean", ""),
        (["Điều 1. a", "1. b", "3. c"], "warn", "sequence"),
        (["a) x"], "warn", "hierarchy"),
        (["1. x", "2. y"], "clean", ""),  # a flat list without articles
        (["x (Ban hành kèm theo y"], "warn", "part_count"),
    ],
)
def test_quality(spark, texts, verdict, issues):
    content = spark.createDataFrame([("d", "".join(f"<p>{t}</p>" for t in texts))], "id string, html string")
    _, q = parse_documents(content, "id", "html")
    (r,) = q.collect()
    assert (r.verdict, r.issues) == (verdict, issues)


def test_quality_of_empty_and_lossy_documents(spark):
    content = spark.createDataFrame([("a", None), ("b", ""), ("c", "loose text that no block holds<p>x</p>")], "id string, html string")
    nodes, q = parse_documents(content, "id", "html")
    got = {r.doc_id: (r.verdict, r.n_nodes) for r in q.collect()}
    assert got == {"a": ("clean", 0), "b": ("clean", 0), "c": ("failed", 1)}
    meta = spark.createDataFrame([("a", None, ""), ("b", None, "Luật")], "id string, ngay_ban_hanh date, loai_van_ban string")
    assert {(r.doc_id, r.loai_van_ban, r.decade) for r in enrich(q, meta).collect()} == {("a", "unknown", "unknown"), ("b", "Luật", "unknown"), ("c", "unknown", "unknown")}


def quality_of(spark, html, class_map=None):
    (r,) = parse_documents(spark.createDataFrame([("d", html)], "id string, html string"), "id", "html", class_map=class_map)[1].collect()
    return r


def test_quality_of_tables_and_coverage(spark):
    r = quality_of(spark, "<p>Điều 1. a</p><table><tr><td>x<table><tr><td>y</td></tr></table></td></tr></table>")
    assert (r.table_preserved, r.verdict, r.issues) == (False, "warn", "table_preserved")  # a table in a table is no block of its own
    assert quality_of(spark, "<p>Điều 1. a</p><table><tr><td>x</td></tr></table>").issues == ""
    r = quality_of(spark, "<p class='b a'>Điều 1. " + "x" * 93 + "</p>lost")
    assert abs(r.char_coverage - 99 / 103) < 1e-9 and (r.verdict, r.issues, r.template_family) == ("warn", "char_coverage", "a|b")
    assert quality_of(spark, "<p>" + "x" * 80 + "</p>" + "y" * 20).verdict == "failed"


def test_quality_of_conflicts_counts_masked_blocks_too(spark):
    """A class whose type contradicts the text is a conflict; quotations hide blocks from the tree, not from the rate."""
    cm = spark.createDataFrame([("art", "dieu", 0.9)], "class string, type string, purity double")
    html = "<p class='art'>1. a \"b</p><p class='art'>2. c</p><p>3. d</p><p>x</p>"
    r = quality_of(spark, html, cm)
    assert r.conflict_rate == 2 / 3 and "conflict_rate" in r.issues.split(",") and r.n_nodes == 1
    assert quality_of(spark, html).conflict_rate == 0.0


def test_writers_of_samples_and_profile(spark, tmp_path):
    from codexmill.plans.profiling import CorpusProfile, write_profile, write_samples

    samples = spark.createDataFrame([("a", "dev"), ("b", "dev"), ("c", "golden")], "doc_id string, sample string")
    write_samples(samples, str(tmp_path))
    read = lambda name: {r.doc_id for r in spark.read.json(f"{tmp_path}/{name}").collect()}
    assert read("dev") == {"a", "b"} and read("golden") == {"c"}
    content = spark.createDataFrame([("a", "<p class='k'>Điều 1. x</p>"), ("b", "<p class='k'>1. x</p>")], "id string, html string")
    write_profile(CorpusProfile(content, "id", "html"), str(tmp_path))
    assert [(r["class"], r.n, r.purity) for r in spark.read.json(f"{tmp_path}/class_map").collect()] == [("k", 2, 0.5)]


def test_judge_changes_only_ambiguous_blocks_and_survives_failures(spark):
    def provider(before, text, after):
        if text == "boom":
            raise TimeoutError
        return {"node_type": "khoan" if text == "x" else "poem", "number_raw": "9", "confidence": 0.6}

    got = {r.dom_order: (r.node_type, r.classified_by) for r in classify_blocks(frame(spark, ["Điều 1. a", "x", "boom", "y"]), provider=provider).collect()}
    assert got == {0: ("dieu", "regex"), 1: ("khoan", "llm"), 2: (None, None), 3: (None, None)}
    df = frame(spark, ["x"])
    assert judge(df) is df


def test_subtree_and_outline(spark):
    nodes = nodes_of(classify_blocks(frame(spark, ["Điều 1. a", "1. b", "Điều 11. c", "1. d"])))
    assert [r.node_id for r in subtree(nodes, "d/p1/dieu-1").collect()] == ["d/p1/dieu-1/khoan-1"]
    assert "  [khoan 1] 1. b" in [r.line for r in outline(nodes).collect()]


def test_class_tier_by_map_and_by_join(spark, monkeypatch):
    from codexmill.operators import classify

    cm = spark.createDataFrame([("a", "dieu", 0.9), ("b", "khoan", 0.8), ("c", "diem", 0.2)], "class string, type string, purity double")
    df = spark.createDataFrame([("d", 0, ["c", "b", "a"]), ("d", 1, ["c"]), ("d", 2, []), ("d", 3, None)], "doc_id string, dom_order int, classes array<string>")
    want = {0: "khoan", 1: None, 2: None, 3: None}
    got = lambda: {r.dom_order: r.class_type for r in classify.class_tier(df, cm).collect()}
    assert got() == want
    monkeypatch.setattr(classify, "LITERAL_CLASSES", 0)
    assert got() == want
    monkeypatch.setattr(classify, "BROADCAST_CLASSES", 0)
    assert got() == want
    monkeypatch.undo()
    assert {r.class_type for r in classify.class_tier(df, cm.limit(0)).collect()} == {None}


def test_hostile_markup_stays_linear():
    n = 30_000
    assert len(blocks_of("<div>" * n + "x" + "</b>" * n)) == 1
    assert blocks_of("<span>" * n + "</p>" * n + "<p>x")[0]["text"] == "x"
    assert len(blocks_of("<p a=\"" * 3_000)) <= 1
    assert len(profile_one("<div>" * 2_000 + "<b>x</b>")["elements"]) == 2_000
    for hostile in ("<![CDATA[ " * n, "<a \"<a '" * n, "<a \"" * n + "<b ", "<? " * n, "<a x='" + "<b y=\"" * n, "<a" * n):
        assert len(blocks_of(hostile + "<p>x")) <= 1
