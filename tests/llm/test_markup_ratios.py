"""Ratios of tag paths decide residue and chrome; constructs of any length and depth are found."""

import pytest
from pyspark.sql import functions as F

from codexmill.llm.markup import Paths, clean_html, clean_mixed, markup_found
from codexmill.llm.packing import pack_items, token_counts
from codexmill.llm.pieces import split_items
from codexmill.llm.sentences import sentences

WORDS = "từ " * 900 + "ngữ"
LONG = [
    ("a <!-- " + "x " * 11_000 + "--> b", "html", "a  b"),
    ("a <b title='" + "x > y " * 500 + "'>b</b>", "html", "a b"),
    ("a \\(" + "x + " * 1_300 + "y\\) b", "latex", "a " + "x + " * 1_300 + "y b"),
    ("a $x_1 = " + "x + " * 1_100 + "y$ b", "latex", "a x_1 = " + "x + " * 1_100 + "y b"),
    ("a $$x = " + "x + " * 1_100 + "y$$ b", "latex", "a x = " + "x + " * 1_100 + "y b"),
    ("{|\n" + "| cột\n|-\n" * 7_000 + "|}", "wiki", "\n".join(["cột"] * 7_000)),
    (f"a **{WORDS}** b", "markdown", f"a {WORDS} b"),
    (f"a __{WORDS}__ b", "markdown", f"a {WORDS} b"),
    (f"a '''{WORDS}''' b", "wiki", f"a {WORDS} b"),
    (f"a ''{WORDS}'' b", "wiki", f"a {WORDS} b"),
    ("{a}lt;i{a}gt;a{a}lt;/i{a}gt; b".replace("{a}", "&" + "amp;" * 5), "html", "a b"),
    ("\\emph{" * 30 + "a" + "}" * 30 + " b", "latex", "a b"),
    ("{{x|" * 12 + "a" + "}}" * 12 + " b", "wiki", "a b"),
]


@pytest.mark.parametrize("text,kind,want", LONG, ids=range(len(LONG)))
def test_constructs_of_any_length_and_depth(text, kind, want):
    assert clean_mixed(text)[:2] == (want, [kind])


def test_a_long_bold_span_is_noted_as_bold():
    assert "wiki:b" in clean_mixed("'''" + "x" * 2_100 + "'''")[2]


def test_spans_and_tables_within_others():
    assert clean_mixed("'''a ''b'' c''' d")[:2] == ("a b c d", ["wiki"]) and clean_mixed("***a **b** c*** d")[0] == "a b c d"
    assert clean_mixed("{|\n| a\n{|\n| b\n|}\n|}")[:2] == ("a b", ["wiki"])


def test_ratios_decide_what_is_residue():
    paths = clean_mixed("Nội dung dài, có chữ. <b>đậm</b> và <xyz> với \\alpha, \\hoso.")[2]
    assert set(paths) == {"html:b", "html:xyz", "latex:alpha", "latex:hoso", "/p"}
    p = Paths()
    p.sums = paths
    # Signs alone are residue; a name in angle brackets or behind a backslash shows its letters and is text.
    assert p.residue() == {"html:b", "latex:alpha"}
    # A threshold of nothing finds nothing: the rows come from the scores.
    assert p.residue(threshold=0.0) == set() and "html:xyz" in p.residue(threshold=0.9)


def test_what_stands_among_signs_is_one_of_them():
    text = "<b>a</b> <i>b</i> <u>c</u> <sup>d</sup> <z>e</z>"
    assert clean_mixed(text)[:2] == ("a b c d e", ["html"])
    assert clean_mixed("chữ <z> chữ")[:2] == ("chữ <z> chữ", [])


NAV = "<div class='nav'><ul><li><a href='/'>Trang chủ</a></li><li><a href='/t'>Tin tức</a></li></ul></div>"
BODY = "<h1>Nghị định</h1><p>Chủ phương tiện phải hướng dẫn, theo khoản 6; và ghi rõ trong sổ.</p><ul><li>Một, hai.</li><li><a href='#b'>Điều 3</a></li></ul>"
CLEAN = "# Nghị định\nChủ phương tiện phải hướng dẫn, theo khoản 6; và ghi rõ trong sổ.\n- Một, hai.\n- Điều 3"
PAGES = [
    (NAV + BODY, CLEAN),
    (BODY + "<footer><p>Bản quyền 2020, giữ mọi quyền.</p></footer>", CLEAN),
    (BODY + "<div id='page-footer'>Điện thoại: 123.</div>", CLEAN),
    ("<div class='breadcrumb'><a href='/'>A</a> / Luật / B</div>" + BODY + "<aside>Xem thêm, <a href='q'>C</a>.</aside>", CLEAN),
    (NAV, "- Trang chủ\n- Tin tức"),  # a page of nothing else stays
    ("<p class='MsoFooter'>Trang 1</p><p>Nội dung dài, có dấu câu; và nhiều chữ.</p>", "Trang 1\nNội dung dài, có dấu câu; và nhiều chữ."),
    ("<p>Số 1</p><p class='x'>Hà Nội</p>" + BODY, f"Số 1\nHà Nội\n{CLEAN}"),  # short plain text is no chrome
]


@pytest.mark.parametrize("html,want", PAGES, ids=range(len(PAGES)))
def test_pages_lose_navigation_and_footers(html, want):
    assert clean_html(html) == want


HOSTILE = [
    "\\a{" * 30_000 + "}" * 30_000, "&amp;" * 30_000, "<a" + " " * 60_000 + "<b", "<!DOCTYPE " * 30_000, "== a " * 30_000, "# a" + " #" * 30_000, "''a '''b " * 20_000,
    "<a x='" * 20_000, "$" * 60_000, "{|\n|}\n" * 10_000, "{{" * 20_000 + "}}" * 20_000, "<x y=z>" * 20_000, "\\q " * 30_000,
]


@pytest.mark.parametrize("text", HOSTILE, ids=range(len(HOSTILE)))
def test_hostile_texts_end(text):
    assert clean_mixed(text)[0] is not None


def test_each_function_runs_once(spark):
    """One Python evaluation in the plan: the optimizer must not repeat it in a filter."""
    df = spark.createDataFrame([("a", "x")], "k string, t string")
    plans = (
        markup_found(df, "k", "t"),
        sentences(df, "k", "t"),
        split_items(df, "k", "t", 10, 2, only_oversized=True).filter(F.col("piece_no") == 0),
        pack_items(token_counts(df, "k", "t"), "k", "n_tokens", [16]),
    )
    for plan in plans:
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
