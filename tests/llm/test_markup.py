import pytest

from codexmill.llm.markup import Paths, clean_html, clean_mixed, clean_plain, clean_source, html_segments, markup_found

PLAIN = [
    "nồng độ < 5 và > 2", "ghi chú (*) và (*).", "kích thước 5 * 3 * 2", "A = B + 1", "biến a_b_c và __", "mục #3", "tài liệu [1], [2](*)", "khóa {1}", "R&D", "mã 7|9", "tỷ lệ ~ 2",
    "chi 200 $ và 300 $", "ổ C:\\hoso\\item", "- dòng một\n- dòng hai", "1. a\n2) b", "x | y | 12 | z", "M = K/5 + 7", "a <b và c> d", "AT&T; x", "5' 6''", "# 3", "== 4", "giá $5_000",
]

MARKED = [
    ("<b>a</b> b", "html", "a b"), ("a<br/>b", "html", "a\nb"), ("a&nbsp;b &amp; c", "html", "a b & c"), ("&lt;i&gt;a&lt;/i&gt; b", "html", "a b"), ("a</p><p>b", "html", "a\nb"),
    ("**a** b", "markdown", "a b"), ("x __a b__ y", "markdown", "x a b y"), ("## Đầu", "markdown", "## Đầu"), ("> a\n> b", "markdown", "a\nb"), ("[a](#m-2) b", "markdown", "a b"),
    ("a\n```\nx = 1 * 2\n  y\n```", "markdown", "a\nx = 1 * 2\n  y"), ("dùng `x_y` nhé", "markdown", "dùng x_y nhé"), ("| a | b |\n|---|---|\n| 1 | 2 |", "markdown", "a | b\n1 | 2"),
    ("'''a''' b", "wiki", "a b"), ("x ''a'' y", "wiki", "x a y"), ("== Máy chủ ==\nx", "wiki", "## Máy chủ\nx"), ("[[Mục 2|a b]] c", "wiki", "a b c"), ("{{ghi chú|a}} b", "wiki", "a b"),
    ("{|\n! a !! b\n|-\n| 1 || 2\n|}", "wiki", "a | b\n1 | 2"),
    ("\\textbf{a} b", "latex", "a b"), ("a\\footnote{b} c", "latex", "a (b) c"), ("\\(x_4 \\le 2\\)", "latex", "x_4 \\le 2"), ("$M = \\frac{K}{N} \\times 3$", "latex", "M = \\frac{K}{N} \\times 3"),
    ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", "latex", "\n- a\n- b\n"),
]


@pytest.mark.parametrize("text", PLAIN)
def test_plain_signs_are_no_markup(text):
    assert clean_mixed(text)[:2] == (text, [])


@pytest.mark.parametrize("text,kind,want", MARKED)
def test_markup(text, kind, want):
    got, kinds, sums = clean_mixed(text)
    assert kinds == [kind] and got == want and all(p.startswith((kind, "/")) for p in sums)


def test_several_kinds():
    assert clean_mixed("<b>a</b> **b** '''c''' \\emph{d}")[:2] == ("a b c d", ["html", "markdown", "wiki", "latex"])


def test_ratios_drop_bars_of_links_from_plain_text():
    long = "Chủ phương tiện phải hướng dẫn, theo [[Điều 5]]; và ghi rõ. " * 4
    plain = long.replace("[[", "").replace("]]", "")
    for bar in ("[Tin](/) | [Hỏi](/hoi)", "[[Tin]] [[Hỏi]]", "<b><a href='/'>Tin</a></b> <a href='/h'>Hỏi</a>"):
        assert clean_mixed(f"{bar}\n{long}")[0] == plain
    assert clean_mixed(f"[Tin](/) | [Hỏi](/hoi)\n{long}")[1] == ["markdown", "wiki"]
    # A line of one link, words beside links, list items, code and a text of nothing else stay.
    for line, want in (("[[Điều 5]]", "Điều 5"), ("[[A]], [[B]] và C", "A, B và C"), ("- [[A]] [[B]]", "- A B"), ("```\n[[A]] [[B]]\n```", "[[A]] [[B]]")):
        assert clean_mixed(f"{line}\n{long}")[0] == f"{want}\n{plain}"
    assert clean_mixed("[[A]] [[B]]")[0] == "A B"


def test_html_structure():
    html = "<h2>Đầu</h2><p>a&nbsp;<b>b</b></p><ul><li>c</li><li>d</li></ul><table><tr><td>1</td><td><p>2</p></td></tr><tr><td>3</td><td>4</td></tr></table><pre><code>x\n  y</code></pre><p><math><mi>M</mi><mo>=</mo><mfrac><mi>K</mi><mn>2</mn></mfrac></math></p><script>no</script><!-- no -->"
    assert clean_html(html).split("\n") == ["## Đầu", "a b", "- c", "- d", "1 | 2", "3 | 4", "x", "  y", "M = K/2"]
    assert clean_html(None) is None and clean_html("") == "" and clean_html("no tags") == "no tags"


def test_link_chrome_is_dropped_and_content_kept():
    text = "<p>" + "Nội dung dài, có dấu câu; và nhiều chữ hơn. " * 5 + "</p>"
    got = clean_html("<div class='m'><span><a href='x'>a</a></span></div>" * 3 + text)
    assert got == ("Nội dung dài, có dấu câu; và nhiều chữ hơn. " * 5).strip()
    paths = Paths()
    for path, role, t, link in html_segments("<div><a href='x'>a</a></div>" + text):
        if role == "text":
            paths.add(path, t, link)
    assert paths.content() == {"/p"}


def test_linked_text_shares_the_verdict_of_its_block():
    long = "Chủ phương tiện phải hướng dẫn, theo khoản 6; và ghi rõ. " * 4
    assert clean_html(f"<p><a href='x'><strong>Điều 7.</strong> {long}</a></p>") == f"Điều 7. {long}".strip()
    assert clean_html(f"<p>Theo <a href='x'>Điều 5</a>.</p><p>{long}</p>") == f"Theo Điều 5.\n{long}".strip()
    # Of a path of links, only blocks that are links throughout go; a br does not part a block.
    assert clean_html(f"<div><a href='x'>Trang chủ</a></div><div>Số: <br><a href='x'>Điều 5 và khoản 6 Điều 7</a></div><p>{long}</p>") == f"Số:\nĐiều 5 và khoản 6 Điều 7\n{long}".strip()


def test_rows(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "", 1), (None, "**x**", 1), ("d", "<b>x</b> ''y''", 1), ("d", "<b>x</b> ''y''", 1)], "node_id string, text string, markup int")
    assert sorted(map(str, map(tuple, markup_found(df, "node_id", "text").distinct().collect()))) == sorted(map(str, [(None, "markdown"), ("d", "html"), ("d", "wiki")]))
    assert sorted((str(r.node_id), r.clean_text, tuple(r.markup)) for r in clean_plain(df, "node_id", "text").collect() if r.node_id != "d") == [("None", "x", ("markdown",)), ("a", None, ()), ("b", "", ())]
    assert markup_found(df.limit(0), "node_id", "text").count() == 0 and clean_source(df, "node_id", "text").count() == 5


def test_very_long_text():
    assert clean_mixed("a * " * 200_000)[1] == []
    assert len(clean_html("<p>" * 20_000 + "x")) == 1


@pytest.mark.parametrize("text", ["**a " * 40_000, "''a " * 40_000, "{|\n" * 20_000, "<!-- " * 30_000, "\\( " * 40_000, "a | b " * 30_000 + "\n---", "[[" * 50_000, "$a_ " * 40_000, "__a " * 40_000, "`a " * 50_001, "{{a" * 40_000])
def test_hostile_texts_end(text):
    assert clean_mixed(text)[0] is not None


def test_deep_formula():
    assert "x" in clean_html("<math>" + "<mrow>" * 5_000 + "<mi>x</mi></math>")


def test_tag_paths_follow_the_rule_within_a_record(spark):
    from codexmill.llm.markup import html_paths, tag_paths

    html = "<div class='m'><span><a href='x'>a</a></span></div><p>" + "Nội dung, có dấu; dài. " * 9 + "<b>Đậm</b></p><table><tr><td><a href='y'>1</a></td></tr></table><div><i><a href='z'>b</a></i></div>"
    df = spark.createDataFrame([("d", html, 0), ("e", html, 0), ("e", html, 0), (None, html, 0), ("n", None, 0), ("o", "", 0)], "doc_id string, html_raw string, path int")
    got: dict = {}
    for r in tag_paths(df, "doc_id", "html_raw").collect():
        got.setdefault(r.doc_id, {})[r.path] = (r.n, r.is_content)
    paths = html_paths(html_segments(html))
    want = {p: p in paths.content() for p in paths.sums}
    assert set(got) == {"d", "e", None} and {p: c for p, (_, c) in got["d"].items()} == want == {p: c for p, (_, c) in got["e"].items()}
    assert not all(want.values()) and got["e"]["/p"][0] == 2 * got["d"]["/p"][0]


@pytest.mark.parametrize("text", ["<a href=x>" * 40_000, "<a " * 40_000 + "[[a]]", "[[a]] " * 40_000, "<a href=x>a" * 20_000 + "</a>" * 20_000])
def test_hostile_links_end(text):
    assert clean_mixed(text)[0] is not None
