"""Tolerant HTML tokenising, cleaning and flattening into ordered blocks.

The only Python hop of the document pipeline: one Arrow UDF reads a document once and
returns its blocks together with the measures that validation and profiling need.

Defined results: null or blank HTML gives no blocks; loose text beside block elements is
dropped (the coverage measure counts it); unknown or unbalanced tags never fail.
"""

from __future__ import annotations

import html as _entities
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OPENING = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[A-Za-z])")
_NAME = re.compile(r"<(/?)([A-Za-z][\w:.-]*)")
_INSIDE = re.compile(r"[<>\"']")
_ANGLE = re.compile(r"[<>]")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# Elements that are blocks, that are void, that hold raw text, that cleaning removes and that it unwraps.
BLOCK_TAGS = frozenset(["p", "div", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6"])
VOID_TAGS = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])
REMOVED_TAGS = frozenset(["script", "style", "head"])
BARE_TAGS = frozenset(["font", "span"])
RAW_TAGS = ("script", "style")
CLOSES_P = BLOCK_TAGS - {"td"} | frozenset(["table", "ul", "ol", "dl", "pre", "blockquote", "section", "article", "form", "center", "hr", "address", "fieldset"])
#: An opening tag closes open tags of its family, up to the nearest host.
SIBLINGS = {
    "li": (("li",), ("ul", "ol")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr", "td", "th"), ("table",)),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
}


class Element:
    """An element with its children (elements and strings) and its place in the source."""

    __slots__ = ("tag", "raw", "kids", "start", "end", "_attrs")

    def __init__(self, tag: str, raw: str, start: int):
        self.tag, self.raw, self.kids, self.start, self.end, self._attrs = tag, raw, [], start, -1, None

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            found: dict[str, str] = {}
            if self.raw and not self.raw.isspace():
                for name, a, b, c in ATTRIBUTE.findall(self.raw):
                    found.setdefault(name.lower(), _entities.unescape(a or b or c))
            self._attrs = found
        return self._attrs

    def walk(self):
        """The element and all elements below, in document order, without recursion."""
        stack = [self]
        while stack:
            e = stack.pop()
            yield e
            stack.extend(k for k in reversed(e.kids) if not isinstance(k, str))

    def text(self) -> str:
        parts, stack = [], [self]
        while stack:
            e = stack.pop()
            if isinstance(e, str):
                parts.append(e)
            else:
                stack.extend(reversed(e.kids))
        return "".join(parts)


class Tokens:
    """Tags and comments of a source in order, of any length.

    A search for a mark that is not there is remembered, so the source is read a bounded number of times.
    """

    def __init__(self, source: str):
        self.source, self.gone = source, {}

    def find(self, mark: str, at: int) -> int:
        if at >= self.gone.get(mark, len(self.source) + 1):
            return -1
        k = self.source.find(mark, at)
        if k < 0:
            self.gone[mark] = at
        return k

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose attributes start at ``at``, -1 if none does; ``<`` and ``>`` in quotes do not count."""
        k = at
        while m := _INSIDE.search(self.source, k):
            mark = m.group()
            if mark == ">":
                return m.start()
            closing = -1 if mark == "<" else self.find(mark, m.end())
            if closing < 0:
                break
            k = closing + 1
        m = _ANGLE.search(self.source, at)
        return m.start() if m and m.group() == ">" else -1

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """(start, end, name, closing, attributes) of the next tag from ``at``; the name of a comment is empty."""
        s = self.source
        while m := _OPENING.search(s, at):
            start, sort = m.start(), m.group()
            end = -1
            if sort == "<!--":
                end = self.find("-->", m.end())
                return start, end + 3 if end >= 0 else len(s), "", False, ""
            if sort == "<![CDATA[":
                end = self.find("]]>", m.end())
                if end >= 0:
                    return start, end + 3, "", False, ""
            if sort[1] in "!?":
                end = self.find(">", start + 2)
                if end >= 0:
                    return start, end + 1, "", False, ""
            else:
                name = _NAME.match(s, start)
                end = self.tag_end(name.end())
                if end >= 0:
                    return start, end + 1, name.group(2), bool(name.group(1)), s[name.end() : end]
            at = start + 1
        return None


def parse(source: str) -> Element:
    """The element tree of ``source`` under a nameless root."""
    root = Element("", "", 0)
    stack, at, n = [root], 0, len(source)
    tokens = Tokens(source)
    opened: dict[str, int] = {}  # open elements by tag, so an end tag without its start costs nothing
    add = lambda s: stack[-1].kids.append(_entities.unescape(s) if "&" in s else s)

    def close(k: int, end: int) -> None:
        for e in stack[k:]:
            e.end = end
            opened[e.tag] -= 1
        del stack[k:]

    while at < n:
        token = tokens.next(at)
        if not token:
            add(source[at:])
            break
        start, end, name, closing, raw = token
        if start > at:
            add(source[at:start])
        at = end
        if not name:
            continue
        tag = name.lower()
        if closing:
            for k in range(len(stack) - 1, 0, -1) if opened.get(tag) else ():
                if stack[k].tag == tag:
                    close(k, at)
                    break
                if stack[k].tag in ("table",) and tag not in ("body", "html", "div"):
                    break
            continue
        if tag in CLOSES_P and opened.get("p"):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k, start)
                    break
                if stack[k].tag in ("td", "th", "div", "li", "table", "blockquote"):
                    break
        if tag in SIBLINGS:
            family, hosts = SIBLINGS[tag]
            cut = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in hosts:
                    break
                if stack[k].tag in family:
                    cut = k
            if cut:
                close(cut, start)
        e = Element(tag, raw, start)
        stack[-1].kids.append(e)
        if tag in VOID_TAGS or raw.endswith("/"):
            e.end = at
            continue
        stack.append(e)
        opened[tag] = opened.get(tag, 0) + 1
        if tag in RAW_TAGS:
            stop = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(source, at)
            e.kids.append(source[at : stop.start() if stop else n])
            at = stop.end() if stop else n
            close(len(stack) - 1, at)
    close(1, n)
    root.end = n
    return root


_SPACES = re.compile(r"[ \t]+")
# Characters that text normalisation replaces.
_REPLACED = str.maketrans({"\u00a0": " ", "\u202f": " "})
_PLAIN = str.maketrans({"“": '"', "”": '"', "‘": "'", "’": "'", "–": "-", "—": "-", "…": "..."})


def normalize(s: str) -> str:
    """Spaces, NFC, plain quotation marks and dashes; runs of blanks to one, line breaks kept."""
    return _SPACES.sub(" ", unicodedata.normalize("NFC", s.translate(_REPLACED)).translate(_PLAIN))


def _is_bare(e: Element) -> bool:
    """A wrapper without class and style, which says nothing."""
    return e.tag in BARE_TAGS and not e.attrs.get("class", "").strip() and not e.attrs.get("style", "").strip()


def clean(root: Element) -> None:
    """Drop script, style and head with the text that follows them, unwrap bare font and span, and normalise every text."""
    stack = [root]
    while stack:
        e = stack.pop()
        kept, after_removed = [], False
        todo = e.kids[::-1]
        while todo:
            k = todo.pop()
            if isinstance(k, str):
                if not after_removed:
                    kept.append(normalize(k))
                continue
            after_removed = k.tag in REMOVED_TAGS
            if after_removed:
                continue
            if _is_bare(k):
                todo.extend(reversed(k.kids))
            else:
                kept.append(k)
                stack.append(k)
        e.kids = kept


def markup_of(e: Element, tail: str = "") -> str:
    """An element of a tree as markup, with the text that follows it."""
    out: list[str] = []
    stack: list = [tail, e]
    escape = lambda x: _entities.escape(x, quote=False)
    while stack:
        k = stack.pop()
        if isinstance(k, tuple):
            out.append(k[0])
        elif isinstance(k, str):
            out.append(escape(k))
        else:
            out.append(f"<{k.tag}{''.join(f' {n}={chr(34)}{_entities.escape(v)}{chr(34)}' for n, v in k.attrs.items())}>")
            if k.tag in VOID_TAGS:
                continue
            stack.append((f"</{k.tag}>",))
            stack.extend((x,) if k.tag in RAW_TAGS and isinstance(x, str) else x for x in reversed(k.kids))
    return "".join(out)


# The patterns of style signals, as they must be for equal results.
_INDENT = re.compile(r"(?:text-indent|margin-left):\s*(-?[\d.]+)")
_BOLD = re.compile(r"font-weight:\s*(bold|[6-9]00)", re.IGNORECASE)
_PROFILE_INDENTS = (re.compile(r"text-indent:\s*([-\d.]+)"), re.compile(r"margin-left:\s*([-\d.]+)"))


def _number(m: re.Match | None) -> float | None:
    try:
        return float(m.group(1)) if m else None
    except ValueError:
        return None


def flatten(root: Element) -> list[dict]:
    """Innermost block elements with text, tables whole, in document order, of a cleaned tree."""
    body = next((e for e in root.walk() if e.tag == "body"), root)
    out: list[dict] = []

    def emit(e: Element, text: str) -> None:
        below = [x for x in e.walk()]
        style = e.attrs.get("style", "")
        tail = []
        if stack:  # the texts beside it up to the next element
            above, k = stack[-1]
            while k < len(above.kids) and isinstance(above.kids[k], str):
                tail.append(above.kids[k])
                k += 1
        out.append(
            {
                "text": text,
                "tag": e.tag,
                "classes": e.attrs.get("class", "").split(),
                "style_indent": _number(_INDENT.search(style)),
                "is_bold": bool(_BOLD.search(style)) or any(x.tag in ("b", "strong") for x in below[1:]),
                "is_italic": any(x.tag in ("i", "em") for x in below[1:]),
                "is_center": "center" in style.lower(),
                "is_table": e.tag == "table",
                "html_raw": markup_of(e, "".join(tail)),
                "anchors": [h for x in below if x.tag == "a" and (h := x.attrs.get("href"))],
            }
        )

    # Post-order without recursion: a frame is (element, next child, count of "produced" at entry).
    produced: list[bool] = [False]
    stack: list[tuple[Element, int]] = [(body, 0)]
    while stack:
        e, k = stack.pop()
        if k == 0 and e is not body:
            if e.tag == "table":
                text = e.text().strip()
                if text:
                    emit(e, text)
                produced[-1] = True
                continue
            produced.append(False)
        while k < len(e.kids) and isinstance(e.kids[k], str):
            k += 1
        if k < len(e.kids):
            stack.append((e, k + 1))
            stack.append((e.kids[k], 0))
            continue
        if e is body:
            break
        below = produced.pop()
        if not below and e.tag in BLOCK_TAGS:
            text = e.text().strip()
            if text:
                emit(e, text)
                below = True
        produced[-1] = produced[-1] or below
    return out


_BLANKS = re.compile(r"\s+")


def signature(root: Element) -> str:
    """Sorted distinct class tokens joined by vertical bars."""
    return "|".join(sorted({c for e in root.walk() for c in e.attrs.get("class", "").split()}))


BLOCK = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("style_indent", T.DoubleType()),
        T.StructField("is_bold", T.BooleanType()),
        T.StructField("is_italic", T.BooleanType()),
        T.StructField("is_center", T.BooleanType()),
        T.StructField("is_table", T.BooleanType()),
        T.StructField("html_raw", T.StringType()),
        T.StructField("anchors", T.ArrayType(T.StringType())),
    ]
)
FLAT = T.StructType(
    [
        T.StructField("blocks", T.ArrayType(BLOCK)),
        T.StructField("n_tables", T.IntegerType()),
        T.StructField("n_chars", T.IntegerType()),
        T.StructField("template_family", T.StringType()),
    ]
)
ELEMENT = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("style_indent", T.DoubleType()),
        T.StructField("is_bold", T.BooleanType()),
        T.StructField("text", T.StringType()),
    ]
)
PROFILE = T.StructType(
    [
        T.StructField("elements", T.ArrayType(ELEMENT)),
        T.StructField("has_table", T.BooleanType()),
        T.StructField("has_img", T.BooleanType()),
        T.StructField("has_link", T.BooleanType()),
        T.StructField("template_family", T.StringType()),
        T.StructField("parse_error", T.BooleanType()),
    ]
)
# Elements that profiling reads.
PROFILE_TAGS = frozenset(["p", "div", "span", "li", "td"])


def flatten_one(source: str | None) -> dict:
    """Blocks and measures of one document."""
    if source is None or not source.strip():
        return {"blocks": [], "n_tables": 0, "n_chars": 0, "template_family": ""}
    root = parse(source)
    clean(root)
    return {
        "blocks": flatten(root),
        "n_tables": sum(e.tag == "table" for e in root.walk()),
        "n_chars": len(_BLANKS.sub("", root.text())),
        "template_family": signature(root),
    }


def profile_one(source: str | None) -> dict:
    """Elements with text of one raw document, nested ones too, and its presence flags.

    Blank documents have no template; a document that cannot be read has nothing but ``parse_error``.
    """
    none = {"elements": [], "has_table": False, "has_img": False, "has_link": False, "template_family": None, "parse_error": False}
    if source is None or not source.strip():
        return none
    try:
        root = parse(source)
        every = list(root.walk())
        elements = []
        for e in every:
            if e.tag in PROFILE_TAGS and (text := e.text().strip()):
                style = e.attrs.get("style", "")
                indent = next((m for p in _PROFILE_INDENTS if (m := p.search(style))), None)
                elements.append({"tag": e.tag, "classes": e.attrs.get("class", "").split(), "style_indent": _number(indent), "is_bold": bool(_BOLD.search(style)), "text": text})
        return {
            "elements": elements,
            "has_table": any(e.tag == "table" for e in every),
            "has_img": any(e.tag == "img" for e in every),
            "has_link": any(e.tag == "a" and "href" in e.attrs for e in every),
            "template_family": signature(root),
            "parse_error": False,
        }
    except (RecursionError, ValueError, IndexError, KeyError, OverflowError):
        return none | {"parse_error": True}


@F.pandas_udf(FLAT)
def flatten_udf(source: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([flatten_one(s) for s in source], columns=[f.name for f in FLAT])


@F.pandas_udf(PROFILE)
def profile_udf(source: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([profile_one(s) for s in source], columns=[f.name for f in PROFILE])


@F.pandas_udf(T.StringType())
def nfc(c: pd.Series) -> pd.Series:
    """Canonical composition; null stays null."""
    return c.map(lambda s: s if s is None else unicodedata.normalize("NFC", s))


def flatten_documents(content: DataFrame, key: str, source: str) -> DataFrame:
    """One row for each document: key, ``flat.blocks`` and the measures; the single Python hop."""
    return content.select(F.col(key).alias("doc_id"), flatten_udf(F.col(source)).alias("flat"))


def explode_blocks(flat: DataFrame) -> DataFrame:
    """One row for each block, ``dom_order`` from 0."""
    return flat.select("doc_id", F.posexplode("flat.blocks").alias("dom_order", "b")).select("doc_id", "dom_order", "b.*")


def clean_text(c: Column) -> Column:
    """The text normalisation as column functions: NFC by an Arrow UDF, the rest in the JVM."""
    plain = F.translate(nfc(F.translate(c, "\u00a0\u202f", "  ")), "“”‘’–—", "\"\"''--")
    return F.regexp_replace(F.replace(plain, F.lit("…"), F.lit("...")), r"[ \t]+", " ")
