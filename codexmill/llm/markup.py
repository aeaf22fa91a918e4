"""Problem 2: markup residue in text documents, converted to clean text.

Method: tag-path ratios. A text is read into segments, each with its root-to-leaf tag
path. For every path the length of text, the punctuation, the length of link text and the
markup signs are summed; the ratios of each path are smoothed over neighbouring paths in
order of first appearance, fused by multiplication and held against a threshold. Two
decisions are made of them, the same for HTML and for plain text with leftover markup.

Residue: of a path the share of what a reader should see (text against markup signs),
smoothed, times its share of word characters. A construct that is nothing but signs scores
0, a line of text near 1; what only looks like a construct (a name in angle brackets, a path with
backslashes) shows its letters and scores as text. Paths below ``RESIDUE`` are residue:
they are taken away or turned into structure, and their kinds are the rows of ``p2_found``. A path stands for one
construct of one kind, so a single tag in a long text is judged by its own ratio and is not lost in the text around it.

Content: length and punctuation per segment, times a factor for paths through an element
that its name or class calls navigation or footer. Paths below ``THRESHOLD`` of the mean are chrome and go, unless they
hold plain words outside links and nothing calls them chrome: such text always stays. Paths are judged as
blocks: inline elements share the verdict of the block they stand in, and of a path of links only blocks without a word
outside links are dropped. Paths that carry structure (headings, list items, table cells, code, formulas) stay
unless they are called chrome. In plain text the lines are the blocks: bars of links (two or more, and no word
outside them) are one path, other lines another.

Defined results
* Headings stand on their own line after as many ``#`` as their level; list items start with
  ``- ``; table rows are lines with cells parted by `` | ``; code keeps its line breaks and
  blanks; formulas keep their source without delimiters (MathML in linear form).
* Comparisons, lone stars and currency signs, numbering, hyphens that open a line, reference
  numbers, paths and separators in plain lists are text, not markup.
* ``markup`` holds each of 'html', 'markdown', 'wiki', 'latex' that occurs, in this order.
* Null gives null and no kinds; empty gives empty. Texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import html as _entities
import math
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.operators.html import Tokens, parse

KINDS = ("html", "markdown", "wiki", "latex")
#: Share of the mean score that a path must reach, and neighbours on each side that smooth it.
THRESHOLD, RADIUS = 0.1, 2
#: Share of visible, worded text that a path must reach to be text.
RESIDUE = 0.3
STRUCTURAL = ("h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "pre", "code", "math", "formula")
# Elements that start a line, and elements that never hold content.
LINE_TAGS = frozenset("p div section article header footer main aside nav ul ol li table tr thead tbody h1 h2 h3 h4 h5 h6 pre blockquote dl dt dd center figure form hr caption".split())
CHROME_TAGS = frozenset("script style head noscript template iframe object nav button select".split())
# Element names that count as HTML in plain text.
HTML_NAMES = frozenset(
    "a abbr address area article aside audio b base bdi bdo big blockquote body br button canvas caption center cite code col colgroup data dd del details dfn dialog div dl dt em embed "
    "fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark math mi mn mo mfrac mrow msub msup meta nav "
    "noscript object ol option p param picture pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time "
    "title tr track tt u ul var video wbr o:p v:shape w:wrap st1:place".split()
)
# LaTeX commands that count without an argument in braces.
LATEX_BARE = frozenset(
    "item le leq ge geq neq ne times cdot div pm mp frac sqrt sum prod int infty alpha beta gamma delta epsilon theta lambda mu pi rho sigma tau phi omega Delta Sigma Omega "
    "left right ldots dots cdots quad qquad hline newline par noindent centering maketitle tableofcontents label ref cite".split()
)
PUNCTUATION = re.compile(r"[^\w\s]")
# Elements that make a block path; all others are inline.
BLOCK_TAGS = LINE_TAGS | frozenset(STRUCTURAL)
# Elements and words of a class or id that call a part of a page chrome, and the factor of its paths.
CHROME_ELEMENTS = ("footer", "aside")
CHROME_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer sidebar pager pagination toolbar share copyright banner".split())
CHROME_FACTOR = 0.01


def block_of(path: str) -> str:
    """The path without its inline elements."""
    return "/".join(x for x in path.split("/") if not x or x.split(".", 1)[0] in BLOCK_TAGS)


def is_called_chrome(path: str) -> bool:
    """Whether an element of the path is chrome by name or by a word of its class, which stands after a full stop."""
    return any("." in x or x in CHROME_ELEMENTS for x in path.split("/"))


_WEIGHT = [math.exp(-k * k / 2) for k in range(RADIUS + 1)]


def smooth(x: list[float], radius: int = RADIUS) -> list[float]:
    """Each value with its neighbours on both sides, nearer ones weighing more."""
    weight = _WEIGHT if radius == RADIUS else [math.exp(-k * k / 2) for k in range(radius + 1)]
    out = []
    for i in range(len(x)):
        near = [(weight[abs(i - j)], x[j]) for j in range(max(0, i - radius), min(len(x), i + radius + 1))]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


class Paths:
    """Sums for each tag path of one text: segments, characters, punctuation, link characters and markup signs."""

    def __init__(self) -> None:
        self.sums: dict[str, list[float]] = {}

    def add(self, path: str, text: str, link: bool = False, signs: int = 0) -> None:
        s = self.sums.setdefault(path, [0, 0, 0, 0, 0])
        n = len(text.strip())
        s[0] += 1
        s[1] += n
        s[2] += len(PUNCTUATION.findall(text))
        s[3] += n if link else 0
        s[4] += signs

    def residue(self, threshold: float = RESIDUE, radius: int = RADIUS) -> set[str]:
        """Paths that a reader should not see: what they show is too little for their signs."""
        shown = [s[1] / (s[1] + s[4]) if s[1] + s[4] else 1.0 for s in self.sums.values()]
        worded = [1 - s[2] / (s[1] + 1) for s in self.sums.values()]
        # A path is lifted by the text beside it, but not above its own ratio.
        fused = [min(a, b) * c for a, b, c in zip(smooth(shown, radius), shown, worded)]
        return {p for (p, s), score in zip(self.sums.items(), fused) if s[4] and score < threshold}

    def content(self, threshold: float = THRESHOLD, radius: int = RADIUS) -> set[str]:
        """Paths that hold content: smoothed and fused ratios of their blocks reach ``threshold`` of the mean."""
        blocks: dict[str, list[float]] = {}
        for p, v in self.sums.items():
            s = blocks.setdefault(block_of(p), [0, 0, 0, 0, 0])
            s[:] = [a + b for a, b in zip(s, v)]
        length = smooth([s[1] / s[0] for s in blocks.values()], radius)
        marks = smooth([(s[2] + 1) / s[0] for s in blocks.values()], radius)
        own = [s[1] * (s[2] + 1) / s[0] ** 2 for s in blocks.values()]
        factor = [CHROME_FACTOR if is_called_chrome(b) else 1.0 for b in blocks]
        # A short block beside a long one is lifted by smoothing, but not above its own ratios.
        fused = [min(a * b, c) * f for a, b, c, f in zip(length, marks, own, factor)]
        level = threshold * (sum(fused) / len(fused) if fused else 0)
        keep = set()
        for (block, s), score, f in zip(blocks.items(), fused, factor):
            structural = any(x in STRUCTURAL for x in block.split("/"))
            if score >= level or (f == 1.0 and (structural or s[3] <= s[1] / 2)):
                keep.add(block)
        return {p for p in self.sums if block_of(p) in keep}


def _math(e) -> str:
    """MathML in linear form."""
    if isinstance(e, str):
        return e.strip()
    parts = [x for x in (_math(k) for k in e.kids) if x]
    if e.tag == "mfrac" and len(parts) == 2:
        return f"{parts[0]}/{parts[1]}"
    if e.tag in ("msup", "msub") and len(parts) == 2:
        return f"{parts[0]}{'^' if e.tag == 'msup' else '_'}{parts[1]}"
    if e.tag == "msqrt":
        return f"√({' '.join(parts)})"
    return " ".join(parts)


_SPACE = re.compile(r"[^\S\n]+")


def _chrome_word(e) -> str:
    """``.`` and the word of an element's class or id that calls it chrome, or nothing."""
    if "class" not in e.raw and "id" not in e.raw:
        return ""
    words = re.split(r"[\s_-]+", f"{e.attrs.get('class', '')} {e.attrs.get('id', '')}".lower())
    return next((f".{w}" for w in words if w in CHROME_WORDS), "")


def html_segments(source: str) -> list[tuple[str, str, str, bool]]:
    """(path, role, text, is link) of an HTML source in order; role ``line`` marks the start of a line."""
    out: list[tuple[str, str, str, bool]] = []
    stack: list[tuple[object, str, str, bool, bool]] = [(parse(source), "", "text", False, False)]
    while stack:
        e, path, role, link, leaving = stack.pop()
        if leaving:
            out.append((path, "line", "", False))
            continue
        if isinstance(e, str):
            if role == "pre":
                out.append((path, role, e, link))
            elif e and not e.isspace():
                out.append((path, role, _SPACE.sub(" ", e.replace("\n", " ")), link))
            elif e:
                out.append((path, "gap", " ", link))
            continue
        tag = e.tag
        if tag in CHROME_TAGS:
            continue
        if tag == "br":
            out.append((path, "line", "\n", False))
            continue
        if tag == "math":
            try:
                formula = _math(e)
            except RecursionError:  # nested beyond reason: its plain text
                formula = e.text()
            out.append((f"{path}/math", "formula", formula, False))
            continue
        below = f"{path}/{tag.replace('.', '')}{_chrome_word(e)}" if tag and ":" not in tag else path
        if tag in LINE_TAGS:
            out.append((below, "line", "", False))
            stack.append((None, below, "", False, True))
        if tag in ("td", "th"):
            out.append((below, "cell", "", False))
        elif tag == "li":
            out.append((below, "item", "", False))
        elif re.fullmatch("h[1-6]", tag):
            out.append((below, "heading", "#" * int(tag[1]) + " ", False))
        role = "pre" if tag in ("pre", "textarea") or role == "pre" else role
        link = link or (tag == "a" and bool(e.attrs.get("href")))
        for k in reversed(e.kids):
            stack.append((k, below, role, link, False))
    return out


def html_paths(segments: list[tuple[str, str, str, bool]]) -> Paths:
    """Sums of each tag path of the segments."""
    paths = Paths()
    for path, role, text, link in segments:
        if role in ("text", "pre", "formula"):
            paths.add(path, text, link)
    return paths


def _chrome(segments: list[tuple[str, str, str, bool]]) -> set[int]:
    """Places of the segments to drop: on paths below the threshold, blocks that are called chrome or have no word outside links."""
    keep = html_paths(segments).content()
    out: set[int] = set()
    block: list[int] = []
    for i, (path, role, text, link) in enumerate([*segments, ("", "line", "", False)]):
        if role in ("text", "pre", "formula"):
            block.append(i)
        elif role != "gap" and text != "\n":  # a br does not end a block
            if not any(segments[k][0] in keep or (not segments[k][3] and not is_called_chrome(segments[k][0]) and re.search(r"\w", segments[k][2])) for k in block):
                out.update(block)
            block = []
    return out


def clean_html(source: str | None) -> str | None:
    """Clean text of an HTML source."""
    if source is None or not source.strip():
        return source
    segments = html_segments(source)
    chrome = _chrome(segments)
    lines: list[str] = []
    line, cells, verbatim = "", 0, False
    for place, (path, role, text, _) in enumerate(segments):
        if role == "line":
            if re.search("/t[dh](?:[./]|$)", path):  # inside a cell a line is a blank
                line += "" if line.endswith((" ", "| ")) or not line else " "
                continue
            if line.strip():
                lines.append(line.rstrip() if verbatim else line.strip())
            line, verbatim, cells = "", False, 0
        elif role == "cell":
            if cells and line:
                line = line.rstrip() + " | "
            cells += 1
        elif role == "item":
            line = "- "
        elif role == "heading":
            line = text
        elif role == "pre":
            if place not in chrome:
                parts = (line + text).split("\n")
                lines += [x.rstrip() for x in parts[:-1]]
                line, verbatim = parts[-1], True
        elif role == "gap":
            if line and not line.endswith(" "):
                line += " "
        elif place not in chrome:
            line += text if not line.endswith(" ") else text.lstrip()
    if line.strip():
        lines.append(line.rstrip() if verbatim else line.strip())
    return "\n".join(x for x in lines if x.strip() not in ("", "-"))


_SENTINEL = re.compile("\ue000(\\d+)\ue001")
_FENCE = re.compile(r"^[ \t]*(```+|~~~+)[^\n`]*\n(.*?)(?:^[ \t]*\1[ \t]*$|\Z)", re.MULTILINE | re.DOTALL)
_INLINE_CODE = re.compile(r"(?<!`)`([^`\n]+)`(?!`)")
_SECTION = re.compile(r"<!\[CDATA\[|\]\]>")
# Attributes without a value.
_FLAGS = frozenset("disabled checked selected nowrap noshade hidden required readonly multiple".split())
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_NESTED_AMP = re.compile(r"&(?:amp;)+(?=(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});)")
_MATH_BLOCK = re.compile(r"(?<![\\$\w])\$\$([^$]+)\$\$(?!\$)")
_MATH_SIGN = re.compile(r"[\\^_={]")
_ENV = re.compile(r"\\(begin|end)\s*\{([A-Za-z]+\*?)\}(?:\[[^\]\n]*\])?(?:\{[lcr|]+\})?")
_COMMAND = re.compile(r"(?<![:\\])\\([A-Za-z]+)\*?(?:\[[^\]\n]*\])?\{|[{}]")
_BARE = re.compile(r"(?<![\w:\\])\\([A-Za-z]+)(?![A-Za-z{])")
_BRACES = re.compile(r"\{\{|\}\}|[{}]")
_WIKI_LINK = re.compile(r"\[\[([^\[\]\n]+)\]\]")
_WIKI_OPEN = re.compile(r"(?<!')'{3,5}(?!')")
_WIKI_URL = re.compile(r"(?<!\[)\[(?:https?|ftp)://[^\s\]]+(?:\s+([^\]\n]+))?\](?!\()")
_MD_HEAD = re.compile(r"^[ ]{0,3}(#{1,6})[ \t]+(?=[^\n]*[^\W\d_])(\S[^\n]*)$", re.MULTILINE)
_MD_QUOTE = re.compile(r"^[ ]{0,3}(?:>[ \t]?)+(?=\S)", re.MULTILINE)
_MD_LINK = re.compile(r"!?\[([^\[\]\n]*)\]\(((?:[#/.]|https?:|ftp:|mailto:|www\.|[\w-]+[./])[^()\s]*(?:\s+\"[^\"\n]*\")?)\)")
_MD_STRIKE = re.compile(r"~~(?=[^\s~])([^~\n]*?[^\s~])~~")
_MD_EM = re.compile(r"(?:(?<=\s)|(?<=^))\*(?=[^\W_])([^*\n()]*[^\s*()])\*(?=[\s.,;:!?]|$)|(?:(?<=\s)|(?<=^))_(?=[^\W_])([^_\n]*[^\s_])_(?=[\s.,;:!?]|$)", re.MULTILINE)
_MD_RULE = re.compile(r"[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*")
_MD_TABLE_ROW = re.compile(r"^[ \t]*\|([^\n]+)\|[ \t]*$", re.MULTILINE)

#: A text without any of these signs has no markup; the JVM passes it by.
SUSPECT = r"[<&`\\$\[{~*_#>|]|''|=="


_LINKS = re.compile(rf"(?<!!){_MD_LINK.pattern.removeprefix('!?')}|{_WIKI_LINK.pattern}|{_WIKI_URL.pattern}|<a\s(?P<open>[^<>]*)>(?P<inner>(?:(?!</?a[\s>])[^\n])*)</a\s*>", re.IGNORECASE)
_SHORT_TAG = re.compile(r"<(/?)([A-Za-z][\w:-]*)(\s[^<>=]*=[^<>]*|\s*/?)>")
#: Lines that carry structure in plain text: headings, list items, table rows.
_STRUCTURED = re.compile(r"[ \t]*(?:#{1,6}[ \t]|={2,6}|[-*+•][ \t]|\d+[.)]|[|!]|\{\||\\item\b|<(?:li|t[dhr]|h[1-6])\b)", re.IGNORECASE)


def _line_paths(text: str) -> list[tuple[str, str, list[str]]]:
    """(path, line, texts of its links if it is a bar of links) of the lines of a plain text."""
    fenced = [m.span() for m in _FENCE.finditer(text)] if "```" in text or "~~~" in text else []
    out, at, f = [], 0, 0
    for line in text.split("\n"):
        while f < len(fenced) and fenced[f][1] <= at:
            f += 1
        code = f < len(fenced) and fenced[f][0] <= at
        at += len(line) + 1
        found = [] if code else list(_LINKS.finditer(line))
        links = [m["inner"] or next((g for g in m.groups() if g), "") for m in found if m["open"] is None or "href" in m["open"].lower()]
        rest = _SHORT_TAG.sub(lambda m: "" if m[2].lower() in HTML_NAMES else m[0], _LINKS.sub("", line)) if links else line
        bar = len(links) == len(found) > 1 and not re.search(r"\w", rest) and not _STRUCTURED.match(line)
        out.append(("/pre" if code else "/li" if _STRUCTURED.match(line) else "/nav" if bar else "/p", line, links if bar else []))
    return out


def _without_chrome(lines: list[tuple[str, str, list[str]]]) -> str:
    """The text without its bars of links, if the ratios call them chrome."""
    paths = Paths()
    for path, line, links in lines:
        if line.strip():
            paths.add(path, "".join(links) if links else line, bool(links))
    keep = paths.content()
    return "\n".join(line for path, line, _ in lines if path in keep or path != "/nav")


def clean_mixed(text: str | None) -> tuple[str | None, list[str], dict[str, list[float]]]:
    """Clean text, kinds of markup and tag-path sums of a plain text with leftover markup.

    Paths of lines start with ``/``; paths of constructs are ``kind:construct``. The kinds are those of the residue.
    """
    if not text:
        return text, [], {}
    clean, paths = _convert(text, frozenset())
    residue = paths.residue()
    alike = frozenset(p for p in residue if paths.sums[p][1])  # what shows letters, yet too few among all the signs
    if alike:
        clean, _ = _convert(text, alike)
    if residue & {"html:a", "markdown:a", "wiki:a"}:
        lines = _line_paths(text)
        lean = _without_chrome(lines)
        if len(lean) != len(text):
            clean = _convert(lean, alike)[0] if lean else lean
    found = {p.split(":", 1)[0] for p in residue if not p.startswith("/")}
    return clean, [k for k in KINDS if k in found], paths.sums


def _balanced(s: str, token: re.Pattern, opens, convert, closers: dict[str, str], strict: bool = False) -> str:
    """``s`` with its nested groups rewritten from the inside out, in one pass over a stack.

    ``opens(m)``: the kind of an opener, None for a closer. A closer ends the group on top of the stack if
    ``closers`` has that group's kind for it. ``convert(kind, opener, inner)`` gives the new text, or None to leave the group; with
    ``strict`` a group around one that is left is left as well.
    """
    out: list[str] = []
    stack: list[list] = []  # kind, opener, place in out, whether a group inside was left
    at = 0
    for m in token.finditer(s):
        out.append(s[at : m.start()])
        at = m.end()
        kind = opens(m)
        if kind is not None:
            stack.append([kind, m, len(out), False])
            out.append(m[0])
            continue
        done = None
        if stack and stack[-1][0] in closers[m[0]]:
            kind, opener, k, spoiled = stack.pop()
            if not (strict and spoiled):
                done = convert(kind, opener, "".join(out[k + 1 :]))
            if done is not None:
                out[k:] = [done]
        if done is None:
            out.append(m[0])
            if stack:
                stack[-1][3] = True
    out.append(s[at:])
    return "".join(out)


def _spans(line: str, sign: str, lengths: range, before: str, after: str) -> list[tuple[int, int, int]]:
    """(start, end, length of the delimiter) of the spans between equal runs of ``sign`` in a line, nested ones too.

    An opener has a text behind it and no character of ``before`` in front; a closer has a text in front of it and no
    character of ``after`` behind. The nearest closer of the same length ends a span; what opened inside and is still open opens nothing.
    """
    out, waiting = [], []
    for m in re.finditer(rf"{re.escape(sign)}{{2,}}", line):
        a, b = m.span()
        n = b - a
        if n not in lengths:
            continue
        left, right = line[a - 1] if a else "", line[b] if b < len(line) else ""
        if left and not left.isspace() and not (right and re.match(after, right)):
            k = next((k for k in range(len(waiting) - 1, -1, -1) if waiting[k][1] - waiting[k][0] == n), -1) if any(w[1] - w[0] == n for w in waiting) else -1
            if k >= 0:
                out.append((waiting[k][0], b, n))
                del waiting[k:]
                continue
        if right and not right.isspace() and not (left and re.match(before, left)) and all(w[1] - w[0] != n for w in waiting):
            waiting.append((a, b))
    return out


def _unwrap(s: str, sign: str, lengths: range, before: str, after: str, note) -> str:
    """``s`` without the delimiters of spans; ``note(length)`` is told of each."""
    lines = s.split("\n")
    for i, line in enumerate(lines):
        if sign * 2 not in line:
            continue
        spans = _spans(line, sign, lengths, before, after)
        if spans:
            gone = sorted([(a, a + n) for a, _, n in spans] + [(b - n, b) for _, b, n in spans])
            at, kept = 0, []
            for a, b in gone:
                kept.append(line[at:a])
                at = b
            lines[i] = "".join([*kept, line[at:]])
            for _, _, n in spans:
                note(n)
    return "\n".join(lines)


def _cut_spans(s: str, spans: list[tuple[int, int, str]]) -> str:
    """``s`` with each (start, end, text) replaced; spans ascend and do not overlap."""
    out, at = [], 0
    for a, b, new in spans:
        out += [s[at:a], new]
        at = b
    return "".join([*out, s[at:]])


def _between(s: str, opener: str, closer: str, least: int = 1) -> list[tuple[int, int, str]]:
    """(start, end, inner) from each opener to the nearest closer, read once."""
    out, at = [], 0
    while (a := s.find(opener, at)) >= 0 and (b := s.find(closer, a + len(opener) + least)) >= 0:
        at = b + len(closer)
        out.append((a, at, s[a + len(opener) : b]))
    return out


def _inline_math(s: str) -> list[tuple[int, int, str]]:
    """``$...$`` in a line with a sign of mathematics, no blank at its ends, and no digit behind it, as in amounts of money."""
    signs, out, k = [m.start() for m in re.finditer(r"\$", s)], [], 0
    while k + 1 < len(signs):
        a, b = signs[k], signs[k + 1]
        inner = s[a + 1 : b]
        left, right = s[a - 1] if a else "", s[b + 1] if b + 1 < len(s) else ""
        fits = inner and not inner[0].isspace() and not inner[-1].isspace() and inner[-1] != "\\" and "\n" not in inner and _MATH_SIGN.search(inner)
        if fits and not (left and (left in "\\$" or left == "_" or left.isalnum())) and not (right and (right == "$" or right.isdigit())):
            out.append((a, b + 1, inner))
            k += 2
        else:
            k += 1
    return out


def _tags(s: str, note, alike: frozenset[str]) -> str:
    """``s`` without comments and tags; attributes may be of any length and hold angle brackets in quotes."""
    tokens, out, at, look = Tokens(s), [], 0, 0
    while token := tokens.next(look):
        start, end, name, closing, raw = token
        look = end
        if not name:
            if s.startswith("<!--", start) and s[end - 3 : end] == "-->" or s[start : start + 9].upper() == "<!DOCTYPE":
                note("html:comment", end - start)
                out.append(s[at:start])
                at = end
            else:
                look = start + 1
            continue
        low = name.lower()
        own = raw.strip().rstrip("/").strip()
        if own and (not raw[0].isspace() or ("=" not in own and not all(w.lower() in _FLAGS for w in own.split()))):
            look = start + 1
            continue
        if low not in HTML_NAMES:
            path = f"html:{low}"
            if not closing:
                note(path, 2 + own.count("=") * 3, shown=name + "".join(c for c in own if c.isalnum()))
            if path not in alike:
                look = start + 1
                continue
        else:
            note(f"html:{low}", end - start, link=low == "a")
        out += [s[at:start], "\n" if low == "br" or (closing and low in LINE_TAGS) else ""]
        at = end
    return "".join([*out, s[at:]])


def _convert(text: str, alike: frozenset[str]) -> tuple[str, Paths]:
    """The text with its constructs turned into structure or taken away, and the sums of its paths.

    Look-alikes (unknown names) are noted with the letters they show and go only if their path is in ``alike``.
    """
    paths, kept = Paths(), []
    for line in text.split("\n"):
        if line.strip():
            paths.add("/li" if _STRUCTURED.match(line) else "/p", line)

    def note(path: str, signs: int, shown: str = "", link: bool = False) -> None:
        paths.add(path, shown, link, signs)

    def take(path: str, m: re.Match, inner: str, link: bool = False) -> str:
        note(path, len(m[0]) - len(inner), link=link)
        return inner

    def keep(path: str, signs: int, inner: str) -> str:
        note(path, signs)
        kept.append(inner)
        return f"\ue000{len(kept) - 1}\ue001"

    s = text
    if "`" in s or "~~~" in s:
        s = _FENCE.sub(lambda m: keep("markdown:pre/code", len(m[0]) - len(m[2]), m[2].rstrip("\n")), s)
        s = _INLINE_CODE.sub(lambda m: keep("markdown:code", 2, m[1]), s)
    if "<" in s or "&" in s:
        while True:  # escaped markup shows its tags only after a round of unescaping
            was = s
            s = _SECTION.sub(lambda m: take("html:comment", m, ""), s)
            if "<" in s:
                s = _tags(s, note, alike)
            s = _ENTITY.sub(_entity(note), _NESTED_AMP.sub(lambda m: take("html:entity", m, "&"), s))
            if s == was:
                break
    if "\\" in s or "$" in s:
        for opener, closer in (("\\(", "\\)"), ("\\[", "\\]")):
            if opener in s:
                s = _cut_spans(s, [(a, b, keep("latex:math", 4, x.strip())) for a, b, x in _between(s, opener, closer)])
        s = _MATH_BLOCK.sub(lambda m: keep("latex:math", 4, m[1].strip()), s)
        s = _cut_spans(s, [(a, b, keep("latex:math", 2, x.strip())) for a, b, x in _inline_math(s)])
        s = _ENV.sub(lambda m: take(f"latex:{m[2]}", m, ""), s)
        if "{" in s:
            s = _balanced(s, _COMMAND, lambda m: "command" if m[1] else "{" if m[0] == "{" else None, lambda kind, m, inner: _command(note, m, inner) if kind == "command" else None, {"}": ("command", "{")})
        s = _BARE.sub(lambda m: _bare(note, m, alike), s)
        s = re.sub(r"^- [ \t]+", "- ", s, flags=re.MULTILINE)
    if "{|" in s:
        s = _wiki_tables(note, s)
    if "[[" in s:
        s = _WIKI_LINK.sub(lambda m: take("wiki:a", m, m[1].rsplit("|", 1)[-1], True), s)
    if "{{" in s:
        s = _balanced(s, _BRACES, lambda m: m[0] if m[0][0] == "{" else None, lambda kind, m, inner: _template(note, inner) if kind == "{{" else None, {"}": ("{",), "}}": ("{{",)}, strict=True)
    if "[" in s:
        s = _MD_LINK.sub(lambda m: take("markdown:a", m, m[1], True), s)
        s = _WIKI_URL.sub(lambda m: take("wiki:a", m, m[1] or "", True), s)
    if "==" in s:
        s = "\n".join(_wiki_heading(note, line) if "==" in line else line for line in s.split("\n"))
    if "''" in s:
        s = _unwrap(s, "'", range(2, 6), r"(?!)", r"(?!)", lambda n: note("wiki:b" if n > 2 else "wiki:i", 2 * n))
        s = _WIKI_OPEN.sub(lambda m: take("wiki:i", m, ""), s)
    if "#" in s:
        was_wiki = any(p.startswith("wiki:h") for p in paths.sums)
        s = _MD_HEAD.sub(lambda m: m[0] if was_wiki and m[0] not in text else m[1] + " " + take(f"markdown:h{len(m[1])}", m, m[2].rstrip(" \t").rstrip("#").rstrip(" \t")), s)
    if "**" in s:
        s = _unwrap(s, "*", range(2, 4), r"[\w\\]", r"(?!)", lambda n: note("markdown:b", 2 * n))
    if "__" in s:
        s = _unwrap(s, "_", range(2, 4), r"[\w\\]", r"\w", lambda n: note("markdown:b", 2 * n))
    if "~~" in s:
        s = _MD_STRIKE.sub(lambda m: take("markdown:del", m, m[1]), s)
    if "*" in s or "_" in s:
        s = _MD_EM.sub(lambda m: take("markdown:i", m, m[1] if m[1] is not None else m[2]), s)
    if ">" in s:
        s = _MD_QUOTE.sub(lambda m: take("markdown:blockquote", m, ""), s)
    if "|" in s and "---" in s:
        s = _md_tables(note, s)
    while kept and _SENTINEL.search(s):  # code may stand in a formula and the like
        was = s
        s = _SENTINEL.sub(lambda m: kept[int(m[1])] if int(m[1]) < len(kept) else m[0], s)
        if s == was:
            break
    return s, paths


def _entity(note):
    def sub(m: re.Match) -> str:
        plain = _entities.unescape(m[0])
        if plain == m[0] or plain.endswith(";"):
            return m[0]
        note("html:entity", len(m[0]))
        return " " if plain == "\u00a0" else plain

    return sub


def _bare(note, m: re.Match, alike: frozenset[str]) -> str:
    """A command without an argument: list items become structure; an unknown name shows its letters."""
    path = f"latex:{m[1]}"
    if m[1] == "item":
        note("latex:li", len(m[0]))
        return "- "
    known = m[1] in LATEX_BARE
    note(path, len(m[0]) if known else 1, shown="" if known else m[1])
    return "" if path in alike else m[0]


def _command(note, m: re.Match, inner: str) -> str:
    note(f"latex:{m[1]}", len(m[0]) + 1)
    return f" ({inner})" if m[1] in ("footnote", "footnotetext") else "" if m[1] in ("label", "vspace", "hspace", "usepackage", "documentclass") else inner


def _template(note, inner: str) -> str | None:
    if not inner or "{" in inner or "}" in inner:
        return None
    shown = inner.rsplit("|", 1)[-1] if "|" in inner else ""
    note("wiki:template", len(inner) + 4 - len(shown))
    return shown


def _wiki_heading(note, line: str) -> str:
    bare = line.strip(" \t")
    n = min(6, len(bare) - len(bare.lstrip("=")))
    inner = bare[n : len(bare) - n].strip(" \t")
    if n < 2 or len(bare) <= 2 * n or not bare.endswith("=" * n) or not inner or inner[0] == "=":
        return line
    note(f"wiki:h{n}", 2 * n)
    return "#" * n + " " + inner


def _wiki_tables(note, s: str) -> str:
    """Tables from ``{|`` to ``|}``, innermost first; one that is not closed stays."""
    out: list[str] = []
    opened: list[int] = []
    for line in s.split("\n"):
        bare = line.lstrip(" \t")
        if bare.startswith("{|"):
            opened.append(len(out))
            out.append(line)
        elif bare.startswith("|}") and opened:
            k = opened.pop()
            rest = bare[2:]
            out[k:] = [_wiki_table(note, out[k + 1 :]) + rest]
        else:
            out.append(line)
    return "\n".join(out)


def _wiki_table(note, body: list[str]) -> str:
    rows: list[list[list[str]]] = [[]]
    for line in "\n".join(body).split("\n"):
        line = line.strip()
        if line.startswith("|-"):
            rows.append([])
        elif line[:1] in ("|", "!"):
            cells = [c.strip() for c in re.split(r"\|\||!!", line[1:])]
            for _ in cells:
                note("wiki:td", 2)
            rows[-1] += [[c] for c in cells]
        elif line and rows[-1]:
            rows[-1][-1].append(line)
    note("wiki:table", 4)
    return "\n".join(" | ".join(" ".join(c) for c in r) for r in rows if r)


def _md_tables(note, s: str) -> str:
    """Rules under a row of cells go; rows between bars lose the outer ones."""
    lines = s.split("\n")
    rules = {k for k, line in enumerate(lines) if "---" in line and _MD_RULE.fullmatch(line)}
    if not any(k and "|" in lines[k - 1] and k - 1 not in rules for k in rules):
        return s
    for k in rules:
        note("markdown:td", len(lines[k]))
    s = "\n".join(line for k, line in enumerate(lines) if k not in rules)
    return _MD_TABLE_ROW.sub(lambda m: " | ".join(x.strip() for x in m[1].split("|")), s)


CLEAN = T.StructType([T.StructField("clean_text", T.StringType()), T.StructField("markup", T.ArrayType(T.StringType()))])


@F.pandas_udf(CLEAN)
def _clean_mixed(text: pd.Series) -> pd.DataFrame:
    done = [clean_mixed(t) for t in text]
    return pd.DataFrame({"clean_text": [d[0] for d in done], "markup": [d[1] for d in done]})


#: Not deterministic to the optimizer, which then does not copy the call into a filter below ``explode``.
clean_mixed_udf = _clean_mixed.asNondeterministic()


@F.pandas_udf(T.StringType())
def clean_html_udf(source: pd.Series) -> pd.Series:
    return source.map(clean_html)


def clean_plain(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, clean_text, markup`` of texts with leftover markup.

    Rows without a suspect sign stay in the JVM; the others pass one Arrow hop. Narrow: no shuffle.
    """
    rows = df.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    suspect = F.coalesce(F.col("__text").rlike(SUSPECT), F.lit(False))
    plain = rows.filter(~suspect).select("__key", F.col("__text").alias("clean_text"), F.array().cast("array<string>").alias("markup"))
    dirty = rows.filter(suspect).select("__key", clean_mixed_udf("__text").alias("c")).select("__key", "c.clean_text", "c.markup")
    return plain.unionByName(dirty).withColumnRenamed("__key", key)


def markup_found(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, markup``: one row for each kind of markup in a text, by the tag paths found there."""
    rows = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).filter(F.col("__text").rlike(SUSPECT))
    return rows.select("__key", clean_mixed_udf("__text").alias("c")).select(F.col("__key").alias(key), F.explode("c.markup").alias("markup"))


def clean_source(df: DataFrame, key: str, source: str) -> DataFrame:
    """``key, clean_text`` of HTML sources. Narrow: no shuffle."""
    return df.select(F.col(key), clean_html_udf(F.col(source)).alias("clean_text"))


_SUMS = T.ArrayType(
    T.StructType(
        [T.StructField("path", T.StringType()), T.StructField("place", T.LongType())] + [T.StructField(c, T.LongType()) for c in ("n", "chars", "marks", "links")]
    )
)


@F.pandas_udf(_SUMS)
def _html_paths(source: pd.Series) -> pd.Series:
    def one(s: str | None) -> list[dict]:
        if s is None or not s.strip():
            return []
        return [dict(path=p, place=i, n=v[0], chars=v[1], marks=v[2], links=v[3]) for i, (p, v) in enumerate(html_paths(html_segments(s)).sums.items())]

    return source.map(one)


html_paths_udf = _html_paths.asNondeterministic()


def tag_paths(df: DataFrame, group: str, source: str, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """``group, path, n, chars, marks, links, score, is_content``: the ratios over all records of a group.

    The same rule as within a record, for sources that come in many records, such as the parts of a document:
    only path sums travel, combined on the map side, never texts. Blocks are in order of first appearance,
    of equal places by name; ``score`` and ``is_content`` of a path are those of its block.
    """
    rows = df.select(F.col(group).alias("__g"), F.explode(html_paths_udf(F.col(source))).alias("p")).select("__g", "p.*")
    counted = ("n", "chars", "marks", "links")
    sums = rows.groupBy("__g", "path").agg(F.min("place").alias("place"), *[F.sum(c).alias(c) for c in counted])
    inline_out = F.filter(F.split("path", "/"), lambda x: (x == "") | F.substring_index(x, ".", 1).isin(*sorted(BLOCK_TAGS)))
    sums = sums.withColumn("__block", F.array_join(inline_out, "/"))
    blocks = sums.groupBy("__g", "__block").agg(
        F.min("place").alias("place"), *[F.sum(c).alias(f"__{c}") for c in counted], F.collect_list(F.struct("path", *counted)).alias("__paths")
    )
    order = W.partitionBy("__g").orderBy("place", "__block")
    weight = [math.exp(-k * k / 2) for k in range(radius + 1)]

    def smooth(x: Column) -> Column:
        near = [(weight[abs(k)], F.lag(x, k).over(order) if k > 0 else F.lead(x, -k).over(order) if k < 0 else x) for k in range(-radius, radius + 1)]
        total = reduce(lambda a, b: a + b, [F.coalesce(v * w, F.lit(0.0)) for w, v in near])
        return total / reduce(lambda a, b: a + b, [F.when(v.isNotNull(), F.lit(w)).otherwise(0.0) for w, v in near])

    length, marks = F.col("__chars") / F.col("__n"), (F.col("__marks") + 1) / F.col("__n")
    scored = blocks.withColumns({"__l": smooth(length), "__m": smooth(marks)}).withColumn("__parts", F.split("__block", "/"))
    called = F.exists("__parts", lambda x: x.contains(".") | x.isin(*CHROME_ELEMENTS))
    scored = scored.withColumn("score", F.least(F.col("__l") * F.col("__m"), length * marks) * F.when(called, CHROME_FACTOR).otherwise(1.0))
    level = threshold * F.avg("score").over(W.partitionBy("__g"))
    structural = F.arrays_overlap("__parts", F.array(*[F.lit(x) for x in STRUCTURAL]))
    scored = scored.withColumn("is_content", (F.col("score") >= level) | (~called & (structural | (F.col("__links") <= F.col("__chars") / 2))))
    return scored.select(F.col("__g").alias(group), F.inline("__paths"), "score", "is_content")
