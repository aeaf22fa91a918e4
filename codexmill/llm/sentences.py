"""Problem 9: sentence boundaries across languages and scripts.

Method: a pushdown automaton. Its stack holds the open quotations and brackets, the
list label at the head of a paragraph is read first, and its input symbols are only
the characters that can matter (terminators, quotation marks, brackets and, in Thai,
blanks), found by one compiled pattern. Abbreviations are kept in a trie that is read
backwards from the full stop.

Defined results
* A sentence end is the number of characters (code points) up to and with the last
  character of the sentence, closing marks included, blanks after it excluded.
* A paragraph always ends a sentence; paragraphs of only white space give none.
* An opener without a closer in its paragraph opens nothing, a closer without an
  opener closes nothing.
* Null text gives no rows; empty text gives no rows. Texts of any length are read
  whole. Repeated rows are split alike. Other columns are ignored.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Abbreviations that a name or another word follows.
ABBREVIATIONS_BEFORE_NAMES = (
    "ts ths ks bs ls cn gs pgs pgs.ts gs.ts ths.bs tp tx tt kt tm tl tuq ql đ/c nxb ng "
    "dr mr mrs ms prof st rev hon capt col gen mm mme mlle me mgr pr ste cf e.g i.e vs viz p.ex"
).split()
# Abbreviations that a number follows.
ABBREVIATIONS_BEFORE_NUMBERS = "tr no nos art arts para paras p pp vol fig figs sec secs ch chap al n° nº số đ k khoản pt app".split()
# Abbreviations that may close a sentence.
ABBREVIATIONS_CLOSING = "v.v vv v..v etc ltd inc corp co jr sr a.m p.m bros plc ltée cie".split()

NAME, NUMBER, CLOSING = 1, 2, 3


def _trie(words: dict[str, int]) -> dict:
    """A trie over the reversed words; the empty key holds the kind."""
    root: dict = {}
    for word, kind in words.items():
        node = root
        for ch in reversed(word):
            node = node.setdefault(ch, {})
        node[""] = kind
    return root


TRIE = _trie(
    {w: NAME for w in ABBREVIATIONS_BEFORE_NAMES} | {w: NUMBER for w in ABBREVIATIONS_BEFORE_NUMBERS} | {w: CLOSING for w in ABBREVIATIONS_CLOSING}
)

_BREAK = r"(?:\r\n|[\n\r\v\f\x85\u2028\u2029])"
LINE = re.compile(_BREAK)
EMPTY_LINE = re.compile(_BREAK + r"(?:[^\S\n\r\v\f\x85\u2028\u2029]*" + _BREAK + ")+")

LABEL = re.compile(
    r"(?:"
    r"(?:điều|chương|mục|phần|tiểu mục|phụ lục|khoản|điểm|article|art|section|sec|chapter|chap|part|chapitre|titre|annexe|annex)\b\.?[^\S\n]*"
    r"(?:\d+[a-zđ]?|[ivxlc]+|\d+(?:\.\d+)+)\b[^\S\n]*[.:)]?(?:[^\S\n]+|$)"
    r"|\d{1,3}(?:\.\d{1,3})*[.)](?:[^\S\n]+|$)"
    r"|[a-zđ][.)](?:[^\S\n]+|$)"
    r"|[ivxlc]{1,6}[.)](?:[^\S\n]+|$)"
    r"|\((?:\d{1,3}|[a-zđ]|[ivxlc]{1,6})\)(?:[^\S\n]+|$)"
    r"|第\s?[0-9０-９一二三四五六七八九十百千〇零]+\s?[条條章節节款項项编編]\s*"
    r"|(?:ข้อ|มาตรา|หมวด)\s?[0-9๐-๙]+\s*"
    r"|(?:មាត្រា|ជំពូក|ប្រការ)\s?[0-9០-៩]+\s*[.៖។]?\s*"
    r"|[-*•–—+][^\S\n]+"
    r")",
    re.IGNORECASE,
)

OPENERS = {"“": "”", "«": "»", "‹": "›", "「": "」", "『": "』", "‘": "’", "„": "“", "(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "【": "】", "《": "》", "〈": "〉"}
CLOSERS = {c: o for o, c in OPENERS.items() if c != "“"}
QUOTES = set('“”«»‹›「」『』‘’„"')
AFTER = set('"”»›」』’)]}）］】》〉')
MARKS = re.compile('[“”«»‹›「」『』‘’„"()\\[\\]{}（）［］【】《》〈〉]')
_TERMS = r"[.!?…]+|[。！？｡．]+|[។៕]+|[।॥]+|[؟۔]+|[။]+"
EVENT = re.compile(_TERMS)
EVENT_THAI = re.compile(_TERMS + r"|\s+")
THAI = re.compile("[฀-๿]")
INNER_END = set(".!?…。！？｡។៕।॥؟။")
WIDE_END = set("。！？｡．។៕।॥؟۔။")


def _is_thai(ch: str) -> bool:
    return "฀" <= ch <= "๿"


def _pairs(s: str, a: int, b: int) -> list[tuple[int, int]]:
    """Outermost matched quotations and brackets of ``s[a:b]`` as (opener, closer) positions."""
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}  # how many of each opener are on the stack; a closer without one is passed over
    found: list[tuple[int, int]] = []
    for m in MARKS.finditer(s, a, b):
        ch, at = m.group(), m.start()
        if ch == '"':
            want = ch
        elif ch in OPENERS and not (ch == "“" and stack and stack[-1][0] == "„"):
            want = ""
        else:
            want = "„" if ch == "“" else CLOSERS[ch]
        if not want or (want == ch and not opened.get(ch)):
            stack.append((ch, at))
            opened[ch] = opened.get(ch, 0) + 1
        elif opened.get(want):
            top = ""
            while top != want:
                top, start = stack.pop()
                opened[top] -= 1
            found.append((start, at))
    found.sort()
    outer: list[tuple[int, int]] = []
    for p in found:
        if not outer or p[0] > outer[-1][1]:
            outer.append(p)
    return outer


def _back(s: str, i: int, a: int, stop) -> int:
    """Start of the run before ``i`` (not before ``a``) of characters that ``stop`` does not hold for.

    Runs of one kind that end at different events do not overlap, so a paragraph is read once.
    """
    while i > a and not stop(s[i - 1]):
        i -= 1
    return i


def _abbreviation(s: str, i: int, a: int) -> int:
    """Kind of the abbreviation that ends at ``i`` (where the full stop stands), 0 if none."""
    node, k, kind = TRIE, i, 0
    while k > a:
        node = node.get(s[k - 1].lower())
        if node is None:
            break
        k -= 1
        if "" in node and (k == a or not (s[k - 1].isalnum() or s[k - 1] in ".°")):
            kind = node[""]
    return kind


# Words that a Roman numeral follows.
ROMAN_HOSTS = frozenset("lục chương mục phần hạng loại cấp quý nhóm vùng khu part annex annexe chapter class grade book titre".split())
_ROMAN = re.compile(r"[IVXLC]+\b")


def _after_host(s: str, w: int, a: int) -> bool:
    """Whether the word before the token at ``w`` is one that a Roman numeral follows."""
    end = _back(s, w, a, lambda c: not c.isspace())
    return end < w and s[_back(s, end, a, lambda c: not c.isalpha()) : end].lower() in ROMAN_HOSTS


def _stop(s: str, i: int, j: int, a: int, b: int) -> bool:
    """Whether the terminators ``s[i:j]`` (outside quotations) end a sentence; ``s[a:b]`` is the paragraph."""
    if s[i] in WIDE_END:
        return True
    k = j
    while k < b and s[k].isspace():
        k += 1
    if k >= b:
        return True
    nxt, gap = s[k], k > j
    if nxt.islower() or nxt in ",;:)]}»”’、，；：）":
        return False
    if not gap and not nxt.isupper() and not nxt > "⺀":
        return False
    run = s[i:j]
    if run != ".":
        return True
    kind = _abbreviation(s, i, a)
    if not gap:
        if not (k + 1 < b and (s[k + 1].islower() or s[k + 1] in " ’'")) and nxt <= "⺀":
            return False
        if kind in (NAME, NUMBER):
            return False
        if kind == CLOSING:
            return True
        part = s[_back(s, i, a, lambda c: c.isspace() or c in ".-/") : i].lstrip("(\"'“«‘[")
        return len(part) >= 2 and not (part.isupper() and part.isalpha()) or part.isdigit()
    if kind == NAME:
        return False
    if kind == NUMBER:
        return not (nxt.isdigit() or _ROMAN.match(s, k, b))
    w = _back(s, i, a, str.isspace)
    token = s[w:i].lstrip("(\"'“«‘[")
    if kind == CLOSING:
        return not nxt.isdigit() or token.lower() not in ("co", "jr", "sr")
    if len(token) == 1 and token.isalpha() and token.isupper():
        return token in "IVXLC" and _after_host(s, w, a)
    if re.fullmatch(r"(?:\w\.)+\w", token) and token.upper() == token and not token[0].isdigit():
        return False
    return True


def _after_quote(s: str, q: int, b: int) -> bool:
    """Whether a sentence ends with the mark at ``q`` that closes a quotation ending in a terminator."""
    k = q + 1
    while k < b and s[k].isspace():
        k += 1
    if k >= b:
        return True
    nxt = s[k]
    if k == q + 1:
        return nxt.isupper() or ("㐀" <= nxt <= "鿿") or ("゠" <= nxt <= "ヿ") or ("ក" <= nxt <= "ឳ")
    return not nxt.islower() and nxt not in ".,;:!?…)]}»”、，；：" and not _is_thai(nxt)


def _paragraph(s: str, a: int, b: int, out: list[int]) -> None:
    """Append the sentence ends of the paragraph ``s[a:b]``, which neither starts nor ends blank."""
    start = a
    while (m := LABEL.match(s, start, b)) and m.end() > start:
        start = m.end()
    thai = THAI.search(s, start, b) is not None
    pairs = _pairs(s, start, b) if MARKS.search(s, start, b) else []
    events = [(m.start(), m.end()) for m in (EVENT_THAI if thai else EVENT).finditer(s, start, b)]
    for o, c in pairs:
        inner = c - 1
        while inner > o and s[inner].isspace():
            inner -= 1
        if s[inner] in INNER_END and inner > o:
            events.append((c, -1))
    if pairs and events:
        events.sort()
    p = 0
    for i, j in events:
        while p < len(pairs) and pairs[p][1] < i:
            p += 1
        inside = p < len(pairs) and pairs[p][0] < i < pairs[p][1]
        if inside:
            continue
        if j < 0:
            if _after_quote(s, i, b):
                end = i + 1
                while end < b and s[end] in AFTER and s[end] != '"':
                    end += 1
                if end < b:
                    out.append(end)
            continue
        if s[i].isspace():
            left, right = s[i - 1], s[j] if j < b else ""
            if not right or left.isdigit() or right.isdigit() or left in QUOTES or right in QUOTES:
                continue
            if s.startswith(("และ", "หรือ"), j) or not (_is_thai(left) or _is_thai(right)):
                continue
            if not out or out[-1] != i:
                out.append(i)
            continue
        if j >= b or not _stop(s, i, j, a, b):
            continue
        end = j
        while end < b and s[end] in AFTER and s[end] not in ('"',):
            end += 1
        if end < b:
            out.append(end)
    out.append(b)


def sentence_ends(text: str | None, wrapped: bool = False) -> list[int]:
    """End offsets of all sentences of ``text``.

    ``wrapped``: paragraphs are parted by empty lines and single line breaks are only
    line wraps; otherwise every line break ends a paragraph.
    """
    out: list[int] = []
    if not text:
        return out
    at, n = 0, len(text)
    while at <= n:
        m = (EMPTY_LINE if wrapped else LINE).search(text, at)
        a, b = at, m.start() if m else n
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            _paragraph(text, a, b, out)
        if not m:
            break
        at = m.end()
    return out


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _sentence_ends(text: pd.Series, wrapped: pd.Series) -> pd.Series:
    return pd.Series([sentence_ends(t, bool(w)) for t, w in zip(text, wrapped)])


#: Not deterministic to the optimizer, which then does not copy the call into a filter below ``explode``.
sentence_ends_udf = _sentence_ends.asNondeterministic()


def sentences(df: DataFrame, key: str, text: str, wrapped_if=None) -> DataFrame:
    """One row for each sentence: ``key`` and ``sent_end``.

    ``wrapped_if`` is a boolean column: true where single line breaks are only line wraps
    (null counts as false).
    """
    wrapped = F.coalesce(wrapped_if, F.lit(False)) if wrapped_if is not None else F.lit(False)
    rows = df.filter(F.col(text).isNotNull()).select(F.col(key), sentence_ends_udf(F.col(text), wrapped).alias("__ends"))
    return rows.select(key, F.explode("__ends").alias("sent_end"))
