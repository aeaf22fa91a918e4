"""Problem 4: cutting oversized items into pieces at natural boundaries.

Method: agglomerative merging. A text starts as atomic segments; every pair of
neighbours sits in a heap keyed by the strength of the boundary between them; the
weakest boundary is merged first, while the combined size plus the overlap stays
within the limit.

Boundaries, weakest first: a cut inside a word, a blank, a clause mark, the end of a
sentence, a line break. Only texts with a segment that is too long between two natural
boundaries (line break, end of a sentence, start or end) get weaker ones, in that segment.

Defined results
* Pieces partition the text: ``text[start:end]`` in order gives the text again. A piece
  is ``text[start - overlap : end]`` and never longer than ``max_size``; the first piece has
  no overlap.
* A text within the limit is one piece; an empty text is one empty piece; null gives no row.
* A combining mark, zero-width joiner or variation selector stays with its base character.
* ``cut`` is ``forced`` if more than ``max_size`` characters lie between two neighbouring
  natural boundaries, ``natural`` otherwise; it is read from the boundaries that the heap left between the pieces.
* Equal boundaries are merged by combined size, then from the left, so results do not depend on
  partitioning. Other columns are ignored. ``overlap`` must be under ``max_size``.
"""

from __future__ import annotations

import heapq
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.llm.sentences import LINE, sentence_ends

CHARACTER, BLANK, CLAUSE, SENTENCE, BREAK = range(5)
_CLAUSE = re.compile(r"(?<=[;:,|、，；：)])\s+|(?<=[、，；：])")
_BLANK = re.compile(r"\s+")


def natural_segments(text: str) -> list[tuple[int, int, int]]:
    """(start, end, strength of the boundary at ``end``); blanks after a boundary belong to the segment before."""
    out: list[tuple[int, int, int]] = []
    start = 0
    for end in sentence_ends(text):
        stop = end
        while stop < len(text) and text[stop].isspace():
            stop += 1
        out.append((start, stop, BREAK if LINE.search(text, end, stop) else SENTENCE))
        start = stop
    if start < len(text) or not out:
        out.append((start, len(text), BREAK))
    return out


def _cuts(text: str, a: int, b: int, pattern: re.Pattern) -> list[int]:
    return [m.end() for m in pattern.finditer(text, a, b) if a < m.end() < b]


def _hard(text: str, a: int, b: int, room: int) -> list[int]:
    cuts, at = [], a
    while b - at > room:
        nxt = at + room
        while nxt > at + 1 and (unicodedata.combining(text[nxt]) or text[nxt] in "\u200c\u200d\ufe0f"):
            nxt -= 1
        cuts.append(nxt)
        at = nxt
    return cuts


def _atoms(text: str, a: int, b: int, strength: int, room: int, level: int = CLAUSE) -> list[tuple[int, int, int]]:
    """A segment as atoms within ``room``, cut at the strongest boundary that does."""
    if b - a <= room:
        return [(a, b, strength)]
    cuts = _cuts(text, a, b, _CLAUSE if level == CLAUSE else _BLANK) if level > CHARACTER else _hard(text, a, b, room)
    out: list[tuple[int, int, int]] = []
    edges = [a, *cuts, b]
    for k in range(len(edges) - 1):
        s = strength if k == len(edges) - 2 else level
        out += _atoms(text, edges[k], edges[k + 1], s, room, level - 1) if level > CHARACTER else [(edges[k], edges[k + 1], s)]
    return out


def merged_pieces(text: str, max_size: int, overlap: int) -> list[tuple[int, int, bool]]:
    """(start, end, forced) of the pieces of ``text``.

    ``forced``: the piece ends at a boundary that is weaker than a natural one, in a stretch between two
    neighbouring natural boundaries that no piece can hold.
    """
    if len(text) <= max_size:
        return [(0, len(text), False)]
    room = max_size - overlap
    atoms: list[tuple[int, int, int]] = []
    unbroken: list[bool] = []  # whether an atom lies in a stretch longer than a piece
    for a, b, s in natural_segments(text):
        parts = _atoms(text, a, b, s, room)
        atoms += parts
        unbroken += [len(parts) > 1 and len(text[a:b].strip()) > max_size] * len(parts)
    n = len(atoms)
    start, end = [x[0] for x in atoms], [x[1] for x in atoms]
    following, before, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
    heap = [(atoms[k][2], end[k + 1] - start[k], k, k + 1, end[k + 1]) for k in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        strength, _, k, j, stop = heapq.heappop(heap)
        if not alive[k] or following[k] != j or end[j] != stop:
            continue
        if stop - max(0, start[k] - overlap) > max_size:
            continue  # a neighbour only grows, so this pair never fits later
        end[k], alive[j], following[k] = stop, False, following[j]
        if following[k] >= 0:
            f = following[k]
            before[f] = k
            heapq.heappush(heap, (atoms[f - 1][2], end[f] - start[k], k, f, end[f]))
        if before[k] >= 0:
            p = before[k]
            heapq.heappush(heap, (atoms[k - 1][2], end[k] - start[p], p, k, end[k]))
    final = [k for k in range(n) if alive[k]]
    last = [k - 1 for k in final[1:]] + [n - 1]  # the last atom of each piece
    return [(start[k], end[k], unbroken[j] and atoms[j][2] < SENTENCE) for k, j in zip(final, last)]


def pieces(text: str, max_size: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of ``text``."""
    return [(a, b) for a, b, _ in merged_pieces(text, max_size, overlap)]


PIECE = T.ArrayType(T.StructType([T.StructField("start_at", T.IntegerType()), T.StructField("end_at", T.IntegerType())]))


def split_items(df: DataFrame, key: str, text: str, max_size: int, overlap: int, only_oversized: bool = False) -> DataFrame:
    """Pieces of every item: ``key, cut, piece_no, n_pieces, start_at, end_at, piece``.

    Narrow: no shuffle; each text is read once and its pieces are cut from it by the JVM.
    """
    if not 0 <= overlap < max_size:
        raise ValueError("overlap must be at least 0 and under max_size")
    result = T.StructType([T.StructField("forced", T.BooleanType()), T.StructField("p", PIECE)])

    @F.pandas_udf(result)
    def cut(texts: pd.Series) -> pd.DataFrame:
        done = [merged_pieces(t, max_size, overlap) for t in texts]
        spans = [[{"start_at": a, "end_at": b} for a, b, _ in d] for d in done]
        return pd.DataFrame({"forced": [any(f for _, _, f in d) for d in done], "p": spans})

    cut = cut.asNondeterministic()  # so that the optimizer does not run it a second time in a filter

    rows = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).filter(F.col("__text").isNotNull())
    if only_oversized:
        rows = rows.filter(F.length("__text") > max_size)
    rows = rows.select("*", cut("__text").alias("__cut"))
    rows = rows.select(
        "__key", "__text", F.when(F.col("__cut.forced"), "forced").otherwise("natural").alias("cut"), F.size("__cut.p").alias("n_pieces"), F.posexplode("__cut.p").alias("piece_no", "p")
    )
    first = F.greatest(F.lit(0), F.col("p.start_at") - overlap)
    return rows.select(
        F.col("__key").alias(key),
        "cut",
        "piece_no",
        "n_pieces",
        "p.start_at",
        "p.end_at",
        F.substring(F.col("__text"), first + 1, F.col("p.end_at") - first).alias("piece"),
    )
