"""Problem 3: variant spellings of names typed by people.

Method: character n-gram weighted vectors, a distributed sparse cosine join, a threshold and
average-linkage clustering. Every distinct spelling is first brought to a list of words (normalisation,
below). Each distinct word becomes a vector of its letters with one left out, its letters in full and its set of letters; a
sparse join gives the cosine of all pairs of words that share a term. Two names are as similar as their
words: equal words count 1, words with a cosine above the threshold between ``SOFT`` and 1, and every word
needs a counterpart in the same cyclic order. Links of at least ``LINK`` are clustered by average linkage.

Whether two like words are one word typed wrong or two words is told by the corpus: a word that stands in
two or more different names is established. Two established words differ (An and Anh, Lan and Loan), unless one is
``RARER`` times as rare; a rare word near an established one is its slip with a cosine of ``NEAR_KNOWN``; of
two rare words more is asked (``NEAR_RARE``, or ``NEAR_LONG`` if both have four letters). An exact check
follows: accents may be lost but must not contradict (Hùng and Hưng are two words, Hung is either), and a body of another level
is another body.

Scale: the word join runs over distinct words; a term of left-out letters belongs to at most as many words as
letters can be put into it, so joined rows grow with the number of words. Names meet by their
sorted words, with at most one word replaced on each side by a like one that is better known, so joined rows grow with the number of links.
Names that differ in more than two words are never alike. ``top_n`` keeps the most similar words only and is off by default; without it
the join is exact.

Normalisation: case, punctuation, blanks; courtesy and degree titles; a note in brackets; family name last or
after a comma; for bodies the acronym of their kind, and place, level and kind in another order. An
abbreviated word has the vector of its start and equals every word that starts so; an
abbreviation or a nickname (ordinal and given name) joins the one cluster it fits, and none if it fits several.

Defined results: null and blank names are none; one entity's spellings are pairs of different
strings, smaller first; names are counted over all rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.session import cut, release

#: Cosine of words: a rare one beside an established one; two rare ones; two rare ones of four letters or more.
NEAR_KNOWN, NEAR_RARE, NEAR_LONG = 0.1, 0.35, 0.12
#: How much rarer an established word must be to be another one's slip.
RARER = 3
#: What a like word counts at least, and the similarity that links names and keeps clusters together.
SOFT, LINK, LINKAGE = 0.5, 0.6, 0.6
#: Weight of a word's set of letters against that of each form with a letter left out.
SET_WEIGHT = 4 / 3

# Ordinals that make a nickname, administrative levels.
ORDINALS = frozenset("hai ba tu nam sau bay tam chin muoi ut ca".split())
LEVELS = {"tinh": "tinh", "huyen": "huyen", "thanh pho": "tp", "thi xa": "tx", "thi tran": "tt", "phuong": "phuong", "xa": "xa", "quan": "quan"}
LEVEL_LETTERS = {"t": "tinh", "h": "huyen", "x": "xa", "p": "phuong", "q": "quan", "tp": "tp", "tx": "tx", "tt": "tt"}

_BRACKETS = re.compile(r"\s*\([^()]*\)\s*$")
_TITLE = re.compile(r"^(?:(?:ông|bà|đ/c|đồng chí|thầy|cô)\s+|(?:[A-ZĐa-zđ]{1,4}\.)*(?:ths|ts|pgs|gs|bs|ks|ls|cn)\.\s*)+", re.IGNORECASE)


def fold(s: str) -> str:
    """Lower case without accents; runs of white space to one blank."""
    s = unicodedata.normalize("NFD", s.lower().replace("đ", "d"))
    return " ".join("".join(c for c in s if not unicodedata.combining(c)).split())


def marks(word: str) -> str:
    """The accents of a word in order of their code points, wherever they stand in it."""
    s = unicodedata.normalize("NFD", word.lower())
    return "".join(sorted(c for c in s if unicodedata.combining(c) or c == "đ"))


def agree(a: str, b: str) -> bool:
    """Whether the accents of one word are those of the other, or some of them were lost."""
    x, y = Counter(a), Counter(b)
    return not (x - y) or not (y - x)


def read_person(name: str) -> dict:
    """Words of a person's name in order, with their accents; an abbreviated word ends with a full stop."""
    s = unicodedata.normalize("NFC", name).strip()
    s = _BRACKETS.sub("", s)
    s = _TITLE.sub("", s)
    if s.count(",") == 1:
        given, rest = s.split(",")
        s = f"{rest} {given}"
    s = re.sub(r"\.(?=[^\s.])", ". ", s)
    raw = [w for w in re.sub(r"[^\w.\s]", " ", unicodedata.normalize("NFC", s.lower())).split() if w.strip(".")]
    raw = [w if re.fullmatch(r"\w{1,3}\.", w) else w.replace(".", "") for w in raw]
    words = [fold(w) for w in raw]
    shape = "full"
    if any(w.endswith(".") for w in words):
        shape = "abbr"
    elif len(words) == 2 and words[0] in ORDINALS:
        shape = "nick"
    return {"words": words, "accents": [marks(w) for w in raw], "shape": shape}


def _edit(a: str, b: str) -> bool:
    """Whether the words' vectors share a form with a letter left out or the set of letters, and they are of like length."""
    return a != b and abs(len(a) - len(b)) <= 1 and word_cosine(a, b) >= NEAR_KNOWN


def _level(words: list[str], first: int = 1) -> tuple[int, int, str] | None:
    """(start, end, level) of the level word, which stands before the place.

    The earliest one as written counts, then one typed wrong, then the words that folded words of
    a kind may read like; folded words of a place may read like a level as well, but come later.
    """
    spans = [(k, k + n, " ".join(words[k : k + n])) for k in range(first, len(words)) for n in (2, 1) if k + n < len(words) or not first and k + n <= len(words)]
    for test in (lambda w, v: w == v and v not in ("quan", "xa"), lambda w, v: len(v) >= 4 and v != "quan" and _edit(w, v), lambda w, v: w == v):
        for a, b, w in spans:
            for v, level in LEVELS.items():
                if v.count(" ") == w.count(" ") and test(w, v):
                    return a, b, level
    return None


def read_body(name: str) -> dict:
    """Acronym of the kind, level and words of the place of an issuing body; the words of the name where there is no level."""
    s = unicodedata.normalize("NFC", name).strip()
    m = re.fullmatch(r"(.+?)\s*\(([^()]+)\)\s*", s)
    if m:
        s = f"{m[2]} {m[1]}"
    else:
        m = re.fullmatch(r"(.+?)\s+[-–—]\s+(.+)", s)
        if m and _level(fold(m[1]).split()[:2], 0):
            s = f"{m[2]} {m[1]}"
    s = re.sub(r"(?<=[^\W\d_])\.(?=[^\W\d_]\.)", "", s)  # U.B.N.D. to UBND.
    raw = [w for w in re.sub(r"[^\w.\s]", " ", s.lower()).split() if w.strip(".")]
    written, words, found = [w.strip(".") for w in raw], [], None
    words = [fold(w) for w in written]
    for k, w in enumerate(raw):
        if k and w.endswith(".") and words[k] in LEVEL_LETTERS and k + 1 < len(raw):
            found = (k, k + 1, LEVEL_LETTERS[words[k]])
            break
    found = found or _level(words)
    if not found or not words:
        return {"words": words, "accents": [marks(w) for w in written], "shape": "full"}
    a, b, level = found
    kind = words[:a]
    acronym = kind[0] if len(kind) == 1 else "".join(w[0] for w in kind)
    return {"words": [f"={level}", f"={acronym}", *words[b:]], "accents": ["", "", *(marks(w) for w in written[b:])], "shape": "full"}


def word_terms(word: str) -> dict[str, float]:
    """Weighted terms of a word: itself, its forms with one letter left out, its set of letters."""
    w = word.lstrip("=")
    out = {f"s:{''.join(sorted(set(w)))}": SET_WEIGHT, f"d:{w}": 1.0}
    if len(w) >= 3:
        out |= {f"d:{w[:k]}{w[k + 1 :]}": 1.0 for k in range(len(w))}
    return out


def _dot(a: dict[str, float], b: dict[str, float]) -> float:
    return sum(v * b.get(k, 0.0) for k, v in a.items())


@lru_cache(maxsize=100_000)
def word_cosine(a: str, b: str) -> float:
    x, y = word_terms(a), word_terms(b)
    return _dot(x, y) / (_dot(x, x) * _dot(y, y)) ** 0.5


def likeness(a: str, known_a: int, b: str, known_b: int) -> float:
    """What two words count for each other; ``known`` is in how many different names a word stands."""
    if a == b:
        return 1.0
    rare, known = min(known_a, known_b), max(known_a, known_b)
    if a.startswith("=") != b.startswith("=") or (rare > 1 and rare * RARER > known):
        return 0.0
    cosine = word_cosine(a, b)
    near = cosine >= NEAR_KNOWN if known > 1 else cosine >= NEAR_RARE or (cosine >= NEAR_LONG and min(len(a), len(b)) >= 4)
    return SOFT + (1 - SOFT) * cosine if near else 0.0


def name_similarity(x: list[str], accents_x: list[str], known_x: list[int], y: list[str], accents_y: list[str], known_y: list[int], turn: bool) -> float:
    """Mean likeness of the words in the same order, with ``turn`` in the best cyclic order; 0 if a word has no counterpart."""
    n, best = len(x), 0.0
    if n != len(y) or (x and x[0].startswith("=") and x[0] != y[0]):
        return 0.0
    for r in range(n if turn else 1):
        total = 0.0
        for i in range(n):
            j = (i + r) % n
            like = likeness(x[i], known_x[i], y[j], known_y[j])
            if not like or (x[i] == y[j] and not agree(accents_x[i], accents_y[j])):
                break
            total += like
        else:
            best = max(best, total / n)
    return best


_READ = T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("accents", T.ArrayType(T.StringType())), T.StructField("shape", T.StringType())])
_TERMS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("w", T.DoubleType())]))


def _reader(body: bool):
    read = read_body if body else read_person

    @F.pandas_udf(_READ)
    def run(name: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(n) for n in name], columns=[f.name for f in _READ])

    return run


@F.pandas_udf(_TERMS)
def _terms(word: pd.Series) -> pd.Series:
    out = []
    for w in word:
        terms = word_terms(w)
        norm = _dot(terms, terms) ** 0.5
        out.append([{"term": t, "w": v / norm} for t, v in terms.items()])
    return pd.Series(out)


def cosine_pairs(words: DataFrame, threshold: float = NEAR_KNOWN, top_n: int | None = None) -> DataFrame:
    """``a, b, cosine`` for every pair of words (column ``word``, distinct) with at least ``threshold``; exact.

    The product of the sparse vectors is summed in the JVM with map-side combine. With ``top_n`` a pair stays if it is among
    the best of one of its words, equal ones by name.
    """
    terms = cut(words.select("word", F.explode(_terms("word")).alias("t")).select("word", "t.term", "t.w"))
    left = terms.select(F.col("word").alias("a"), "term", F.col("w").alias("wa"))
    right = terms.select(F.col("word").alias("b"), "term", F.col("w").alias("wb"))
    scored = left.join(right, "term").filter(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("cosine")).filter(F.col("cosine") >= threshold)
    if top_n is None:
        return scored
    sides = scored.unionByName(scored.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    best = sides.withColumn("r", F.row_number().over(W.partitionBy("a").orderBy(F.desc("cosine"), "b"))).filter(F.col("r") <= top_n)
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine").distinct()


def _similarity(turn: bool):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
        cols = ("words", "accents", "known")
        return pd.Series([name_similarity(*(list(v) for v in row), turn) for row in zip(*(a[c] for c in cols), *(b[c] for c in cols))], dtype="float64")

    return run


def components(links: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, comp``: the smallest key that can be reached over ``links`` (``a, b``).

    Smallest labels spread over the links and are then looked up in themselves, so chains
    halve in each round; every round is written to the shared folder.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = written = cut(keys.select("key", F.col("key").alias("comp")))
    while True:
        seen = both.join(label, both["b"] == label["key"]).groupBy("a").agg(F.min("comp").alias("near"))
        step = label.join(seen, label["key"] == seen["a"], "left").select("key", "comp", F.least("comp", F.coalesce("near", "comp")).alias("new"))
        jump = step.select(F.col("key").alias("k2"), F.col("new").alias("c2"))
        before, step = written, cut(step.join(jump, step["new"] == jump["k2"], "left").select("key", "comp", F.least("new", F.coalesce("c2", "new")).alias("new")))
        release(before)
        label, written = step.select("key", F.col("new").alias("comp")), step
        if not step.filter(F.col("new") != F.col("comp")).take(1):
            release(both)
            return label


def average_linkage(names: list[str], weight: list[float], sims: dict[tuple[int, int], float], least: float = LINKAGE) -> list[int]:
    """Cluster number of each name: the two clusters with the highest mean similarity merge while it reaches ``least``.

    Members weigh as many rows as have their name. Only linked clusters are looked at, through a heap whose
    outdated entries are passed over, so the work follows the number of links.
    """
    n = len(names)
    total = dict(enumerate(weight))
    near: dict[int, dict[int, float]] = {k: {} for k in range(n)}
    for (i, j), s in sims.items():
        near[i][j] = near[j][i] = s * weight[i] * weight[j]
    heap = [(-s / (total[i] * total[j]), i, j) for i in near for j, s in near[i].items() if i < j]
    heapq.heapify(heap)
    into = list(range(n))
    while heap:
        mean, i, j = heapq.heappop(heap)
        if -mean < least:
            break
        if i not in total or j not in total or j not in near[i] or -near[i][j] / (total[i] * total[j]) != mean:
            continue
        for k, s in near.pop(j).items():
            near[k].pop(j, None)
            if k != i:
                near[i][k] = near[k][i] = near[i].get(k, 0.0) + s
        total[i] += total.pop(j)
        into[j] = i
        for k, s in near[i].items():
            a, b = min(i, k), max(i, k)
            heapq.heappush(heap, (-s / (total[a] * total[b]), a, b))
    where = []
    for k in range(n):
        while into[k] != k:
            k = into[k]
        where.append(k)
    return where


def _cluster(pdf: pd.DataFrame) -> pd.DataFrame:
    """One component: rows of keys (``b`` null) and rows of links."""
    own = pdf[pdf["b"].isna()].sort_values("a")
    names = own["a"].tolist()
    at = {k: i for i, k in enumerate(names)}
    sims = {(at[a], at[b]): s for a, b, s in zip(pdf["a"], pdf["b"], pdf["sim"]) if b is not None and b == b}
    where = average_linkage(names, np.maximum(own["n"].to_numpy(dtype=float), 1).tolist(), sims)
    return pd.DataFrame({"key": names, "cluster": [names[w] for w in where]})


def known_words(keys: DataFrame) -> DataFrame:
    """``word, known``: in how many different names each word stands; the order of the other words and their accents do not count."""
    rows = keys.select("words", F.posexplode("words").alias("pos", "word"))
    others = F.array_sort(F.filter(F.col("words"), lambda w, i: i != F.col("pos")))
    return rows.select("word", F.xxhash64(F.array_join(others, " ")).alias("others")).groupBy("word").agg(F.count_distinct("others").alias("known"))


def alike(keys: DataFrame, turn: bool, top_n: int | None = None) -> DataFrame:
    """``a, b, sim`` for all pairs of keys (``key, words, accents``) with a similarity above 0.

    Keys meet by their sorted words. A word is replaced by each like word that is known at least as well, one word at a
    time, so two names that differ in two words meet in the name between.
    """
    known = cut(known_words(keys))
    like = cosine_pairs(known.select("word"), top_n=top_n)
    like = like.join(known.select(F.col("word").alias("a"), F.col("known").alias("ka")), "a").join(known.select(F.col("word").alias("b"), F.col("known").alias("kb")), "b")
    both = like.select("a", "b", "ka", "kb").unionByName(like.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("kb").alias("ka"), F.col("ka").alias("kb")))
    into = both.filter((F.col("ka") <= F.col("kb")) & ((F.col("ka") == 1) | (F.col("ka") * RARER <= F.col("kb")))).select(F.col("a").alias("word"), F.col("b").alias("into"))
    placed = keys.select("key", "words", F.posexplode("words").alias("pos", "word"))
    token = lambda c: F.array_join(F.array_sort(c), " ")
    swapped = placed.join(into, "word").select("key", token(F.transform("words", lambda w, i: F.when(i == F.col("pos"), F.col("into")).otherwise(w))).alias("token"))
    tokens = cut(keys.select("key", token(F.col("words")).alias("token")).unionByName(swapped).distinct())
    pairs = tokens.withColumnRenamed("key", "a").join(tokens.withColumnRenamed("key", "b"), "token").filter(F.col("a") < F.col("b")).select("a", "b").distinct()
    counted = placed.join(known, "word").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "known"))).alias("k"))
    rows = keys.join(counted, "key").select("key", F.struct("words", "accents", F.transform("k", lambda x: x["known"].cast("long")).alias("known")).alias("v"))
    rows = cut(rows)
    joined = pairs.join(rows.select(F.col("key").alias("a"), F.col("v").alias("va")), "a").join(rows.select(F.col("key").alias("b"), F.col("v").alias("vb")), "b")
    return joined.select("a", "b", _similarity(turn)("va", "vb").alias("sim")).filter(F.col("sim") > 0)


def _given() -> Column:
    return F.element_at("words", -1)


@F.pandas_udf(T.BooleanType())
def _fits(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
    """Whether abbreviated names (first) fit full ones: each word starts like its counterpart, accents of whole words agree.

    Names of three words may leave out middle ones.
    """

    def one(x, ax, y, ay) -> bool:
        if len(x) == 3 and len(y) > 3 and x[1].endswith(".") and not x[0].endswith("."):
            y, ay = [y[0], y[1], y[-1]], [ay[0], ay[1], ay[-1]]
        return len(x) == len(y) and all(q.startswith(p[:-1]) if p.endswith(".") else p == q and agree(u, v) for p, u, q, v in zip(x, ax, y, ay))

    return pd.Series([one(list(x), list(ax), list(y), list(ay)) for x, ax, y, ay in zip(a["words"], a["accents"], b["words"], b["accents"])], dtype=bool)


def _short_names(short: DataFrame, clusters: DataFrame) -> DataFrame:
    """``key, target``: the cluster of each abbreviation or nickname that fits members of one cluster only.

    Abbreviations meet full names by given name and initials. Nicknames meet given names, of which each has its first and
    last cluster counted before, so a frequent given name costs one row.
    """
    initials = lambda c: F.array_join(F.transform(c, lambda w: F.substring(w, 1, 1)), "")
    full = clusters.filter(F.size("words") >= 2)
    value = F.struct("words", "accents")
    whole = full.select(_given().alias("given"), initials(F.col("words")).alias("initials"), value.alias("v"), "cluster")
    left_out = F.array(F.get("words", F.lit(0)), F.get("words", F.lit(1)), _given())
    less = full.filter(F.size("words") > 3).select(_given().alias("given"), initials(left_out).alias("initials"), value.alias("v"), "cluster")
    abbr = short.filter(F.col("shape") == "abbr").select("key", _given().alias("given"), initials(F.col("words")).alias("initials"), value.alias("s"))
    fits = abbr.join(whole.unionByName(less), ["given", "initials"]).filter(_fits("s", "v")).select("key", F.col("cluster").alias("lo"), F.col("cluster").alias("hi"))
    long = full.filter(F.size("words") >= 3).groupBy(_given().alias("given"), F.element_at("accents", -1).alias("accent")).agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi"))
    nick = short.filter(F.col("shape") == "nick").select("key", _given().alias("given"), F.element_at("accents", -1).alias("own"))
    called = nick.join(long, "given").filter(_agree("own", "accent")).select("key", "lo", "hi")
    one = fits.unionByName(called).groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return one.filter(F.col("lo") == F.col("hi")).select("key", F.col("lo").alias("target"))


@F.pandas_udf(T.BooleanType())
def _agree(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([agree(x, y) for x, y in zip(a, b)], dtype=bool)


def entities(rows: DataFrame, body: bool, top_n: int | None = None) -> DataFrame:
    """``name, n, entity`` for every distinct name (column ``name``): spellings of one entity share ``entity``."""
    names = rows.filter(F.col("name").isNotNull() & (F.length(F.regexp_replace("name", r"(?U)\s+", "")) > 0))
    names = names.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    read = names.select("name", "n", _reader(body)("name").alias("r")).select("name", "n", "r.*")
    # A key is the words with their accents; what has no word is a key of its own.
    key = F.array_join(F.transform(F.arrays_zip("words", "accents"), lambda x: F.concat_ws("~", x["words"], x["accents"])), " ")
    read = cut(read.withColumn("key", key))
    keys = read.filter(F.size("words") > 0).groupBy("key").agg(F.first("words").alias("words"), F.first("accents").alias("accents"), F.first("shape").alias("shape"), F.sum("n").alias("n"))
    keys = cut(keys)
    full = keys.filter(F.col("shape") == "full")
    sims = cut(alike(full.select("key", "words", "accents"), not body, top_n))
    strong = sims.filter(F.col("sim") >= LINK)
    comp = components(strong, full.select("key"))
    inside = sims.join(comp.select(F.col("key").alias("a"), "comp"), "a").join(comp.select(F.col("key").alias("b"), F.col("comp").alias("cb")), "b").filter(F.col("comp") == F.col("cb"))
    inside = inside.select("comp", "a", "b", "sim", F.lit(0).cast("bigint").alias("n"))
    own = full.join(comp, "key").select("comp", F.col("key").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(0.0).alias("sim"), "n")
    linked = strong.join(comp, strong["a"] == comp["key"]).select("comp").distinct()
    # A component of one key needs no clustering.
    lone = own.join(linked, "comp", "left_anti").select(F.col("a").alias("key"), F.col("a").alias("cluster"))
    grouped = own.unionByName(inside).join(linked, "comp", "left_semi")
    clusters = lone.unionByName(grouped.groupBy("comp").applyInPandas(lambda pdf: _cluster(pdf), "key string, cluster string"))
    clusters = cut(clusters.join(full.select("key", "words", "accents"), "key"))
    short = keys.filter(F.col("shape") != "full")
    targets = _short_names(short, clusters) if not body else short.select("key", F.lit(None).cast("string").alias("target")).limit(0)
    final = clusters.select("key", F.col("cluster").alias("entity")).unionByName(short.join(targets, "key", "left").select("key", F.coalesce("target", "key").alias("entity")))
    return read.join(final, "key", "left").select("name", "n", F.coalesce("entity", F.concat(F.lit("?"), "name")).alias("entity"))


def entity_pairs(named: DataFrame) -> DataFrame:
    """``name_a, name_b``: pairs of different spellings of one entity, smaller string first."""
    left = named.select("entity", F.col("name").alias("name_a"))
    right = named.select("entity", F.col("name").alias("name_b"))
    return left.join(right, "entity").filter(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")
