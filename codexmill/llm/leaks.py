"""Problem 8: evaluation passages inside a training corpus.

Method: word n-grams of the test items are the seeds; they join training documents to
items, and a Smith-Waterman alignment scores each pair, so partial and edited copies are
found as well as whole ones.

Every window of ``SEED_RUN`` words of an item gives its rarest n-grams (by occurrences over the
whole corpus, of those that occur at all) as seeds. A document that holds that many consecutive
words of an item holds the rarest of one of its windows: of longer runs nothing is missed. An edit
can leave a copy without the rarest n-gram of a window, so for edited copies each window gives ``EDITED_SEEDS`` of them; what
frequent phrases alone have in common with an item is not aligned.

Defined results
* Words are maximal runs of letters and digits in lower case; everything between is ignored.
* Null or empty texts and items hold nothing. Items shorter than the n-gram have no seed and
  are not found. Repeated documents are each reported; repeated items as well.
* Items are broadcast only while they are fewer than ``max_broadcast`` n-grams; beyond that the
  seeds join by shuffle. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.session import cut

N_GRAM = 5
RUN = 20
SEED_RUN = 10
MAX_BROADCAST = 500_000
#: Seeds of each window where edited copies are looked for.
EDITED_SEEDS = 3

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def words(c: Column) -> Column:
    """Words of a text as an array, in the JVM; null and empty give an empty array."""
    parts = F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def gram_hashes(c: Column, n: int = N_GRAM) -> tuple[Column, Column]:
    """Hashes of the words, to be named ``__h``, and of all word n-grams in order; the i-th belongs to the words from i."""
    hashed = F.transform(words(c), lambda w: F.xxhash64(w))
    last = F.size("__h") - n
    grams = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get("__h", i + k) for k in range(n)]))).otherwise(F.array().cast("array<bigint>"))
    return hashed, grams


def _grams(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """``key, pos, gram``, one row for each n-gram."""
    hashed, grams = gram_hashes(F.col(text), n)
    rows = df.filter(F.col(text).isNotNull()).select(F.col(key), hashed.alias("__h"))
    return rows.select(key, F.posexplode(grams).alias("pos", "gram"))


def align(doc: list[str], item: list[str], match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[int, int]:
    """Smith-Waterman score of the best local alignment, and the longest run of equal words."""
    if not doc or not item:
        return 0, 0
    ids: dict[str, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in item], dtype=np.int32)
    b = np.array([ids.get(w, -1) for w in doc], dtype=np.int32)
    before = np.zeros(len(b) + 1, dtype=np.int32)
    runs = np.zeros(len(b) + 1, dtype=np.int32)
    slope = gap * np.arange(len(b) + 1, dtype=np.int32)
    best = longest = 0
    for w in a:
        same = b == w
        row = np.zeros(len(b) + 1, dtype=np.int32)
        row[1:] = np.maximum(before[:-1] + np.where(same, match, mismatch), before[1:] + gap)
        np.maximum(row, 0, out=row)
        row = np.maximum(row, np.maximum.accumulate(row - slope) + slope)
        best = max(best, int(row.max()))
        before = row
        now = np.zeros(len(b) + 1, dtype=np.int32)
        now[1:] = np.where(same, runs[:-1] + 1, 0)
        longest = max(longest, int(now.max()))
        runs = now
    return best, longest


#: Elements of one table of the batched alignment, and the longest text it takes.
CELLS, LONGEST = 65_536, 4_096


def align_many(docs: list[np.ndarray], items: list[np.ndarray], match: int = 2, mismatch: int = -1, gap: int = -1) -> list[tuple[int, int]]:
    """``align`` of many pairs of word numbers at once; pairs of like sizes share a table, one column each."""
    out = [(0, 0)] * len(docs)
    pairs = [k for k in range(len(docs)) if len(docs[k]) and len(items[k])]
    for k in [k for k in pairs if max(len(docs[k]), len(items[k])) > LONGEST]:
        out[k] = align(docs[k].tolist(), items[k].tolist(), match, mismatch, gap)
    pairs = sorted((k for k in pairs if max(len(docs[k]), len(items[k])) <= LONGEST), key=lambda k: (len(docs[k]), len(items[k])))
    while pairs:
        width = max(1, CELLS // len(docs[pairs[-1]]))
        now, pairs = pairs[-width:], pairs[:-width]
        n, m = len(docs[now[-1]]), max(len(items[k]) for k in now)
        a, b = np.full((m, len(now)), -1, dtype=np.int32), np.full((n, len(now)), -2, dtype=np.int32)
        for c, k in enumerate(now):
            a[: len(items[k]), c] = items[k]
            b[: len(docs[k]), c] = docs[k]
        before, runs = (np.zeros((n + 1, len(now)), dtype=np.int16) for _ in range(2))
        slope = (gap * np.arange(n + 1)).astype(np.int16)[:, None]
        up, down, step = np.int16(match), np.int16(mismatch), np.int16(gap)
        best, longest = (np.zeros(len(now), dtype=np.int16) for _ in range(2))
        for w in a:
            same = b == w
            row = np.zeros_like(before)
            np.maximum(before[:-1] + np.where(same, up, down), before[1:] + step, out=row[1:])
            np.maximum(row, 0, out=row)
            np.maximum(row, np.maximum.accumulate(row - slope, axis=0) + slope, out=row)
            np.maximum(best, row.max(axis=0), out=best)
            before = row
            following = np.zeros_like(runs)
            np.multiply(runs[:-1] + np.int16(1), same, out=following[1:])
            np.maximum(longest, following.max(axis=0), out=longest)
            runs = following
        for c, k in enumerate(now):
            out[k] = int(best[c]), int(longest[c])
    return out


_ALIGNED = T.StructType([T.StructField("score", T.IntegerType()), T.StructField("longest_run", T.IntegerType()), T.StructField("n_words", T.IntegerType())])


@F.pandas_udf(_ALIGNED)
def align_udf(text: pd.Series, item: pd.Series, first: pd.Series, last: pd.Series) -> pd.DataFrame:
    number: dict[str, int] = {}
    of_item: dict[str, np.ndarray] = {}
    numbered = lambda t: np.array([number.setdefault(w, len(number)) for w in words_of(t)], dtype=np.int32)
    docs, items, seen, doc = [], [], None, None
    for t, i, a, b in zip(text, item, first, last):
        if t is not seen:
            doc, seen = numbered(t), t
        if i not in of_item:
            of_item[i] = numbered(i)
        docs.append(doc[max(0, a) : max(0, b)])
        items.append(of_item[i])
    out = [(*scores, len(w)) for scores, w in zip(align_many(docs, items), items)]
    return pd.DataFrame(out, columns=["score", "longest_run", "n_words"])


def _rarest(item_grams: DataFrame, hits: DataFrame, n: int, run: int, per_window: int) -> DataFrame:
    """``__item, gram, item_pos``: the rarest n-grams of each window of ``run`` words, of those that the corpus has."""
    counts = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # An n-gram that no document has leads nowhere, so it is no seed; its place still counts for the windows.
    ranked = item_grams.join(counts, "gram", "left").withColumn("rank", F.when(F.col("n").isNotNull(), F.struct("n", "pos", "gram")))
    ahead = W.partitionBy("__item").orderBy("pos").rowsBetween(0, run - n)
    every = W.partitionBy("__item")
    windows = ranked.select(
        "__item", "pos", F.slice(F.array_sort(F.collect_list("rank").over(ahead)), 1, per_window).alias("seeds"), F.count(F.lit(1)).over(ahead).alias("width"), F.max("pos").over(every).alias("last_pos")
    )
    # An item shorter than a window is one window.
    whole = (F.col("width") == run - n + 1) | ((F.col("last_pos") < run - n) & (F.col("pos") == 0))
    return windows.filter(whole).select("__item", F.explode("seeds").alias("s")).select("__item", "s.gram", F.col("s.pos").alias("item_pos")).distinct()


def leaks(
    corpus: DataFrame, doc_key: str, text: str, items: DataFrame, item_key: str, item_text: str, n: int = N_GRAM, run: int | None = None, per_window: int = 1, whole: bool = False, max_broadcast: int = MAX_BROADCAST
) -> DataFrame:
    """Document-item pairs that share a seed, with their alignment.

    ``doc_key, item_key, score, longest_run, n_words``. Every n-gram of an item is a seed; with ``run`` of each window of
    so many words only the ``per_window`` rarest n-grams that the corpus has, and one is enough for exact runs of that length. The alignment reads the words around
    the seeds: enough for exact runs, or with ``whole`` as far as any alignment through a seed can reach (each word
    of a gap costs half of what a match brings, so twice the item on both sides). One pass over the corpus makes the n-gram hits,
    which hold only n-grams of items and are written to the shared folder; they give the corpus counts,
    the seeds and the candidates. The second pass reads only the texts of candidates.
    """
    item_rows = items.select(F.col(item_key).alias("__item"), F.col(item_text).alias("__passage"))
    item_grams = cut(_grams(item_rows, "__item", "__passage", n))
    small = item_grams.count() <= max_broadcast
    hint = F.broadcast if small else (lambda df: df)
    docs = corpus.select(F.col(doc_key).alias("__doc"), F.col(text).alias("__text"))
    hits = cut(_grams(docs, "__doc", "__text", n).join(hint(item_grams.select("gram").distinct()), "gram"))
    seeds = item_grams.select("__item", "gram", F.col("pos").alias("item_pos")) if run is None else _rarest(item_grams, hits, n, run, per_window)
    near = hits.join(hint(seeds), "gram").groupBy("__doc", "__item").agg(F.min(F.col("pos") - F.col("item_pos")).alias("first"), F.max(F.col("pos") - F.col("item_pos")).alias("last"))
    sized = item_rows.withColumn("__size", F.size(words(F.col("__passage"))))
    pairs = near.join(hint(sized) if small else sized, "__item")
    slack = 2 * F.col("__size") if whole else F.lit(2 * SEED_RUN)
    aligned = docs.join(pairs, "__doc").select(
        "__doc", "__item", align_udf("__text", "__passage", (F.col("first") - slack).cast("int"), (F.col("last") + F.col("__size") + slack).cast("int")).alias("a")
    )
    return aligned.select(F.col("__doc").alias(doc_key), F.col("__item").alias(item_key), "a.score", "a.longest_run", "a.n_words")
