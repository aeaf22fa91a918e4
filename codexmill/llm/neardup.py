"""Problem 1: near-duplicate records with small edits.

Method: BK-trees. Each distinct text gets a sketch, an integer whose Hamming distance to
another sketch falls with the similarity of the texts. Sketches are sharded by MinHash
bands; every shard is a BK-tree whose children are keyed by their integer distance to
the parent, and a search follows only edges within the radius. Pairs within the radius
are compared exactly.

A broadcast of the shard trees would grow with the data, so rows travel to the shards
instead: a text is sent to the shards of its bands only, and a shard with many texts
is cut into blocks of bounded size that are searched against each other. Shards that hold a large share of
all texts are found beforehand on a fixed part of the texts (which steers the exchange alone, no result) and cut into
blocks before they travel, so no task ever gathers one.

What the tree prunes: by the triangle inequality a subtree is passed over when its edge is further from the query's
distance than the radius. At the threshold of 0.7 the radius is 90 of 384 bits and texts without relation lie
about 170 apart, so of a foreign family only its first text is visited, and from a text's own family no
foreign one: the visited share of a shard is about its number of families over its number of texts. Texts that only share a passage are
one family each; among them no radius that keeps pairs of 0.7 lets a metric tree prune (distances of short segments
spread too little against it), and the bands do the work.

The similarity of two texts is the number of distinct 5-character substrings that both
have, divided by the number that either has, after lower-casing, trimming and making
each run of white space one space.

Recall: with 64 bands of 6 values a pair at similarity 0.70 shares a band with probability
0.9997, at 0.75 with 1 - 4e-6; the radius lies 4.5 standard deviations above the mean
distance at the threshold. Precision is exact.

Defined results
* Null texts and texts under 5 characters have no substrings and no partners.
* Exact copies (after normalisation) form a class; each task signs a class once, and classes are compared once. Rows with a null key are left out.
* ``near_pairs`` links classes; ``members`` maps keys to classes. A class with a third of all rows
  costs at most one sketch a task.
* Long texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.operators.skew import heavy_keys, salted_join
from codexmill.session import cut

SHINGLE = 5
BANDS, ROWS = 64, 6
BITS = BANDS * ROWS
BLOCK = 512
#: Bits between two edges of a tree.
STEP = 32
#: A shard counts as large with more than this share of the texts; it is looked for among one text in ``PROBE``.
LARGE, PROBE = 1 / 64, 64

_MIX = np.random.default_rng(20240607)
_A = _MIX.integers(0, 2**31, BITS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _MIX.integers(0, 2**32, BITS, dtype=np.uint32)
_POLY = _MIX.integers(0, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_BAND = _MIX.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_CHUNK = 2048


def normal(c: Column) -> Column:
    """Lower case, trimmed, runs of white space as one space."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def shingle_hashes(text: str) -> np.ndarray:
    """Distinct 32-bit hashes of the 5-character substrings."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(points) - SHINGLE + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint32)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(SHINGLE):
        h += points[k : k + n] * _POLY[k]
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return np.unique((h >> np.uint64(32)).astype(np.uint32))


def signature(text: str) -> tuple[np.ndarray, bytes] | None:
    """Band keys and sketch of a text."""
    u = shingle_hashes(text)
    if not len(u):
        return None
    low = np.full(BITS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(u), _CHUNK):
        part = u[at : at + _CHUNK]
        np.minimum(low, (_A[:, None] * part[None, :] + _B[:, None]).min(axis=1), out=low)
    keys = (low.reshape(BANDS, ROWS).astype(np.uint64) * _BAND).sum(axis=1, dtype=np.uint64)
    keys ^= keys >> np.uint64(29)
    keys = keys * np.uint64(0xBF58476D1CE4E5B9) + np.arange(BANDS, dtype=np.uint64)
    bits = (low * np.uint32(0x9E3779B1)) >> np.uint32(31)
    return keys.view(np.int64), np.packbits(bits.astype(np.uint8)).tobytes()


SIGNED = "cid bigint, field string, norm string, bands array<bigint>, sketch binary"


def _sign(batches):
    """Band keys and sketch of each class, once in a task; the set of what is done is bounded by the task's rows."""
    done: set[int] = set()
    for batch in batches:
        rows = [i for i, c in enumerate(batch.column("cid").to_pylist()) if not (c in done or done.add(c))]
        part = batch.take(pa.array(rows, type=pa.int64()))
        signed = [signature(t) for t in part.column("norm").to_pylist()]
        bands = np.concatenate([k for k, _ in signed]) if signed else np.empty(0, dtype=np.int64)
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * BANDS)
        columns = [part.column(c) for c in ("cid", "field", "norm")]
        columns += [pa.ListArray.from_arrays(offsets, pa.array(bands)), pa.array([x for _, x in signed], type=pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["cid", "field", "norm", "bands", "sketch"])


def radius(threshold: float, bits: int = BITS, deviations: float = 4.5) -> int:
    """Hamming radius that holds pairs at the threshold: a bit differs with probability (1 - s) / 2."""
    p = (1 - threshold) / 2
    return math.ceil(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


class BKTree:
    """Children of a node are keyed by their integer Hamming distance to it, in steps that keep near copies together.

    With steps of one bit the copies of a family, whose distances to a foreign node differ by a few bits, would hang
    below as many children, and a search would have to look into each.
    """

    __slots__ = ("root", "visited")

    def __init__(self) -> None:
        self.root = None
        self.visited = 0  # nodes that searches have looked at

    def add(self, sketch: int, item) -> None:
        if self.root is None:
            self.root = (sketch, [item], {})
            return
        node = self.root
        while True:
            d = (node[0] ^ sketch).bit_count()
            if d == 0:
                node[1].append(item)
                return
            child = node[2].get(d // STEP)
            if child is None:
                node[2][d // STEP] = (sketch, [item], {})
                return
            node = child

    def within(self, sketch: int, r: int) -> list:
        found, stack = [], [self.root] if self.root else []
        while stack:
            s, items, children = stack.pop()
            self.visited += 1
            d = (s ^ sketch).bit_count()
            if d <= r:
                found += items
            for edge, child in children.items():
                if edge * STEP <= d + r and (edge + 1) * STEP > d - r:
                    stack.append(child)
        return found


def _search(r: int):
    """Search of sorted shard rows; a shard may go on over batches, its size is bounded."""

    def run(batches):
        at, tree, held, out_a, out_b = None, None, set(), [], []
        for pdf in batches:
            for bucket, bi, bj, blk, cid, sketch in zip(pdf["bucket"].tolist(), pdf["bi"].tolist(), pdf["bj"].tolist(), pdf["blk"].tolist(), pdf["cid"].tolist(), pdf["sketch"].tolist()):
                if at != (bucket, bi, bj):
                    at, tree, held = (bucket, bi, bj), BKTree(), set()
                if (cid, blk) in held:
                    continue
                held.add((cid, blk))
                s = int.from_bytes(sketch, "big")
                if bi == bj or blk == bj:
                    for other in tree.within(s, r):
                        if other != cid:
                            out_a.append(min(cid, other))
                            out_b.append(max(cid, other))
                if bi == bj or blk == bi:
                    tree.add(s, cid)
            # A pair meets in many shards; what a batch has once need not travel twice.
            yield pd.DataFrame({"a": out_a, "b": out_b}, dtype="int64").drop_duplicates()
            out_a, out_b = [], []

    return run


@F.pandas_udf(T.StructType([T.StructField("both", T.IntegerType()), T.StructField("either", T.IntegerType())]))
def overlap_udf(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    out, seen, left = [], None, set()
    for x, y in zip(a, b):
        if x is not seen and x != seen:
            seen, left = x, {x[k : k + SHINGLE] for k in range(len(x) - SHINGLE + 1)}
        right = {y[k : k + SHINGLE] for k in range(len(y) - SHINGLE + 1)}
        both = len(left & right)
        out.append((both, len(left) + len(right) - both))
    return pd.DataFrame(out, columns=["both", "either"])


def texts_with_class(rows: DataFrame) -> DataFrame:
    """Rows ``field, key, text`` with ``norm``, the class id ``cid`` and its check value."""
    rows = rows.filter(F.col("text").isNotNull() & F.col("key").isNotNull()).select("field", "key", normal(F.col("text")).alias("norm"))
    rows = rows.filter(F.length("norm") >= SHINGLE)
    return rows.select("field", "key", "norm", F.xxhash64("field", "norm").alias("cid"), F.hash("norm", "field").alias("chk"))


def _large(bands: DataFrame, n_probe: int, probe: int, share: float) -> DataFrame | None:
    """``bucket, n`` of the large shards, at most ``BANDS / share`` of them, so few that they may be broadcast; None if there are none."""
    if n_probe * share < 1:
        return None
    some = bands.filter(F.pmod("cid", F.lit(probe)) == 0).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    found = cut(some.filter(F.col("n") > F.lit(n_probe * share)).select("bucket"))
    if not found.take(1):
        return None
    return cut(bands.join(F.broadcast(found), "bucket").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))


_PACKED = np.dtype([("bucket", np.uint8, 6), ("cid", "<i8")])


def _pack(homes: int, without: list[int]):
    """Band entries of a batch, gathered by the place they travel to: 14 bytes each, of the key its lower 48 bits.

    A row for each entry would cost more than twice that. Keys that meet by their lower bits alone are told apart by the search.
    """
    large = np.array(sorted(without), dtype=np.int64)

    def run(batches):
        for batch in batches:
            keys = batch.column("bands").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            cid = np.repeat(batch.column("cid").to_numpy(zero_copy_only=False).astype(np.int64), BANDS)
            if len(large):
                stays = ~np.isin(keys, large)
                keys, cid = keys[stays], cid[stays]
            home = ((keys.view(np.uint64) & np.uint64((1 << 48) - 1)) % np.uint64(homes)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            entries = np.empty(len(keys), dtype=_PACKED)
            entries["bucket"] = keys[order].astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6]
            entries["cid"] = cid[order]
            edges = np.searchsorted(home[order], np.arange(homes + 1))
            used = [h for h in range(homes) if edges[h] < edges[h + 1]]
            blobs = [entries[edges[h] : edges[h + 1]].tobytes() for h in used]
            yield pa.RecordBatch.from_arrays([pa.array(used, type=pa.int32()), pa.array(blobs, type=pa.binary())], names=["home", "entries"])

    return run


def _shards(batches):
    """``bucket, cid, n`` of the shards with more than one class; rows come sorted by home, one of which is held at a time."""

    def of(blobs: list[bytes]) -> pa.RecordBatch:
        entries = np.frombuffer(b"".join(blobs), dtype=_PACKED)
        wide = np.zeros((len(entries), 8), dtype=np.uint8)
        wide[:, :6] = entries["bucket"]
        bucket, cid = wide.view("<i8").reshape(-1), entries["cid"].astype(np.int64)
        order = np.lexsort((cid, bucket))
        bucket, cid = bucket[order], cid[order]
        fresh = np.ones(len(bucket), dtype=bool)
        fresh[1:] = (bucket[1:] != bucket[:-1]) | (cid[1:] != cid[:-1])
        bucket, cid = bucket[fresh], cid[fresh]
        _, place, count = np.unique(bucket, return_inverse=True, return_counts=True)
        n = count[place]
        several = n > 1
        return pa.RecordBatch.from_arrays([pa.array(x[several]) for x in (bucket, cid, n.astype(np.int64))], names=["bucket", "cid", "n"])

    at, blobs = None, []
    for batch in batches:
        for home, blob in zip(batch.column("home").to_pylist(), batch.column("entries").to_pylist()):
            if home != at and blobs:
                yield of(blobs)
                blobs = []
            at = home
            blobs.append(blob)
    if blobs:
        yield of(blobs)


def near_pairs(texts: DataFrame, threshold: float, block: int = BLOCK, share: float = LARGE, probe: int = PROBE) -> DataFrame:
    """``field, a, b, both, either``: pairs of different classes (``cid``) with similarity of at least ``threshold``."""
    signed = cut(texts.select("cid", "field", "norm").mapInArrow(_sign, SIGNED))
    parts = max(8, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    bands = signed.select("cid", F.explode("bands").alias("bucket"))
    large = _large(bands, signed.filter(F.pmod("cid", F.lit(probe)) == 0).count(), probe, share)
    apart = [] if large is None else [r["bucket"] for r in large.select("bucket").collect()]
    homes = 4 * parts  # more places than tasks, so tasks get like shares
    packed = signed.select("cid", "bands").mapInArrow(_pack(homes, apart), "home int, entries binary")
    shards = packed.repartition(parts, "home").sortWithinPartitions("home").mapInArrow(_shards, "bucket bigint, cid bigint, n bigint")
    if large is not None:
        shards = shards.unionByName(bands.join(F.broadcast(large), "bucket"))
    members = shards.select("bucket", "cid", "n").join(signed.select("cid", "sketch").dropDuplicates(["cid"]), "cid")
    k = F.ceil(F.col("n") / block).cast("int")
    placed = members.withColumn("k", k).withColumn("blk", F.pmod(F.xxhash64("cid"), F.col("k")).cast("int"))
    placed = placed.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    placed = placed.select("bucket", F.least("blk", "x").alias("bi"), F.greatest("blk", "x").alias("bj"), "blk", "cid", "sketch")
    trees = placed.repartition(parts, "bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj", "blk")
    pairs = cut(trees.mapInPandas(_search(radius(threshold)), "a bigint, b bigint").distinct())
    involved = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    wanted = cut(signed.select("cid", "field", "norm").join(involved, "cid", "left_semi").dropDuplicates(["cid"]))
    left = wanted.select(F.col("cid").alias("a"), "field", F.col("norm").alias("na"))
    right = wanted.select(F.col("cid").alias("b"), F.col("field").alias("fb"), F.col("norm").alias("nb"))
    joined = pairs.join(left, "a").join(right, "b").filter(F.col("field") == F.col("fb"))
    scored = joined.select("field", "a", "b", overlap_udf("na", "nb").alias("o"))
    return scored.select("field", "a", "b", "o.both", "o.either").filter(F.col("both") * 1000 >= F.col("either") * round(threshold * 1000))


def members_of(texts: DataFrame) -> DataFrame:
    """``field, key, cid, chk`` of every key and text, written once without the texts."""
    return cut(texts.select("field", "key", "cid", "chk").distinct())


def all_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """``field, key_a, key_b``: every pair of different keys with similar texts, copies expanded.

    The output of a class of copies grows with its square; ``classes`` is the form without. Keys of a large class spread over
    tasks by salts.
    """
    texts = texts_with_class(rows)
    links = near_pairs(texts, threshold).select("field", "a", "b")
    members = members_of(texts)
    hot = heavy_keys(members, "cid")
    spread = F.xxhash64("key", "field")
    other = members.select(F.col("field").alias("f2"), F.col("key").alias("key2"), "cid", F.col("chk").alias("chk2"))
    copies = salted_join(members, other, "cid", "inner", spread=spread, heavy=hot)
    copies = copies.filter((F.col("chk") == F.col("chk2")) & (F.col("field") == F.col("f2")) & (F.col("key") < F.col("key2")))
    near = salted_join(members.select("cid", "field", "key"), links.select(F.col("a").alias("cid"), "b"), "cid", "inner", spread=spread, heavy=hot)
    near = near.select("field", "key", F.col("b").alias("cid"))
    hot_b = heavy_keys(near, "cid") if hot else []
    near = salted_join(near, members.select("cid", F.col("key").alias("key2")), "cid", "inner", spread=spread, heavy=hot_b)
    near = near.filter(F.col("key") != F.col("key2"))
    both = copies.select("field", "key", "key2").unionByName(near.select("field", "key", "key2"))
    return both.select("field", F.least("key", "key2").alias("key_a"), F.greatest("key", "key2").alias("key_b")).distinct()


def classes(rows: DataFrame, threshold: float) -> DataFrame:
    """One row for each row with a text: its class (named by its smallest key), the size of the class and its links to other classes.

    The compact form of all pairs: its size is that of the input, whatever the classes.
    """
    texts = texts_with_class(rows)
    links = near_pairs(texts, threshold)
    degree = links.select("field", F.col("a").alias("cid")).unionByName(links.select("field", F.col("b").alias("cid"))).groupBy("field", "cid").agg(F.count(F.lit(1)).alias("n_links"))
    keys = cut(texts.select("field", "key", "cid"))
    size = keys.groupBy("field", "cid").agg(F.count(F.lit(1)).alias("n_copies"), F.min("key").alias("class_id"))
    per_class = size.join(degree, ["field", "cid"], "left").drop("field")
    joined = salted_join(keys, per_class, "cid", "inner", spread=F.xxhash64("key", "field"))
    return joined.select("field", "key", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
