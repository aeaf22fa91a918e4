"""Stratified sampling without replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codexmill.config import SAMPLE_SEED


def round_robin(df: DataFrame, key: str, strata: list[str], n: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """``n`` rows that take turns over the strata: a second row of a stratum comes after the first of all others.

    The order within and between strata is a hash of the seed, so a sample can be repeated anywhere. The rank
    filter keeps ``n`` rows a stratum on the map side.
    """
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    turn = F.row_number().over(W.partitionBy(*strata).orderBy(order, key))
    label = F.concat_ws("|", *[F.coalesce(F.col(s).cast("string"), F.lit("")) for s in strata])
    ranked = df.withColumns({"turn": turn, "__lot": F.md5(F.concat(label, F.lit(f":{seed}")))}).filter(F.col("turn") <= n)
    return ranked.orderBy("turn", "__lot", key).limit(n).drop("__lot")


def two_samples(df: DataFrame, key: str, strata: list[str], n_first: int, n_second: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """Two disjoint samples: ``key, sample`` with ``dev`` and ``golden``."""
    first = round_robin(df, key, strata, n_first, seed).select(key, F.lit("dev").alias("sample"))
    rest = df.join(first.select(key), key, "left_anti")
    second = round_robin(rest, key, strata, n_second, seed + 1).select(key, F.lit("golden").alias("sample"))
    return first.unionByName(second)
