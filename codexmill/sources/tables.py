"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the folder; Parquet keeps pruning and pushdown intact."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Point lookup: rows whose ``key`` equals ``value``, pushed to the scan; at most one row."""
    return df.filter(F.col(key) == F.lit(value)).limit(1)


def pick(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str | None = None) -> DataFrame:
    """IN-list scan as a left semi join, so the list may be of any length."""
    keys = wanted.select(F.col(wanted_key or key).alias("__wanted")).distinct()
    return df.join(keys, df[key] == keys["__wanted"], "left_semi")


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row table; Parquet answers it from the footers."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of repeated keys the row that comes last in ``order``; rows with a null key are kept out.

    One aggregation with map-side combine: ``max_by`` over the whole row, so a key
    delivered any number of times never gathers in one place.
    """
    cols = df.columns
    packed = df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("__k"), F.struct(*[F.col(o) for o in order]).alias("__o"), F.struct(*[F.col(c) for c in cols]).alias("__r")
    )
    return packed.groupBy("__k").agg(F.max_by("__r", "__o").alias("__r")).select("__r.*")
