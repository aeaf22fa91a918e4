"""Joins that hold when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of the rows counts as heavy; so there are fewer than 1 / SHARE of them.
SHARE = 1 / 64


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """Keys with more than ``share`` of all rows: never more than ``1 / share`` values.

    Counted over all rows with map-side combine, so the heavy keys themselves shuffle
    as one row per map task. Null keys are left out.
    """
    counts = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    if not total:
        return []
    rows = counts.filter(F.col("k").isNotNull() & (F.col("n") > F.lit(total * share))).select("k").collect()
    return sorted(r["k"] for r in rows)


def default_salts(df: DataFrame) -> int:
    """As many salts as the session has shuffle partitions: a hot key's slices shrink as the cluster's tasks do."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", salts: int | None = None, share: float = SHARE, spread=None, heavy: list | None = None) -> DataFrame:
    """Equi-join on ``key`` where ``left`` may have heavy keys and ``right`` has few rows a key.

    Rows of a heavy key spread over ``salts`` partitions (default: the shuffle partitions) by ``spread`` (a
    column expression, default: a hash of the whole left row); the matching right rows are repeated for every
    salt; there are fewer than ``1 / share`` heavy keys. All other rows join as usual. ``heavy`` may give the heavy keys
    where they are known. ``how`` may be ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    heavy = heavy_keys(left, key, share) if heavy is None else heavy
    if not heavy:
        return left.join(right, key, how)
    salts = salts or default_salts(left)
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    spread = F.xxhash64(*left.columns) if spread is None else spread
    salted = left.withColumn("__salt", F.when(is_heavy, F.pmod(spread, F.lit(salts)).cast("int")).otherwise(F.lit(0)))
    copies = right.withColumn("__salt", F.explode(F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(copies, [key, "__salt"], how).drop("__salt")
