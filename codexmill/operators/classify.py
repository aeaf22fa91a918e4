"""Classification of blocks: a pattern tier, a learned class tier and a pluggable judge."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.config import CLASS_PURITY

# Patterns of structural lines, in order of precedence.
PATTERNS = (
    ("dieu", r"(?iuU)^\s*Điều\s+(\d+[a-zđ]?)[.\s]"),
    ("chuong", r"(?iuU)^\s*Chương\s+([IVXLC]+)"),
    ("muc", r"(?iuU)^\s*Mục\s+(\d+)"),
    ("khoan", r"(?U)^\s*(\d+)[.\-]\s"),
    ("diem", r"(?U)^\s*([a-zđ])\)\s"),
)
# Fixed value: types that a judge may give.
JUDGED_TYPES = ("phan", "chuong", "muc", "tieu_muc", "dieu", "khoan", "diem", "gach_dau_dong", "phu_luc")
LITERAL_CLASSES = 500
BROADCAST_CLASSES = 100_000


def pattern_tier(text: Column) -> tuple[Column, Column]:
    """Type and number by the first pattern that matches."""
    kind, number = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS):
        hit = text.rlike(pattern)
        kind = F.when(hit, F.lit(name)).otherwise(kind)
        number = F.when(hit, F.regexp_extract(text, pattern, 1)).otherwise(number)
    return kind, number


def class_tier(blocks: DataFrame, class_map: DataFrame, purity: float = CLASS_PURITY) -> DataFrame:
    """``class_type``: type of the first class of a block whose majority is pure enough.

    ``class_map``: ``class, type, purity``, one row a class. Up to ``LITERAL_CLASSES`` pure classes become a literal
    map, so the blocks do not move; more of them join, broadcast while they are at most ``BROADCAST_CLASSES``.
    """
    pure = class_map.filter(F.col("purity") >= purity).select(F.col("class").alias("__class"), F.col("type").alias("__type"))
    rows = pure.limit(LITERAL_CLASSES + 1).collect()
    if len(rows) <= LITERAL_CLASSES:
        if not rows:
            return blocks.withColumn("class_type", F.lit(None).cast("string"))
        types = F.create_map(*[F.lit(x) for r in rows for x in (r["__class"], r["__type"])])
        found = F.filter(F.transform("classes", lambda c: F.try_element_at(types, c)), lambda t: t.isNotNull())
        return blocks.withColumn("class_type", F.get(found, F.lit(0)))
    if pure.limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES:
        pure = F.broadcast(pure)
    exploded = blocks.select("doc_id", "dom_order", F.posexplode("classes").alias("__pos", "__class")).join(pure, "__class")
    first = exploded.groupBy("doc_id", "dom_order").agg(F.min_by("__type", "__pos").alias("class_type"))
    return blocks.join(first, ["doc_id", "dom_order"], "left")


def cascade(blocks: DataFrame) -> DataFrame:
    """``node_type, number_raw, confidence, classified_by, conflict`` from the text and ``class_type``."""
    kind, number = pattern_tier(F.col("text"))
    b = F.col("class_type")
    found = blocks.withColumns({"__a": kind, "__n": number})
    a = F.col("__a")
    return found.withColumns(
        {
            "node_type": F.coalesce(a, b),
            "number_raw": F.col("__n"),
            "confidence": F.when(a.isNotNull() & (a == b), 0.95).when(a.isNotNull() & b.isNotNull(), 0.4).when(a.isNotNull(), 0.8).when(b.isNotNull(), 0.7).otherwise(0.0),
            "classified_by": F.when(a.isNotNull(), "regex").when(b.isNotNull(), "css_class"),
            "conflict": F.coalesce(a != b, F.lit(False)),
        }
    ).drop("__a", "__n")


def apply_mask(masked: DataFrame) -> DataFrame:
    """Masked blocks lose their classification; the state before stays as ``raw_type, raw_confidence``."""
    lost = F.col("is_masked")
    return masked.withColumns(
        {
            "raw_type": F.col("node_type"),
            "raw_confidence": F.col("confidence"),
            "node_type": F.when(~lost, F.col("node_type")),
            "number_raw": F.when(~lost, F.col("number_raw")),
            "confidence": F.when(~lost, F.col("confidence")).otherwise(0.0),
            "classified_by": F.when(~lost, F.col("classified_by")),
            "conflict": F.col("conflict") & ~lost,
        }
    )


def judge(classified: DataFrame, provider: Callable[[str, str, str], dict | None] | None = None, threads: int = 10, patience: float = 45.0) -> DataFrame:
    """Ask ``provider(before, text, after)`` about blocks without a type or with a conflict.

    The rows need ``before, shown, after`` (see ``sequence.context``). The provider gives ``node_type``,
    ``number_raw`` and ``confidence``, or None. A type outside the permitted ones, an exception, a missing
    answer or one later than ``patience`` seconds keeps the old classification. Up to ``threads`` questions
    of a task are open at once, since they wait for a network. Without a provider nothing is asked.
    """
    if provider is None:
        return classified
    schema = classified.schema
    permitted = set(JUDGED_TYPES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = ThreadPoolExecutor(threads)
        for pdf in batches:
            pdf = pdf.copy()
            rows = pdf.index[pdf["node_type"].isna() | pdf["conflict"]]
            asked = [(i, pool.submit(provider, pdf.at[i, "before"] or "", pdf.at[i, "shown"] or "", pdf.at[i, "after"] or "")) for i in rows]
            for i, future in asked:
                try:
                    answer = future.result(timeout=patience)
                except Exception:  # noqa: BLE001 - a failing or late judge leaves the block as it was
                    future.cancel()
                    continue
                if answer and answer.get("node_type") in permitted:
                    pdf.at[i, "node_type"] = answer["node_type"]
                    pdf.at[i, "number_raw"] = answer.get("number_raw")
                    pdf.at[i, "confidence"] = float(answer.get("confidence") or 0.0)
                    pdf.at[i, "classified_by"] = "llm"
            yield pdf
        pool.shutdown(wait=False, cancel_futures=True)

    return classified.mapInPandas(run, schema)
