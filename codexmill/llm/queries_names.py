"""Queries of problem 3: variant spellings of signers and issuing bodies."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.llm.names import entities, entity_pairs
from codexmill.session import checkpoint_root
from codexmill.sources.tables import table

FIELDS = {"nguoi_ky": False, "co_quan_ban_hanh": True}


def _each(spark: SparkSession, d: str, finish) -> DataFrame:
    """Both fields at once: each is a row of small jobs, which leave most of a cluster idle one after the other."""
    docs = table(spark, d, "documents")
    checkpoint_root(spark)
    one = lambda f: finish(entities(docs.select(F.col(f).alias("name")), FIELDS[f])).withColumn("field", F.lit(f))
    with ThreadPoolExecutor(len(FIELDS)) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, FIELDS))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _each(spark, d, entity_pairs).select("field", "name_a", "name_b")


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    return _each(spark, d, lambda e: e).select("field", "name", "n", "entity")


QUERIES = {"p3_found": p3_found, "p3_entities": p3_entities}
ORACLES: dict[str, str] = {}
