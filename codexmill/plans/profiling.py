"""Corpus profiling from raw HTML: one read of the documents, then grouped DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.operators import profile as P
from codexmill.operators.html import profile_udf
from codexmill.session import cut


class CorpusProfile:
    """The parts of a profile as DataFrames; the elements are written to the shared folder once.

    Raw text is profiled as it is: not cleaned and not normalised. Elements are nested, so the text of an inner
    element counts again in the outer one. Elements without text are passed over; blank documents count in the totals
    and have no template; documents that cannot be read are counted.
    """

    def __init__(self, content: DataFrame, key: str, source: str):
        flat = content.select(F.col(key).alias("doc_id"), profile_udf(F.col(source)).alias("p"))
        self.flat = cut(flat)
        self.elements = self.flat.select("doc_id", F.posexplode("p.elements").alias("dom_order", "e")).select("doc_id", "dom_order", "e.*")
        self.crosstab = P.crosstab(self.elements)

    def presence(self) -> DataFrame:
        rate = lambda c: F.avg(F.col(f"p.{c}").cast("int"))
        return self.flat.agg(F.count(F.lit(1)).alias("n_docs"), rate("has_table").alias("with_table"), rate("has_img").alias("with_image"), rate("has_link").alias("with_link"))

    def totals(self) -> DataFrame:
        return self.flat.agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("p.parse_error").alias("parse_errors"))

    def types(self) -> DataFrame:
        """Rates over all documents, also those without an element."""
        some, total = P.type_rates(self.elements), self.flat.count()
        rates = [c for c in some.columns if c.startswith("rate_")]
        return some.select(F.lit(total).alias("n_docs"), *[(F.coalesce(F.col(c), F.lit(0.0)) * F.col("n_docs") / max(total, 1)).alias(c) for c in rates])

    def classes(self, n: int = 200) -> DataFrame:
        return P.top_classes(P.class_stats(self.elements), n)

    def class_map(self) -> DataFrame:
        return P.class_map(self.crosstab)

    def agreement(self) -> DataFrame:
        return P.agreement(self.crosstab)

    def multi_part(self) -> DataFrame:
        return P.multi_part_rate(self.elements)

    def samples(self) -> DataFrame:
        return P.class_samples(self.elements)

    def indents(self) -> DataFrame:
        return P.top_indents(self.elements)

    def families(self) -> DataFrame:
        return P.top_templates(self.flat.select("doc_id", F.col("p.template_family").alias("template_family")).filter(F.col("template_family").isNotNull()))

    def summary(self) -> DataFrame:
        """``metric, name, value``: the single numbers of the profile in one table."""
        long = lambda df: df.select(F.explode(F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("double"))])).alias("name", "value"))
        parts = {"totals": self.totals(), "presence": self.presence(), "types": self.types(), "agreement": self.agreement(), "multi_part": self.multi_part()}
        return reduce(DataFrame.unionByName, [long(df).select(F.lit(m).alias("metric"), "name", "value") for m, df in parts.items()])


def write_profile(profile: CorpusProfile, folder: str) -> None:
    """The profile as JSON, one folder for each part."""
    for name in ("classes", "class_map", "samples", "indents", "families", "summary"):
        getattr(profile, name)().write.mode("overwrite").json(f"{folder}/{name}")


def write_samples(samples: DataFrame, folder: str) -> None:
    """The ids of the two samples (``doc_id, sample``) as JSON, one folder for each: ``dev`` and ``golden``."""
    for name in ("dev", "golden"):
        samples.filter(F.col("sample") == name).select("doc_id").write.mode("overwrite").json(f"{folder}/{name}")
