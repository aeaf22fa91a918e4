"""Scalar text and date functions as columns; Python only where the JVM lacks Unicode normalisation."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip(c: Column) -> Column:
    """Without surrounding white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def solid(c: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def whole_number(c: Column) -> Column:
    """A run of digits as a number, full-width digits too; anything else is null."""
    return F.nullif(F.translate(c, "０１２３４５６７８９", "0123456789"), F.lit("")).try_cast("int")


def parse_date(c: Column) -> Column:
    """Day/month/year with one or two digits; what is no date becomes null."""
    return F.try_to_date(c, "d/M/yyyy")


def decade(c: Column) -> Column:
    """Decade of the four digits that end the text, as ``1990s``; otherwise ``unknown``."""
    year = F.regexp_extract(F.trim(c), r"(\d{4})$", 1)
    return F.when(F.coalesce(year, F.lit("")) == "", "unknown").otherwise(F.concat(F.substring(year, 1, 3), F.lit("0s")))


def or_unknown(c: Column) -> Column:
    """Null and empty labels as ``unknown``."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))


def markdown_cell(c: Column, width: int = 80) -> Column:
    """A value fit for a table cell: no bars, no line breaks, cut to ``width``."""
    return F.substring(F.replace(F.replace(c, F.lit("|"), F.lit("/")), F.lit("\n"), F.lit(" ")), 1, width)


def slug(text: str | None) -> str:
    """Runs of ASCII letters and digits of the compatibility decomposition, joined by hyphens; other letters vanish."""
    kept = "".join(c for c in unicodedata.normalize("NFKD", text or "") if c.isascii())
    return "-".join(re.findall("[a-z0-9]+", kept.lower())) or "doc"


@F.pandas_udf(T.StringType())
def slugify(c: pd.Series) -> pd.Series:
    return c.map(slug)


def doc_slug(number: Column, doc_id: Column) -> Column:
    """Slug of the document number and the id; the id alone where there is no number."""
    return F.when(F.coalesce(number, F.lit("")) != "", F.concat(slugify(number), F.lit("-"), slugify(doc_id))).otherwise(slugify(doc_id))
