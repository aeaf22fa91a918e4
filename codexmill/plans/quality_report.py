"""Text reports put together from small results; every section is a DataFrame of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.functions.text import or_unknown
from codexmill.operators import reports as R
from codexmill.plans.profiling import CorpusProfile


def quality_report(quality: DataFrame) -> str:
    """Shares, issue combinations and verdicts by type, decade and template."""
    shares = R.verdict_shares(quality).select("verdict", "n", F.format_string("%.1f%%", F.col("share") * 100).alias("share")).orderBy(F.desc("n"))
    by_type = R.verdict_pivot(quality, or_unknown(F.col("loai_van_ban")), "loai_van_ban").orderBy(F.desc("total"), "loai_van_ban")
    by_decade = R.verdict_pivot(quality, or_unknown(F.col("decade")), "decade").orderBy("decade")
    by_template = R.verdict_pivot(quality, F.substring("template_family", 1, 80), "template", top=15)
    sections = [("Verdicts", shares), ("Issue combinations", R.issue_combinations(quality)), ("By type", by_type), ("By decade", by_decade), ("By template", by_template)]
    return "# Quality\n\n" + "\n".join(R.to_markdown(df, title) for title, df in sections)


def profile_report(profile: CorpusProfile) -> str:
    """Rates, class map, frequent classes and templates."""
    sections = [
        ("Summary", profile.summary().orderBy("metric", "name")),
        ("Class map", profile.class_map().orderBy(F.desc("n"), "class").limit(40)),
        ("Classes", profile.classes(30)),
        ("Templates", profile.families()),
    ]
    return "# Profile\n\n" + "\n".join(R.to_markdown(df, title) for title, df in sections)
