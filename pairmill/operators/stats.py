"""Counts and shares of verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rejection_report(verdicts: DataFrame) -> DataFrame:
    """(reason, n, pct): rows of each reason and their percentage of the input, most frequent first, ties by name."""
    counts = verdicts.groupBy("reason").agg(F.count("*").alias("n"))
    every = F.sum("n").over(Window.partitionBy())  # over one row per reason
    return counts.select("reason", "n", F.try_divide(F.col("n") * 100.0, every).alias("pct")).orderBy(F.desc("n"), "reason")


def retention(verdicts: DataFrame) -> DataFrame:
    """(total, passed, retention): retention in percent, null for an empty input."""
    total, passed = F.count("*"), F.count_if(F.col("reason") == "passed")
    return verdicts.agg(total.alias("total"), passed.alias("passed"), F.try_divide(passed * 100.0, total).alias("retention"))


def observed(df: DataFrame, name: str, reason: str = "reason"):
    """The same rows, with total and passed counted on the way; the second value gives them after an action."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("total"), F.count_if(F.col(reason) == "passed").alias("passed")), seen


def token_totals(rows: DataFrame, ids: str, group: str | None = None) -> DataFrame:
    """Tokens of all rows when padded to the longest of their group, and without padding."""
    by = [group] if group else []
    sized = rows.select(*by, F.size(ids).alias("n"))
    return sized.groupBy(*by).agg((F.max("n") * F.count("*")).alias("padded"), F.sum("n").alias("tokens"))
