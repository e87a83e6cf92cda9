"""Verdicts on a stream of pairs. An addition of this engine: the rules look at one pair at a time, so a stream needs no state.

Near duplicates would need the state of all pairs seen and aren't decided here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.operators.rules import FilterConfig, verdict
from pairmill.sources.jsonl import keyed


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(src, tgt, raw) of lines of JSON as they arrive in a folder."""
    src, tgt = keyed(F.col("value"))
    return spark.readStream.text(path).select(src.alias("src"), tgt.alias("tgt"), F.col("value").alias("raw"))


def filtered(stream: DataFrame, config: FilterConfig = FilterConfig()) -> DataFrame:
    return verdict(stream, config=config)


def write_passed(stream: DataFrame, path: str, checkpoint: str):
    """Raw lines of the pairs that pass, each once, over restarts too."""
    return filtered(stream).where("reason = 'passed'").select(F.col("raw").alias("value")).writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")


def reasons_by_window(stream: DataFrame, time: str, late: str = "10 minutes", width: str = "5 minutes", config: FilterConfig = FilterConfig()) -> DataFrame:
    """Counts of verdicts per window of event time; rows later than the watermark are left out."""
    return filtered(stream, config).withWatermark(time, late).groupBy(F.window(time, width), "reason").count()
