"""The two texts of each pair as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.plans.runtime import table

FIELDS = ("kor_Hang", "vie_Latn")


def pair_fields(pairs: DataFrame) -> DataFrame:
    """(pair_id, field, text) of a table with pair_id and translation; null texts are left out."""
    both = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"translation.{f}").alias("text")) for f in FIELDS])
    return pairs.select("pair_id", F.explode(both).alias("f")).select("pair_id", "f.field", "f.text").where("text is not null")


def corpus_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_fields(table(spark, sf_dir, "pair_corpus").select("pair_id", "translation"))
