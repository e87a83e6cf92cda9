"""Analysis of translated samples: similarity bands, reference issues, recommendations."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

from pairmill.functions import text as T

BANDS = ("perfect", "close", "different_style", "wrong")


@F.pandas_udf(DoubleType())
def sequence_ratio(reference: pd.Series, prediction: pd.Series) -> pd.Series:
    """difflib ratio of the two texts in lower case without blanks at the ends; the order of the two matters. Null texts count as empty."""
    return pd.Series([difflib.SequenceMatcher(None, (r or "").lower().strip(), (p or "").lower().strip()).ratio() for r, p in zip(reference, prediction, strict=True)], dtype="float64")


def samples(results: DataFrame, *keys: str, first: int | None = None) -> DataFrame:
    """(keys, sample_no, source, reference, prediction) of the samples of results, the first ones only if a number is given."""
    out = results.select(*keys, F.posexplode("samples").alias("sample_no", "s")).select(*keys, F.col("sample_no").cast("bigint").alias("sample_no"), "s.source", "s.reference", "s.prediction")
    return out if first is None else out.where(F.col("sample_no") < first)


def banded(rows: DataFrame) -> DataFrame:
    """Adds similarity and band."""
    s = F.col("similarity")
    return rows.withColumn("similarity", sequence_ratio("reference", "prediction")).withColumn("band", F.when(s >= 0.95, "perfect").when(s >= 0.7, "close").when(s >= 0.4, "different_style").otherwise("wrong"))


def band_counts(rows: DataFrame, by: list[str], requested: int | None = None) -> DataFrame:
    """(by, band, n, pct): share of each band of the rows there are, or of the number requested."""
    counts = rows.groupBy(*by, "band").agg(F.count("*").alias("n"))
    of = F.lit(requested) if requested else F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("pct", F.try_divide(F.col("n") * 100.0, of))


def examples(rows: DataFrame, by: list[str]) -> DataFrame:
    """The first 10 wrong, 10 different and 5 close samples of each group."""
    order = Window.partitionBy(*by, "band").orderBy("sample_no")
    most = F.when(F.col("band").isin("wrong", "different_style"), 10).when(F.col("band") == "close", 5).otherwise(0)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def issues(reference):
    """Array of the issues of a reference: too_short, mixed_language, potentially_literal. Null counts as empty."""
    r = F.coalesce(reference, F.lit(""))
    return F.array_compact(F.array(F.when(T.word_count(r) < 3, "too_short"), F.when(T.mixed_language(r), "mixed_language"), F.when(T.literal_score(r) >= 3, "potentially_literal")))


def reference_issues(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, sample_no, issue): a row for each issue of each sample."""
    return rows.select(*keys, "sample_no", F.explode(issues(F.col("reference"))).alias("issue"))


def recommendations(bands: DataFrame, results: DataFrame, key: str = "run_id") -> DataFrame:
    """(key, advice): more_data_or_filtering above 20 % wrong, style_mismatch above 30 % different style, trust_comet above COMET 0.8."""
    share = bands.groupBy(key).agg(F.sum(F.when(F.col("band") == "wrong", F.col("pct")).otherwise(0)).alias("wrong"), F.sum(F.when(F.col("band") == "different_style", F.col("pct")).otherwise(0)).alias("style"))
    rules = F.array_compact(F.array(F.when(F.coalesce("wrong", F.lit(0.0)) > 20, "more_data_or_filtering"), F.when(F.coalesce("style", F.lit(0.0)) > 30, "style_mismatch"), F.when(F.coalesce("comet", F.lit(0.0)) > 0.8, "trust_comet")))
    return results.select(key, F.col("metrics.comet").alias("comet")).join(share, key, "left").select(key, F.explode(rules).alias("advice"))


def pair_view(pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    """What a reviewer sees of a pair: words, ratio (0 for an empty source), numbers."""
    ratio = F.coalesce(T.length_ratio(F.col("src"), F.col("tgt")), F.lit(0.0))
    return pairs.select(key, "src", "tgt", T.word_count(F.col("src")).alias("src_words"), T.word_count(F.col("tgt")).alias("tgt_words"), ratio.alias("ratio"), T.numbers(F.col("src")).alias("src_numbers"), T.numbers(F.col("tgt")).alias("tgt_numbers"))
