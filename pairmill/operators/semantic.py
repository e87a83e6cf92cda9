"""Similarity filter and threshold sweep: similarities are computed once, then cut at every threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.functions import text as T

THRESHOLDS = (0.65, 0.70, 0.75, 0.80)


def with_similarity(pairs: DataFrame, src_vec: str, tgt_vec: str, name: str = "similarity") -> DataFrame:
    """Adds the cosine of two vector columns, as a provider of embeddings adds them."""
    return pairs.withColumn(name, T.cosine(F.col(src_vec), F.col(tgt_vec)))


def semantic_filter(pairs: DataFrame, threshold: float = 0.70, similarity: str = "similarity") -> DataFrame:
    """Rows at or above the threshold, compared in double; rows without a similarity go."""
    return pairs.where(F.col(similarity) >= threshold)


def sweep(pairs: DataFrame, thresholds=THRESHOLDS, similarity: str = "similarity") -> DataFrame:
    """Each row once per threshold it reaches, for writing one output per threshold."""
    return pairs.withColumn("threshold", F.explode(F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: F.col(similarity) >= t)))


def exact_median(rows: DataFrame, name: str, buckets: int = 4096, few: int = 50_000) -> float | None:
    """Median of a column of doubles. Counts in `buckets` equal parts of the range tell which part holds the middle rows; that part
    is counted again, until `few` rows or a single value are left, so that no task holds the column."""
    values = rows.select(F.col(name).cast("double").alias("v")).where("v is not null and not isnan(v)")
    r = values.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not r.n:
        return None

    def at(k: int) -> float:
        part, lo, hi, before, n = values, r.lo, r.hi, 0, r.n
        while n > few and lo < hi:
            b = F.least(F.floor((F.col("v") - lo) / ((hi - lo) / buckets)), F.lit(buckets - 1))
            for x in part.groupBy(b.alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect():  # a row per bucket
                if before + x.n > k:
                    break
                before += x.n
            if (x.lo, x.hi) == (lo, hi):  # parts too narrow for doubles
                break
            lo, hi, n = x.lo, x.hi, x.n
            part = values.where(F.col("v").between(lo, hi))
        if lo == hi:
            return lo
        counts = part.groupBy("v").count().orderBy("v").collect()  # of at most `few` rows, or of neighbouring doubles
        for x in counts:
            before += x["count"]
            if before > k:
                return x.v
        raise AssertionError

    return at((r.n - 1) // 2) if r.n % 2 else (at(r.n // 2 - 1) + at(r.n // 2)) / 2


def sweep_stats(pairs: DataFrame, thresholds=THRESHOLDS, similarity: str = "similarity") -> DataFrame:
    """A row per threshold: rows in and out, retention in percent, mean, median and population deviation of all similarities.

    One pass whatever the number of thresholds, and a few for the median; an empty input has retention null. Rows without a similarity count as input only.
    """
    s = F.col(similarity)
    one = pairs.agg(
        F.count("*").alias("input"), F.avg(s).alias("mean_similarity"), F.lit(exact_median(pairs, similarity)).cast("double").alias("median_similarity"), F.stddev_pop(s).alias("std_similarity"),
        *[F.count_if(s >= t).alias(f"o{k}") for k, t in enumerate(thresholds)],
    )
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"o{k}").alias("output")) for k, t in enumerate(thresholds)])
    return one.select("*", F.explode(rows).alias("r")).select(
        "r.threshold", T.threshold_label(F.col("r.threshold")).alias("label"), "input", "r.output",
        F.try_divide(F.col("r.output") * 100.0, F.col("input")).alias("retention"), "mean_similarity", "median_similarity", "std_similarity",
    )
