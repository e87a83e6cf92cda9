"""Comparisons of evaluation results: two runs, tuned against baseline, thresholds of a sweep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

METRICS = ("bleu", "chrf", "ter", "comet")


def long_metrics(results: DataFrame, *keys: str) -> DataFrame:
    """(keys, metric, value), one row per metric that a result has; a nested score counts as the value."""
    values = [F.struct(F.lit(m).alias("metric"), F.col("metrics.bleu.score" if m == "bleu" else f"metrics.{m}").alias("value")) for m in METRICS]
    return results.select(*keys, F.explode(F.array(*values)).alias("m")).select(*keys, "m.metric", "m.value").where("value is not null")


def compare(first: DataFrame, second: DataFrame, on: list[str] = (), ter_inverted: bool = True) -> DataFrame:
    """(on, metric, model1, model2, delta, percent) of the metrics that both have; inputs have on, metric, value.

    A smaller TER is better, so its delta is turned round unless ter_inverted is False, as in the table against a
    baseline. Percent is of the first value, 0 if that is 0.
    """
    on = list(on)
    both = first.select(*on, "metric", F.col("value").alias("model1")).join(second.select(*on, "metric", F.col("value").alias("model2")), [*on, "metric"])
    delta = F.col("model2") - F.col("model1")
    delta = F.when(F.col("metric") == "ter", -delta).otherwise(delta) if ter_inverted else delta
    return both.withColumn("delta", delta).withColumn("percent", F.when(F.col("model1") == 0, 0.0).otherwise(F.try_divide(F.col("delta") * 100, F.col("model1"))))


def against_baseline(results: DataFrame, is_baseline, key: str = "run_id", test: str = "test_file") -> DataFrame:
    """Every other run against the latest baseline run of the same test file, TER not turned round."""
    base = results.where(is_baseline)
    latest = base.groupBy(test).agg(F.max(key).alias(key))
    first = long_metrics(base.join(latest, [test, key]), test)
    tuned = long_metrics(results.where(~is_baseline), key, test)
    return compare(tuned.select(key, test, "metric").join(first, [test, "metric"]), tuned, [key, test], ter_inverted=False)


def previous_runs(results: DataFrame, key: str = "run_id", test: str = "test_file") -> DataFrame:
    """Every run against the one before it on the same test file, by metric both have."""
    order = Window.partitionBy(test).orderBy(key)
    linked = results.withColumn("before", F.lag(key).over(order)).where("before is not null")
    second = long_metrics(linked, key)
    first = long_metrics(results.select(F.col(key).alias("before"), "metrics"), "before").join(linked.select(key, "before"), "before")
    return compare(first.select(key, "metric", "value"), second, [key])


def sweep_table(results: DataFrame, threshold, key: str = "run_id") -> DataFrame:
    """(threshold, run, bleu, chrf, ter, comet, test_size): the latest result of each threshold, ascending; results without a threshold are skipped."""
    rows = results.withColumn("threshold", threshold).where("threshold is not null")
    latest = rows.groupBy("threshold").agg(F.max(key).alias(key))
    return rows.join(latest, ["threshold", key]).select("threshold", key, F.col("metrics.bleu.score").alias("bleu"), "metrics.chrf", "metrics.ter", "metrics.comet", "test_size").orderBy("threshold")


def best(table: DataFrame, name: str = "threshold", score: str = "bleu") -> DataFrame:
    """The name with the greatest score, the smallest name on a tie; null if no row has a score."""
    return table.where(F.col(score).isNotNull()).agg(F.max_by(name, F.struct(F.col(score), -F.col(name))).alias(f"best_{name}"), F.max(score).alias(f"best_{score}"))
