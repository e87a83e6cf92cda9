"""Deterministic samples and splits. Order is that of md5(seed:id), which any engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shuffled(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def head(rows: DataFrame, n: int, order: str) -> DataFrame:
    """The first n rows by an explicit order."""
    return rows.orderBy(order).limit(n)


def sample(rows: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """min(n, size) rows without replacement."""
    return rows.orderBy(shuffled(key, seed), key).limit(n)


def first_of_each(rows: DataFrame, group: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """A sample of at most n rows of each group, numbered."""
    order = Window.partitionBy(group).orderBy(shuffled(key, seed), key)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def ranked(rows: DataFrame, key: str, seed: int = 42, digits: int = 4, total: bool = False) -> DataFrame:
    """Adds `rank`, 1 to N, by shuffled order of a unique key, without bringing all rows into one task: rows are ranked
    inside buckets of the digest's first digits, after the rows of the buckets before. There are 16 ** digits buckets at
    most, which bounds what is broadcast. With `total`, `_all` holds N."""
    keyed = rows.withColumn("_order", shuffled(key, seed)).withColumn("_bucket", F.substring("_order", 1, digits))
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # over one row per bucket
    sizes = sizes.select("_bucket", before.alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_order", key))
    return keyed.join(F.broadcast(sizes), "_bucket").withColumn("rank", F.col("_before") + inside).drop("_order", "_bucket", "_before", *[] if total else ["_all"])


def split(rows: DataFrame, key: str, seed: int = 42, train: float = 0.95, dev: float = 0.025) -> DataFrame:
    """Adds `split`: int(train * N) rows train, int(dev * N) dev, the rest test. Sizes are exact, splits disjoint."""
    n = F.col("_all")
    a, b = F.floor(n * F.lit(float(train))), F.floor(n * F.lit(float(dev)))
    named = F.when(F.col("rank") <= a, "train").when(F.col("rank") <= a + b, "dev").otherwise("test")
    return ranked(rows, key, seed, total=True).withColumn("split", named).drop("rank", "_all")
