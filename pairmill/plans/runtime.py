"""Helpers around a running session: where to cut lineage, how wide to read."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Input up to this size may be dealt out; what it costs is a shuffle of so many bytes at most.
SPREAD_BYTES = 1 << 30


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A session on one machine that names none (tests) gets a folder of its own; on a cluster
    one must be named, as executors share no other."""
    sc = spark.sparkContext
    now = sc.getCheckpointDir()
    if now:
        return now
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="pairmill-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: the rows are computed once, survive a lost executor and end the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out where an input of SPREAD_BYTES at most comes in fewer splits than there are cores, as one row group does.
    Column pruning and filters pass through; a larger table, or one with enough splits, stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Let Python workers import the package where they don't find it by themselves: by PYTHONPATH or their folder."""
    package = Path(__file__).resolve().parents[1]
    root = str(package.parent)
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or os.getcwd() == root:
        return
    if any(Path(f).name == "pairmill.zip" for f in spark.sparkContext.listFiles):
        return
    to = Path(tempfile.mkdtemp(prefix="pairmill-")) / "pairmill.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(to))
