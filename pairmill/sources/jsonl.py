"""Pairs in JSON lines and in parallel text files: readers, validation, writers.

A file's line order is made a column, `ordinal`: Spark's own line numbers of a partition after the lines of the
partitions before, so any number of files and splits is read in parallel. Files count in order of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmill.plans.runtime import cut

PAIR = "translation STRUCT<kor_Hang: STRING, vie_Latn: STRING>"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_strict(spark: SparkSession, path: str) -> DataFrame:
    """translation of every line; fails on a malformed line. Blank lines are skipped."""
    return spark.read.schema(PAIR).option("mode", "FAILFAST").json(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(ordinal, raw): every line that isn't blank, with its place in the files. Ordinals begin at 0 and have no gaps."""
    lines = spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    return _numbered(cut(lines.where(F.trim("raw") != "")), ["file", "start"], "id").select("ordinal", "raw")


def _numbered(lines: DataFrame, parts: list[str], order: str) -> DataFrame:
    """Adds ordinal: rows counted part by part, then inside each part by its least id, without one task seeing all rows."""
    from pyspark.sql.window import Window

    high = F.shiftright(order, 33)  # the partition that gave the id
    sized = lines.groupBy(*parts, high.alias("_p")).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(*parts, "_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # over the read splits
    sized = sized.select(*parts, "_p", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*parts, "_p").orderBy(order))
    return lines.withColumn("_p", high).join(sized, [*parts, "_p"]).withColumn("ordinal", (F.col("_before") + inside - 1).cast("bigint")).drop("_p", "_before")


def keyed(raw: Column, src_key: str = "kor_Hang", tgt_key: str = "vie_Latn") -> tuple[Column, Column]:
    """Source and target of a raw line by key; null where a key is missing or the line is malformed."""
    whole = F.try_parse_json(raw)
    return F.try_variant_get(whole, f"$.translation.{src_key}", "string"), F.try_variant_get(whole, f"$.translation.{tgt_key}", "string")


def positional(raw: Column) -> tuple[Column, Column]:
    """First and second value of the translation object, whatever their keys: a file with its keys exchanged exchanges the
    texts. Null for a malformed line."""
    schema = T.StructType([T.StructField("translation", T.MapType(T.StringType(), T.StringType()))])
    values = F.map_values(F.from_json(F.when(F.try_parse_json(raw).isNotNull(), raw), schema)["translation"])
    return F.get(values, F.lit(0)), F.get(values, F.lit(1))


def pairs(lines: DataFrame, by_position: bool = False) -> DataFrame:
    """(pair_id, src, tgt, raw) from (ordinal, raw): the raw line is kept, so that fields beside the pair survive filtering."""
    src, tgt = positional(F.col("raw")) if by_position else keyed(F.col("raw"))
    return lines.select(F.col("ordinal").alias("pair_id"), src.alias("src"), tgt.alias("tgt"), "raw")


def read_parallel(spark: SparkSession, src_path: str, tgt_path: str) -> DataFrame:
    """(ordinal, src, tgt): line i of both files, stripped; lines beyond the shorter file are left out. Blank lines count."""
    from pairmill.functions.text import WS

    def lines(path: str, name: str) -> DataFrame:
        raw = spark.read.text(path).select(F.regexp_replace("value", f"^{WS}+|{WS}+$", "").alias(name), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
        return _numbered(cut(raw), ["file", "start"], "id").select("ordinal", name)

    return lines(src_path, "src").join(lines(tgt_path, "tgt"), "ordinal")


def problems(lines: DataFrame, first: int | None = None) -> DataFrame:
    """(ordinal, problem) of lines that don't hold a pair: malformed, no_translation, no_kor_Hang or no_vie_Latn. `first` looks at so many lines only."""
    whole = F.try_parse_json("raw")
    inner = F.try_variant_get(whole, "$.translation", "variant")
    kind = (
        F.when(whole.isNull(), "malformed").when(inner.isNull(), "no_translation")
        .when(F.try_variant_get(whole, "$.translation.kor_Hang", "string").isNull(), "no_kor_Hang")
        .when(F.try_variant_get(whole, "$.translation.vie_Latn", "string").isNull(), "no_vie_Latn")
    )
    rows = lines if first is None else lines.where(F.col("ordinal") < first)
    return rows.select("ordinal", kind.alias("problem")).where("problem is not null")


def as_line(src: Column, tgt: Column) -> Column:
    """A pair as a line of JSON, text unescaped."""
    return F.to_json(F.struct(F.struct(src.alias("kor_Hang"), tgt.alias("vie_Latn")).alias("translation")))


def write_lines(rows: DataFrame, path: str, raw: str = "raw", order: str | None = None, one_file: bool = False) -> None:
    """One object per line, overwriting. Sorted by `order` over all part files if given; one file for small results only."""
    out = rows.orderBy(order) if order else rows
    out = out.select(raw)
    (out.coalesce(1) if one_file else out).write.mode("overwrite").text(path)


def write_splits(rows: DataFrame, path: str, raw: str = "raw") -> None:
    """Lines under split=train, split=dev and split=test."""
    rows.select(F.col("split"), F.col(raw)).write.mode("overwrite").partitionBy("split").text(path)
