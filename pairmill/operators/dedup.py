"""Duplicates among texts, the earliest kept: exact ones by digest, near ones by banded MinHash.

Rows that share a bucket of a band are neighbours. A row is dropped if an earlier neighbour was kept, so that of a chain
a-b-c, where a and c aren't neighbours, b alone goes. All rows of a bucket are neighbours of each other; so a bucket
keeps one row at most, and rounds of "least open row of each bucket" settle every row without ever listing pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.functions import text as T
from pairmill.plans.runtime import cut

#: 128 permutations in 8 bands of 16: the split with the least error for a Jaccard threshold of 0.85.
PERMUTATIONS, BANDS = 128, 8
#: Rows of a bucket that one task takes at least, and hot buckets at most, which are broadcast: larger buckets are dealt out.
HOT_ROWS, HOT_BUCKETS = 100_000, 10_000
#: Words up to which sets meet by pairs of words.
PAIRED = 60


def exact_groups(rows: DataFrame, key: str = "pair_id", text: str = "text") -> DataFrame:
    """(first, copies) of each group of texts that are equal when normalized. Null texts belong to no group."""
    digest = F.md5(T.normalized(F.col(text)))
    return rows.where(F.col(text).isNotNull()).groupBy(digest.alias("digest")).agg(F.min(key).alias("first"), F.count("*").alias("copies")).select("first", "copies")


def token_hashes(t):
    """Distinct words of the normalized text as 64-bit hashes, sorted."""
    return F.array_sort(F.array_distinct(F.transform(T.words(T.normalized(t)), lambda w: F.xxhash64(w))))


def _band_batches(permutations: int, bands: int, seed: int = 1):
    r = np.random.default_rng(seed)
    a = r.integers(1, 1 << 31, permutations, dtype=np.uint64) | np.uint64(1)
    b = r.integers(0, 1 << 31, permutations, dtype=np.uint64)
    rows = permutations // bands
    fold = (r.integers(1, 1 << 62, rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            offsets = lists.offsets.to_numpy()
            sizes = np.diff(offsets)
            ids = np.flatnonzero(sizes)
            n = len(ids)
            keys = np.empty((n, bands), np.int64)
            if n:
                begin = offsets[ids]
                low = values >> np.uint64(32)  # 32 bits a word, so that products stay in 64
                for band in range(bands):
                    acc = np.zeros(n, np.uint64)
                    for k in range(rows):
                        p = band * rows + k
                        h = (low * a[p] + b[p]) % np.uint64(4294967291)
                        # offsets of empty lists between begins are skipped: reduceat over the begins of the others
                        acc = acc * np.uint64(31) + np.minimum.reduceat(h, begin) * fold[k]
                    keys[:, band] = (acc ^ (acc >> np.uint64(29))).view(np.int64) ^ band
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(ids, bands))), pa.array(np.tile(np.arange(bands, dtype=np.int32), n)), pa.array(keys.ravel())], ["id", "band", "bucket"])

    return run


def bands(rows: DataFrame, key: str = "pair_id", text: str = "text", permutations: int = PERMUTATIONS, n_bands: int = BANDS) -> DataFrame:
    """(id, band, bucket) of each text with words."""
    tokens = rows.select(F.col(key).alias("id"), token_hashes(F.col(text)).alias("tokens")).where("size(tokens) > 0")
    return tokens.mapInArrow(_band_batches(permutations, n_bands), f"id {dict(rows.dtypes)[key]}, band int, bucket bigint")


def independent(buckets: DataFrame, each: int | None = None) -> DataFrame:
    """(id, kept): the lexicographically first independent set of rows under "shares a bucket", from (id, band, bucket) rows;
    `each` is the number of buckets of every id where that is known and no row repeated.

    Each round keeps the rows that are the least open ones of all their buckets and drops the others of these buckets.
    The least open row of all is always kept, so the rounds end. A round aggregates the open rows by bucket, partly before
    the shuffle, counts the buckets each least row has to itself, and joins open rows with the buckets taken, of which those
    of many rows are dealt out.
    """
    open_ = cut(buckets if each else buckets.distinct())
    of = None if each else open_.groupBy("id").agg(F.count("*").alias("of"))
    settled: list[DataFrame] = []
    while True:
        least = cut(open_.groupBy("band", "bucket").agg(F.min("id").alias("id"), F.count("*").alias("n")))
        size = least.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
        if not size.rows:
            break
        first = least.groupBy("id").agg(F.count("*").alias("mine"))
        first = first.where(F.col("mine") == each) if each else first.join(of, "id").where(F.col("mine") == F.col("of"))
        winners = first.select("id", F.lit(True).alias("kept"))
        # buckets of winners: the winner is the least row of each
        taken = least.where("n > 1").join(winners.select("id"), "id", "left_semi")
        members = _members(open_, taken, max(HOT_ROWS, size.rows // HOT_BUCKETS), size.most)
        settled.append(cut(members.withColumn("kept", F.lit(False)).unionAll(winners).groupBy("id").agg(F.max("kept").alias("kept"))))
        if len(settled) > 8:  # a union of many parts makes a long plan
            settled = [cut(_union(settled))]
        open_ = cut(open_.join(settled[-1], "id", "left_anti"))
    return _union(settled) if settled else open_.select("id").distinct().withColumn("kept", F.lit(True))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _members(open_: DataFrame, taken: DataFrame, limit: int, most: int) -> DataFrame:
    """id of the rows of the buckets taken (band, bucket, n). Buckets of more rows than the limit are dealt out over several tasks."""
    if most <= limit:
        return open_.join(taken.select("band", "bucket"), ["band", "bucket"], "left_semi").select("id")
    hot = taken.where(F.col("n") > limit).select("band", "bucket", F.ceil(F.col("n") / limit).cast("int").alias("parts"))
    dealt = open_.join(F.broadcast(hot), ["band", "bucket"], "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int"))
    parts = taken.select("band", "bucket", F.explode(F.sequence(F.lit(0), F.when(F.col("n") > limit, F.ceil(F.col("n") / limit) - 1).otherwise(0).cast("int"))).alias("part"))
    return dealt.join(parts, ["band", "bucket", "part"], "left_semi").select("id")


def near_duplicates(rows: DataFrame, key: str = "pair_id", text: str = "text") -> DataFrame:
    """(key, kept) of every text with words. Equal word sets are settled before the rounds, so a hot text takes one row of them."""
    hashes = rows.select(key, token_hashes(F.col(text)).alias("t"), text).where("size(t) > 0")
    tokens = hashes.select(key, F.xxhash64("t").alias("set"), text)
    first = cut(tokens.groupBy("set").agg(F.min(key).alias(key), F.min_by(text, key).alias(text)))
    settled = independent(bands(first, key, text), BANDS).withColumnRenamed("id", key)
    copies = tokens.select(key).join(first.select(key), key, "left_anti").withColumn("kept", F.lit(False))
    return settled.unionAll(copies)


def jaccard_pairs(rows: DataFrame, key: str = "pair_id", text: str = "text", threshold: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): texts of equal word sets as classes (key, class, the class's first key), and all pairs of classes
    whose word sets have a Jaccard similarity of at least the threshold.

    Exact: word sets that similar share k of the n - ceil(threshold * n) + k rarest words of each. Sets of up to PAIRED words
    meet by pairs of these words (k = 2), so that no single word, however common, makes a group; longer ones by single words
    (k = 1), of which they have rare ones. The candidates found by that are counted word by word. Sets of one word are equal or
    have nothing in common; a threshold of at most a half would let sets of two words share one.
    """
    if not 0.5 < threshold <= 1:
        raise ValueError("threshold must be above 0.5")
    sets = rows.where(F.col(text).isNotNull()).select(key, F.array_sort(F.array_distinct(T.words(T.normalized(F.col(text))))).alias("w")).where("size(w) > 0")
    members = cut(sets.select(key, F.md5(F.array_join("w", " ")).alias("d"), "w"))
    classes = cut(members.groupBy("d").agg(F.min(key).alias("class"), F.first("w").alias("w")).select("class", "w"))
    frequency = classes.select(F.explode("w").alias("x")).groupBy("x").agg(F.count("*").alias("f"))
    ranked = classes.select("class", F.explode("w").alias("x")).join(frequency, "x").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("f", "x"))).alias("r"))
    n = F.size("r")
    least = F.ceil(F.round(n * threshold, 9)).cast("int")
    first_of = lambda k: F.transform(F.slice("r", F.lit(1), n - least + k), lambda p: p["x"])
    two = F.flatten(F.transform(first_of(2), lambda u, i: F.transform(F.slice(first_of(2), i + 2, n), lambda v: F.struct(u.alias("u"), v.alias("v")))))
    one = F.transform(first_of(1), lambda u: F.struct(u.alias("u"), F.lit("").alias("v")))
    none = F.slice(one, 1, 0)
    keys = F.concat(F.when((n > 1) & (n <= PAIRED), two).otherwise(none), F.when(n > PAIRED * threshold, one).otherwise(none))
    prefix = ranked.select("class", n.alias("n"), F.explode(keys).alias("x"))
    a, b = prefix.select(F.col("class").alias("a"), F.col("n").alias("na"), "x"), prefix.select(F.col("class").alias("b"), F.col("n").alias("nb"), "x")
    near = a.join(b, "x").where((F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.round(F.greatest("na", "nb") * threshold, 9))).select("a", "b").distinct()
    wa, wb = classes.select(F.col("class").alias("a"), F.col("w").alias("wa")), classes.select(F.col("class").alias("b"), F.col("w").alias("wb"))
    common = F.size(F.array_intersect("wa", "wb"))
    pairs = near.join(wa, "a").join(wb, "b").select("a", "b", (common / (F.size("wa") + F.size("wb") - common)).alias("jaccard")).where(F.col("jaccard") >= threshold)
    first = members.groupBy("d").agg(F.min(key).alias("class"))
    return members.select(key, "d").join(first, "d").select(key, "class"), pairs
