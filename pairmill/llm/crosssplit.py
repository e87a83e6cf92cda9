"""Rows of evaluation splits that recur in training, exactly or almost.

A text's fingerprint is a long bit code in which each word, with the number of its occurrence, sets one bit. The bits are
permuted so that those of rare words come first; the blocks by which codes of two splits are joined are the pairs of the
first set bits (beyond 120 words, single bits). Texts of which at most a sixth of the words differ share five sixths of
their bits, so of the first n - ceil(5 n / 6) + k set bits of each they have k in common, and none is missed whatever the
permutation. The codes folded to BITS bits, where words cancel out, differ in as many bits at most as the words do: pairs
beyond this Hamming radius go. The others, and pairs of equal folded streams, are verified on their words. Equal texts of
a split go through all this once, as a class, and are expanded at the end.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.plans.runtime import cut

from .streams import mix, text_hashes, words

BITS = 256
#: Words up to which texts meet by pairs of words; buckets of the counts that put words in order.
PAIRED, BUCKETS = 120, 1 << 16
#: Rows of one text that a task takes at least, and texts of more rows at most, which are broadcast.
HOT_ROWS, HOT_TEXTS = 100_000, 10_000
#: Most of a text's words that may be changed, dropped, added or moved.
CHANGED = 1 / 6
HASHED = "split string, pair_no bigint, source string, h1 bigint, h2 bigint, c0 bigint, c1 bigint, c2 bigint, c3 bigint, n bigint, keys array<bigint>, text string"


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with the number of its occurrence in its text, so that a change of a repeated word moves one
    feature, and where each text's features begin."""
    h, starts, _, _ = words(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    order = np.lexsort((h, owner))
    hs, os = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (os[1:] != os[:-1])
    place = np.arange(len(h))
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    out = np.empty_like(h)
    out[order] = mix(hs + mix(nth.astype(np.uint64)))
    return out, starts


def _bucket(f: np.ndarray) -> np.ndarray:
    return (f % np.uint64(BUCKETS)).astype(np.int64)


def count_batches(batches):
    """Arrow batches (text) -> (bucket, n): how many features fall into each bucket."""
    for b in batches:
        u, n = np.unique(_bucket(features(b.column(0).to_pylist())[0]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n.astype(np.int64))], ["bucket", "n"])


def keys_of(f: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Keys of each text, of which texts near enough have one in common. counts: of each bucket; any will do, those of the texts are quick.

    Texts of fewer than 5 words are near to equal ones only.
    """
    size = np.diff(starts)
    owner = np.repeat(np.arange(len(size)), size)
    f = f[np.lexsort((f, counts[_bucket(f)], owner))]
    out = [np.zeros(0, np.uint64)] * len(size)
    for n in np.unique(size[size >= 5]).tolist():
        rows = np.flatnonzero(size == n)
        first = n - -(-5 * n // 6) + 2
        x = f[starts[rows][:, None] + np.arange(first)]
        parts = []
        if n <= PAIRED:
            i, j = np.triu_indices(first, 1)
            parts.append(mix(x[:, i] + mix(x[:, j])))
        if 6 * n > 5 * PAIRED:  # the other text may have more than PAIRED words
            parts.append(x[:, : first - 1])
        for row, key in zip(rows.tolist(), np.concatenate(parts, 1), strict=True):
            out[row] = key
    return out


def bitmaps(f: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """BITS bits of each text, each feature flips one: two texts' bits differ in as many places at most as their features."""
    size = np.diff(starts)
    owner = np.repeat(np.arange(len(size)), size)
    flips = np.bincount(owner * BITS + (f >> np.uint64(40)).astype(np.int64) % BITS, minlength=len(size) * BITS).reshape(-1, BITS)
    return np.packbits((flips & 1).astype(np.uint8), axis=1).view(np.int64).reshape(-1, BITS // 64)


def hash_batches(counts: np.ndarray):
    """Arrow batches (split, pair_no, source, text) -> HASHED rows; texts without a letter, digit or symbol are left out."""

    def run(batches):
        for b in batches:
            texts = b.column(3).to_pylist()
            h1, h2, size = text_hashes(texts)
            for at in range(0, len(texts), 2000):
                rows = np.arange(at, min(at + 2000, len(texts)))
                rows = rows[size[rows] > 0]
                if not len(rows):
                    continue
                f, starts = features([texts[i] for i in rows])
                code, keys = bitmaps(f, starts), keys_of(f, starts, counts)
                take = pa.array(rows)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(k) for k in keys])], pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), b.column(2).take(take), pa.array(h1[rows].view(np.int64)), pa.array(h2[rows].view(np.int64)), *[pa.array(np.ascontiguousarray(code[:, k])) for k in range(4)], pa.array(np.diff(starts)), lists, b.column(3).take(take)],
                    ["split", "pair_no", "source", "h1", "h2", "c0", "c1", "c2", "c3", "n", "keys", "text"],
                )

    return run


def changes(a: list, b: list) -> int:
    """Words changed, dropped, added or moved between two word lists."""
    common = sum((Counter(a) & Counter(b)).values())
    return max(len(a), len(b)) - common + (common - in_order(a, b))


def in_order(a: list, b: list) -> int:
    """Length of the longest common subsequence, a bit for each word of a."""
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & at.get(y, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def verify_batches(batches):
    """Arrow batches (eh1, eh2, th1, th2, evaluation text, training text) -> the pairs that are near enough."""
    for b in batches:
        texts = b.column(4).to_pylist() + b.column(5).to_pylist()
        h, starts, _, _ = words(texts)
        lists = [h[starts[i] : starts[i + 1]].tolist() for i in range(len(texts))]
        n = b.num_rows
        good = []
        for i in range(n):
            same = b.column(0)[i] == b.column(2)[i] and b.column(1)[i] == b.column(3)[i]
            x, y = lists[i], lists[n + i]
            most = max(len(x), len(y)) * CHANGED
            # the cheap part of `changes` first: words that can't be matched
            good.append(same or (max(len(x), len(y)) - sum((Counter(x) & Counter(y)).values()) <= most and changes(x, y) <= most))
        yield pa.RecordBatch.from_arrays([b.column(k) for k in range(4)], ["eh1", "eh2", "th1", "th2"]).filter(pa.array(good, pa.bool_()))


def _texts(split: DataFrame, name: str) -> DataFrame:
    both = F.array("kor_Hang", "vie_Latn")
    return split.select(F.lit(name).alias("split"), "pair_no", "source", F.explode(both).alias("text")).where("text is not null")


def overlaps(train: DataFrame, evals: dict[str, DataFrame]) -> DataFrame:
    """(split, eval_id, eval_source, train_id, train_source) of every overlapping pair of rows; tables have pair_no, kor_Hang, vie_Latn, source.

    Either text of one row may match either text of the other. Null and empty texts match nothing; ties and repeated
    rows come out once for each pair of pair_no.
    """
    rows = None
    for name, df in evals.items():
        rows = _texts(df, name) if rows is None else rows.unionAll(_texts(df, name))
    counts = np.zeros(BUCKETS, np.int64)
    for r in _texts(train, "train").select("text").mapInArrow(count_batches, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_batches():  # BUCKETS rows at most
        counts[r.column(0).to_numpy()] = r.column(1).to_numpy()
    t = cut(_texts(train, "train").mapInArrow(hash_batches(counts), HASHED))
    e = cut(rows.mapInArrow(hash_batches(counts), HASHED))

    def classes(df: DataFrame, p: str) -> DataFrame:
        one = df.groupBy("h1", "h2").agg(F.min_by(F.struct("c0", "c1", "c2", "c3", "n", "keys", "text"), "pair_no").alias("r"), F.count("*").alias("rows"))
        folded = F.col("r.c0").bitwiseXOR(F.col("r.c1")).bitwiseXOR(F.col("r.c2")).bitwiseXOR(F.col("r.c3"))
        return one.select(
            F.col("h1").alias(f"{p}h1"), F.col("h2").alias(f"{p}h2"), *[F.col(f"r.c{k}").alias(f"{p}{k}") for k in range(4)], folded.alias(f"{p}c"),
            F.col("r.n").alias(f"{p}n"), F.col("r.keys").alias(f"{p}keys"), F.col("r.text").alias(f"{p}text"), F.col("rows").alias(f"{p}rows"),
        )

    ec, tc = cut(classes(e, "e")), cut(classes(t, "t"))
    # a quarter of the code, folded once more, goes through the join, the whole code comes with the text
    left = ec.select("eh1", "eh2", "ec", "en", F.explode("ekeys").alias("key"))
    right = tc.select("th1", "th2", "tc", "tn", F.explode("tkeys").alias("key"))
    # of the features of both, five sixths of the longer text's are shared at least
    radius = F.col("en") + F.col("tn") - 2 * F.ceil(5 * F.greatest("en", "tn") / 6)
    # explode makes either side larger than Spark estimates, so it must not pick a broadcast
    near = left.hint("merge").join(right, "key").where(F.bit_count(F.col("ec").bitwiseXOR(F.col("tc"))) <= radius).select("eh1", "eh2", "th1", "th2")
    equal = ec.join(tc, (F.col("eh1") == F.col("th1")) & (F.col("eh2") == F.col("th2"))).select("eh1", "eh2", "th1", "th2")
    candidates = near.unionAll(equal).distinct()
    apart = sum((F.bit_count(F.col(f"e{k}").bitwiseXOR(F.col(f"t{k}"))) for k in range(4)), F.lit(0))
    same = (F.col("eh1") == F.col("th1")) & (F.col("eh2") == F.col("th2"))
    texts = candidates.join(ec.drop("ekeys", "ec"), ["eh1", "eh2"]).join(tc.drop("tkeys", "tc"), ["th1", "th2"]).where(same | (apart <= radius))
    pairs = cut(texts.select("eh1", "eh2", "th1", "th2", "etext", "ttext").mapInArrow(verify_batches, "eh1 bigint, eh2 bigint, th1 bigint, th2 bigint"))
    both = _members(_members(pairs, ec, e, "e", "eval"), tc, t, "t", "train")
    return both.select("split", "eval_id", "eval_source", "train_id", "train_source").dropDuplicates(["split", "eval_id", "train_id"])


def _members(pairs: DataFrame, classes: DataFrame, rows: DataFrame, p: str, name: str) -> DataFrame:
    """Pairs of classes with each row of the class `p`. A text may stand in a third of a split's rows: the rows of such a
    class are dealt out, and its pairs meet every part."""
    key = [f"{p}h1", f"{p}h2"]
    limit = max(HOT_ROWS, (classes.agg(F.sum(f"{p}rows")).first()[0] or 0) // HOT_TEXTS)
    hot = classes.where(F.col(f"{p}rows") > limit).select(*key, F.ceil(F.col(f"{p}rows") / limit).cast("int").alias("parts"))
    members = rows.select(F.col("h1").alias(key[0]), F.col("h2").alias(key[1]), *["split"] * (p == "e"), F.col("pair_no").alias(f"{name}_id"), F.col("source").alias(f"{name}_source"))
    if hot.isEmpty():
        return pairs.join(members, key)
    parts = F.coalesce("parts", F.lit(1))
    members = members.join(F.broadcast(hot), key, "left").withColumn("part", F.pmod(F.xxhash64(f"{name}_id"), parts).cast("int")).drop("parts")
    pairs = pairs.join(F.broadcast(hot), key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return pairs.join(members, [*key, "part"]).drop("part")


def counts(found: DataFrame) -> DataFrame:
    """Overlaps by split and the two sources: pairs of rows, evaluation rows and training rows among them."""
    return found.groupBy("split", "eval_source", "train_source").agg(F.count("*").alias("pairs"), F.countDistinct("eval_id").alias("eval_rows"), F.countDistinct("train_id").alias("train_rows"))
