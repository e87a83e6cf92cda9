"""Mixtures of sources by target weights: weighted fair queueing over token counts.

Each source's documents stand in shuffled order; a document's virtual finish time is the tokens of its source up to and
with it, divided by the source's weight, further copies following after a whole round. The documents whose time is not
after the instant at which the budget is used up make the mixture, sorted by time over all sources. Prefix sums go in
two levels, buckets of a source and documents of a bucket, so that no task holds a source.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.plans.runtime import cut

#: Folder of the public tokenizers' vocabularies, and the one that counts.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_multi_50k.tiktoken"
#: Documents of a bucket, about.
BUCKET_ROWS = 100_000
SEED = 42


@lru_cache(2)
def encoding(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_batches(path: str):
    """Arrow batches (doc_id, source, text) -> (doc_id, source, tokens)."""

    def run(batches):
        own = encoding(path)
        for b in batches:
            counts = [len(own.encode_ordinary(t.encode("utf-8", "replace").decode())) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts, pa.int64())], ["doc_id", "source", "tokens"])

    return run


def counted(documents: DataFrame, targets: DataFrame, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(doc_id, source, tokens) of the documents of sources that have a target; null and empty texts are left out."""
    docs = documents.select("doc_id", "source", "text").where("length(text) > 0").join(targets.select("source").distinct(), "source", "left_semi")
    return cut(docs.select("doc_id", "source", "text").mapInArrow(token_batches(path), "doc_id bigint, source string, tokens bigint"))


def instant(stock: dict[str, float], weight: dict[str, float], budget: float | None) -> float:
    """Virtual time at which the sources have given `budget` tokens, or, without a budget, at which the first one with any
    stock runs out; infinity if all stock is less than the budget. stock: tokens times allowed copies."""
    live = [s for s in stock if stock[s] > 0 and weight[s] > 0]
    if not live:
        return 0.0
    ends = sorted((stock[s] / weight[s], s) for s in live)
    if budget is None:
        return ends[0][0]
    given, rate, now = 0.0, sum(weight[s] for s in live), 0.0
    for end, s in ends:
        if given + rate * (end - now) >= budget:
            return now + (budget - given) / rate
        given, now = given + rate * (end - now), end
        rate -= weight[s]
    return float("inf")


def whole(tokens: DataFrame, targets: DataFrame) -> float:
    """Tokens of all documents whose source may be used: the budget at which the mixture is as large as what it is made from."""
    usable = targets.where("target_share > 0 and max_copies > 0").select("source").distinct()
    return float(tokens.join(F.broadcast(usable), "source", "left_semi").agg(F.sum("tokens")).first()[0] or 0)


def mixture(tokens: DataFrame, targets: DataFrame, budget: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(mixture, shares). tokens: doc_id, source, tokens; targets: source, target_share, max_copies, one row a source.

    mixture has doc_id, source, copy, tokens, finish, sorted by finish over all sources; shares has each target with the
    share reached. A target without documents reaches 0 and leaves its part to the others. Documents of equal hash are
    taken by doc_id; sources without a target and targets without a share or copies give nothing.
    """
    goal = {r.source: (float(r.target_share or 0), int(r.max_copies or 0)) for r in targets.where("source is not null").collect()}  # a row per target source
    sums = tokens.groupBy("source").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
    have = {r.source: (int(r.t), int(r.n)) for r in sums.collect() if r.source in goal}
    stop = instant({s: have[s][0] * goal[s][1] for s in have}, {s: goal[s][0] for s in have}, budget)
    plan = targets.sparkSession.createDataFrame([(s, *goal[s], have.get(s, (0, 0))[0]) for s in goal] or [("", 0.0, 0, 0)], "source string, share double, copies int, stock bigint")
    usable = plan.where("share > 0 and copies > 0")

    buckets = max(16, -(-max((n for _, n in have.values()), default=0) // BUCKET_ROWS))
    key = F.xxhash64(F.lit(SEED), "doc_id")
    placed = tokens.join(F.broadcast(usable), "source").withColumn("key", key).withColumn("bucket", F.pmod(F.shiftright("key", 20), F.lit(buckets)))
    base = placed.groupBy("source", "bucket").agg(F.sum("tokens").alias("sum"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = base.select("source", "bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    timed = placed.withColumn("upto", F.sum("tokens").over(inside)).join(base, ["source", "bucket"])
    copies = timed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    finish = ((F.col("copy") - 1) * F.col("stock") + F.col("before") + F.col("upto")) / F.col("share")
    mix = copies.withColumn("finish", finish).where(F.col("finish") <= stop).select("doc_id", "source", F.col("copy").cast("bigint").alias("copy"), "tokens", "finish")
    mix = cut(mix.orderBy("finish", "source", "doc_id", "copy"))
    used = mix.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"), F.max("copy").alias("most_copies"))
    every = F.sum("tokens").over(Window.partitionBy())  # over the few rows of the targets
    shares = plan.where("source <> ''").join(used, "source", "left").select(
        "source", F.col("share").alias("target_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.round(F.coalesce(F.try_divide("tokens", every), F.lit(0.0)), 6).alias("share_reached"),
    )
    return mix, shares
