"""Copies that differ only in formatting: rolling hashes of folded streams, then a skipping comparison.

Each line's two texts are hashed while skipped characters are passed over; lines with equal hashes meet their group's
first line, and two pointers compare the texts themselves. Lines whose hashes collide with another text's are grouped
again by a digest of the folded stream. A hot group is dealt out over several tasks.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.plans.runtime import cut

from .streams import mix, same_streams, tables, text_hashes

#: Rows of a group that a task takes at least, and larger groups at most, which are broadcast.
HOT_ROWS, HOT_GROUPS = 100_000, 10_000
HASHED = "line_id bigint, h1 bigint, h2 bigint, kor_Hang string, vie_Latn string"


def _no_json(name: str):
    raise ValueError(f"{name} is no JSON")


def parse(line: str | None) -> tuple[str, str] | None:
    """The two texts of a line; None for a line that is no JSON object or lacks one of them."""
    try:
        pair = json.loads(line, parse_constant=_no_json)["translation"]
        ko, vi = pair["kor_Hang"], pair["vie_Latn"]
    except (ValueError, KeyError, TypeError, RecursionError):
        return None
    return (ko, vi) if isinstance(ko, str) and isinstance(vi, str) else None


def hash_batches(bits: int = 64):
    """Arrow batches (line_id, line) -> HASHED rows. Texts with nothing but skipped characters are unusable. Fewer bits force collisions, for tests."""
    drop = np.uint64(64 - bits)

    def run(batches):
        for b in batches:
            ids, ko, vi = [], [], []
            for i, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if pair := parse(line):
                    ids.append(i)
                    ko.append(pair[0].encode("utf-8", "replace").decode())
                    vi.append(pair[1].encode("utf-8", "replace").decode())
            k1, k2, kn = text_hashes(ko)
            v1, v2, vn = text_hashes(vi)
            h1 = mix(k1 * np.uint64(31) + v1) >> drop
            h2 = mix(k2 * np.uint64(37) + v2) >> drop
            keep = (kn > 0) & (vn > 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(ko, pa.string()), pa.array(vi, pa.string())], ["line_id", "h1", "h2", "kor_Hang", "vie_Latn"]).filter(pa.array(keep))

    return run


def _digest(ko: str, vi: str) -> str:
    fold, _, _ = tables()
    h = hashlib.sha256()
    for t in (ko, vi):
        code = fold[np.frombuffer(t.encode("utf-32-le"), np.uint32)]
        h.update(code[code != 0].tobytes() + b"\xff\xff\xff\xff")
    return h.hexdigest()


def verify_batches(batches):
    """Arrow batches (line_id, first, h1, h2, ko, vi, first ko, first vi) -> (line_id, first, h1, h2, digest); digest is null for true copies."""
    for b in batches:
        ko, vi, ko1, vi1 = (b.column(i).to_pylist() for i in range(4, 8))
        same = same_streams(ko, ko1) & same_streams(vi, vi1)
        digest = [None if s else _digest(k, v) for s, k, v in zip(same, ko, vi, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(digest, pa.string())], ["line_id", "first", "h1", "h2", "digest"])


def hashed_lines(lines: DataFrame, bits: int = 64) -> DataFrame:
    """HASHED rows of the usable lines, computed once."""
    return cut(lines.select("line_id", "line").where("line is not null").mapInArrow(hash_batches(bits), HASHED))


def copies(rows: DataFrame) -> DataFrame:
    """(first_line_id, line_id) of every line of a group but its first, from HASHED rows."""
    groups = cut(rows.groupBy("h1", "h2").agg(F.min("line_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    limit = max(HOT_ROWS, rows.count() // HOT_GROUPS)
    hot = groups.where(F.col("n") > limit).select("h1", "h2", F.ceil(F.col("n") / limit).cast("int").alias("parts"))
    parted = groups.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    firsts = rows.select("line_id", F.col("kor_Hang").alias("ko1"), F.col("vie_Latn").alias("vi1")).join(parted.select(F.col("first").alias("line_id"), "h1", "h2", "parts"), "line_id")
    firsts = firsts.select("h1", "h2", F.col("line_id").alias("first"), "ko1", "vi1", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = rows.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("part", F.pmod(F.xxhash64("line_id"), F.coalesce("parts", F.lit(1))).cast("int"))
    met = dealt.join(firsts, ["h1", "h2", "part"]).where("line_id <> first")
    seen = cut(met.select("line_id", "first", "h1", "h2", "kor_Hang", "vie_Latn", "ko1", "vi1").mapInArrow(verify_batches, "line_id bigint, first bigint, h1 bigint, h2 bigint, digest string"))
    true = seen.where("digest is null").select(F.col("first").alias("first_line_id"), "line_id")
    other = seen.where("digest is not null")
    again = other.groupBy("h1", "h2", "digest").agg(F.min("line_id").alias("first_line_id"))
    return true.unionAll(other.join(again, ["h1", "h2", "digest"]).where("line_id <> first_line_id").select("first_line_id", "line_id"))


def records(rows: DataFrame) -> DataFrame:
    """One record per pair: its first line's texts and the number of lines that hold it."""
    pairs = cut(copies(rows))
    count = pairs.groupBy(F.col("first_line_id").alias("line_id")).agg((F.count("*") + 1).alias("copies"))
    kept = rows.join(pairs.select("line_id"), "line_id", "left_anti").join(count, "line_id", "left")
    return kept.select("line_id", "kor_Hang", "vie_Latn", F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies"))
