"""Corpus metrics of translations, one reference each: BLEU, chrF, TER.

Sums of matches are taken over all rows of a group before any ratio, as the metrics are defined on corpora. Definitions:
BLEU of Papineni et al. 2002 with the 13a tokens and exponential smoothing of Post 2018, chrF of Popovic 2015 (orders 1
to 6, beta 2, white space left out), TER of Snover et al. 2006 (greedy block shifts). A null text counts as empty.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.functions import text as T

MAX_ORDER, CHAR_ORDER, BETA = 4, 6, 2.0
# The replacements of 13a tokenization, in order.
TOKENIZE_13A = (
    ("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
)
SPACING_13A = (("([\\{-\\~\\[-\\` -\\&\\(-\\+\\:-\\@\\/])", " $1 "), ("([^0-9])([\\.,])", "$1 $2 "), ("([\\.,])([^0-9])", " $1 $2"), ("([0-9])(-)", "$1 $2 "))


def tokens_13a(t: Column) -> Column:
    out = F.coalesce(t, F.lit(""))
    for a, b in TOKENIZE_13A:
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.concat(F.lit(" "), out, F.lit(" "))
    for a, b in SPACING_13A:
        out = F.regexp_replace(out, a, b)
    return T.words(out)


def _ngrams(tokens: Column, n: int) -> Column:
    """Runs of n tokens as strings."""
    grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), "\x01"))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def _clipped(hyp: Column, ref: Column) -> Column:
    """Occurrences of the grams of hyp that ref has too, each at most as often as in ref."""
    times = lambda xs, g: F.size(F.filter(xs, lambda x: x == g))
    return F.aggregate(F.array_distinct(F.array_intersect(hyp, ref)), F.lit(0), lambda acc, g: acc + F.least(times(hyp, g), times(ref, g)))


def bleu(rows: DataFrame, by: list[str], prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """(by, bleu, p1..p4, brevity, hyp_len, ref_len) of each group; n-gram precisions in percent, 0 where there are none."""
    base = rows.select(*by, tokens_13a(F.col(prediction)).alias("h"), tokens_13a(F.col(reference)).alias("r"))
    for n in range(1, MAX_ORDER + 1):
        base = base.withColumn(f"h{n}", _ngrams(F.col("h"), n)).withColumn(f"r{n}", _ngrams(F.col("r"), n))
    counts = base.select(
        *by, F.size("h").alias("hl"), F.size("r").alias("rl"),
        *[_clipped(F.col(f"h{n}"), F.col(f"r{n}")).alias(f"m{n}") for n in range(1, MAX_ORDER + 1)],
        *[F.size(f"h{n}").alias(f"t{n}") for n in range(1, MAX_ORDER + 1)],
    )
    sums = counts.groupBy(*by).agg(*[F.sum(c).cast("double").alias(c) for c in ["hl", "rl", *[f"{k}{n}" for n in range(1, MAX_ORDER + 1) for k in "mt"]]])
    return sums.select(*by, *bleu_columns())


def bleu_columns() -> list[Column]:
    """Score columns from sums m1..m4, t1..t4, hl, rl."""
    zeros = F.lit(0)
    precision = []
    for n in range(1, MAX_ORDER + 1):
        zeros = zeros + F.when((F.col(f"m{n}") == 0) & (F.col(f"t{n}") > 0), 1).otherwise(0)
        precision.append(F.when(F.col(f"t{n}") == 0, 0.0).when(F.col(f"m{n}") == 0, F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * F.col(f"t{n}"))).otherwise(F.col(f"m{n}") * 100.0 / F.col(f"t{n}")))
    brevity = F.when(F.col("hl") == 0, 0.0).when(F.col("hl") < F.col("rl"), F.exp(1 - F.col("rl") / F.col("hl"))).otherwise(1.0)
    # a group without a single matching word has no score to smooth
    some = (F.least(*[F.col(f"t{n}") for n in range(1, MAX_ORDER + 1)]) > 0) & (F.col("m1") > 0)
    score = F.when(some, brevity * F.exp(sum((F.log(p) for p in precision), F.lit(0.0)) / MAX_ORDER)).otherwise(0.0)
    return [score.alias("bleu"), *[p.alias(f"p{n}") for n, p in enumerate(precision, 1)], brevity.alias("brevity"), F.col("hl").cast("bigint").alias("hyp_len"), F.col("rl").cast("bigint").alias("ref_len")]


def chrf(rows: DataFrame, by: list[str], prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """(by, chrf) of each group."""
    names = [f"{k}{n}" for n in range(1, CHAR_ORDER + 1) for k in "hrm"]
    base = rows.select(*by, F.regexp_replace(F.coalesce(prediction, F.lit("")), f"{T.WS}+", "").alias("h"), F.regexp_replace(F.coalesce(reference, F.lit("")), f"{T.WS}+", "").alias("r"))
    types = dict(base.dtypes)

    def run(batches):
        for b in batches:
            columns = [[] for _ in names]
            for h, r in zip(b.column(len(by)).to_pylist(), b.column(len(by) + 1).to_pylist(), strict=True):
                k = 0
                for n in range(1, CHAR_ORDER + 1):
                    a = Counter(h[i : i + n] for i in range(len(h) - n + 1))
                    c = Counter(r[i : i + n] for i in range(len(r) - n + 1))
                    for v in (a.total(), c.total(), (a & c).total()):
                        columns[k].append(v)
                        k += 1
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(by))], *[pa.array(c, pa.int64()) for c in columns]], [*by, *names])

    counts = base.mapInArrow(run, ", ".join([*[f"`{c}` {types[c]}" for c in by], *[f"{n} bigint" for n in names]]))
    sums = counts.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names])
    used = [(F.col(f"h{n}") > 0) & (F.col(f"r{n}") > 0) for n in range(1, CHAR_ORDER + 1)]
    orders = sum((u.cast("int") for u in used), F.lit(0))
    mean = lambda k: F.try_divide(sum((F.when(u, F.col(f"m{n}") / F.col(f"{k}{n}")).otherwise(0.0) for n, u in enumerate(used, 1)), F.lit(0.0)), orders)
    p, r = mean("h"), mean("r")
    return sums.select(*by, F.coalesce(100.0 * (1 + BETA**2) * F.try_divide(p * r, BETA**2 * p + r), F.lit(0.0)).alias("chrf"))


def edits(hyp: list[str], ref: list[str]) -> int:
    """Words inserted, deleted or replaced between two lists."""
    row = list(range(len(ref) + 1))
    for i, x in enumerate(hyp, 1):
        new = [i]
        for j, y in enumerate(ref, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _wrong(hyp: list[str], ref: list[str]) -> tuple[list[bool], list[bool]]:
    """Which words of either list the cheapest edits touch."""
    table = [list(range(len(ref) + 1))]
    for i, x in enumerate(hyp, 1):
        last, new = table[-1], [i]
        for j, y in enumerate(ref, 1):
            new.append(min(last[j] + 1, new[j - 1] + 1, last[j - 1] + (x != y)))
        table.append(new)
    in_hyp, in_ref = [True] * len(hyp), [True] * len(ref)
    i, j = len(hyp), len(ref)
    while i and j:
        if hyp[i - 1] == ref[j - 1] and table[i][j] == table[i - 1][j - 1]:
            i, j = i - 1, j - 1
            in_hyp[i] = in_ref[j] = False
        elif table[i][j] == table[i - 1][j - 1] + 1:
            i, j = i - 1, j - 1
        elif table[i][j] == table[i - 1][j] + 1:
            i -= 1
        else:
            j -= 1
    return in_hyp, in_ref


def edits_with_shifts(hyp: list[str], ref: list[str], longest: int = 10, farthest: int = 50) -> int:
    """Edits, block shifts at one edit each: as long as moving a run of words that ref has elsewhere saves more edits than
    it costs, the best such move is made. Only runs that hold an error move, to places where ref has one."""
    shifts, now = 0, edits(hyp, ref)
    while now > 1 and set(hyp) & set(ref):
        best, best_hyp = now - 1, None  # a shift costs an edit, so it must save two
        bad_hyp, bad_ref = _wrong(hyp, ref)
        spots: dict[tuple, list[int]] = {}
        for n in range(1, longest + 1):
            for j in range(len(ref) - n + 1):
                if any(bad_ref[j : j + n]):
                    spots.setdefault(tuple(ref[j : j + n]), []).append(j)
        for i in range(len(hyp)):
            for n in range(1, min(longest, len(hyp) - i) + 1):
                run = tuple(hyp[i : i + n])
                if run not in spots or not any(bad_hyp[i : i + n]):
                    continue
                rest = hyp[:i] + hyp[i + n :]
                for j in spots[run]:
                    if j == i or abs(j - i) > farthest:
                        continue
                    at = min(j, len(rest))
                    moved = rest[:at] + list(run) + rest[at:]
                    cost = edits(moved, ref)
                    if cost < best:
                        best, best_hyp = cost, moved
        if best_hyp is None:
            break
        hyp, now, shifts = best_hyp, best, shifts + 1
    return shifts + now


def ter(rows: DataFrame, by: list[str], prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """(by, ter, wer) of each group on a scale of 100 by words of the reference; wer is without shifts. Null without any such word."""
    base = rows.select(*by, T.words(F.coalesce(prediction, F.lit(""))).alias("h"), T.words(F.coalesce(reference, F.lit(""))).alias("r"))
    types = dict(base.dtypes)

    def run(batches):
        for b in batches:
            hyps, refs = b.column(len(by)).to_pylist(), b.column(len(by) + 1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(by))], pa.array([edits_with_shifts(h, r) for h, r in zip(hyps, refs, strict=True)], pa.int64()), pa.array([edits(h, r) for h, r in zip(hyps, refs, strict=True)], pa.int64()), pa.array([len(r) for r in refs], pa.int64())],
                [*by, "edits", "plain", "words"],
            )

    counts = base.mapInArrow(run, ", ".join([*[f"`{c}` {types[c]}" for c in by], "edits bigint", "plain bigint", "words bigint"]))
    return counts.groupBy(*by).agg((100.0 * F.try_divide(F.sum("edits"), F.sum("words"))).alias("ter"), (100.0 * F.try_divide(F.sum("plain"), F.sum("words"))).alias("wer"))


def all_metrics(rows: DataFrame, by: list[str], comet: DataFrame | None = None) -> DataFrame:
    """BLEU, chrF, TER and, from a provider's (by, comet) rows, COMET of each group; a metric nobody provides is null."""
    out = bleu(rows, by).join(chrf(rows, by), by).join(ter(rows, by), by)
    return out.join(comet, by, "left") if comet is not None else out.withColumn("comet", F.lit(None).cast("double"))


def bleu_of(matches: list[int], totals: list[int], hyp_len: int, ref_len: int) -> float:
    """The same score from plain numbers, for results that are already summed."""
    if not matches[0] or min(totals) == 0 or not hyp_len:
        return 0.0
    logs, zeros = 0.0, 0
    for m, t in zip(matches, totals, strict=True):
        if m == 0:
            zeros += 1
            logs += math.log(100.0 / (2**zeros * t))
        else:
            logs += math.log(100.0 * m / t)
    return (math.exp(1 - ref_len / hyp_len) if hyp_len < ref_len else 1.0) * math.exp(logs / len(matches))
