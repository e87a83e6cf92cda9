"""Repetition inside documents, by n-gram models with modified Kneser-Ney discounts.

A language's bigrams are counted by Spark over the whole corpus and interpolated down to its words; what is frequent
enough lies in sorted hash arrays, the rest is joined. On top of it every document is modelled as it is read: its runs of
ORDER words, with discounts of the language. A run seen before makes its last word cheaper, by so many bits; what a
repeated run saves at least and at most in a document, over all documents of a language, gives the language's two bands of
perplexity. At or below the lower band a document repeats enough, above the upper band it doesn't; in between its repeated
words are counted. No band can be wrong (see `bands`). The trigram model further below gives the perplexity of documents
among all others, with a band on both sides.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.plans.runtime import cut

from .langid import label_language
from .streams import codes, mix, ngrams, words

ORDER = 5
#: Share of repeated words of a case.
REPEATED = 0.4
#: Letters that make a run in a script written without spaces, where words can't be told.
LETTERS = 2 * ORDER
#: N-grams with more than this part of all occurrences are looked up in every task, so there are at most HOT of an order.
HOT = 50_000

_UNSPACED = ((0x3040, 0x3100), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x20000, 0x30000))
_LETTER = re.compile("[" + "".join(f"{chr(lo)}-{chr(hi - 1)}" for lo, hi in _UNSPACED) + "]")


def unspaced(texts: list[str]) -> np.ndarray:
    """Whether at least a third of a text's characters belong to scripts written without spaces."""
    code, offsets = codes(texts)
    hit = np.zeros(len(code), np.int64)
    for lo, hi in _UNSPACED:
        hit += (code >= lo) & (code < hi)
    total = np.r_[0, np.cumsum(hit)]
    return (total[offsets[1:]] - total[offsets[:-1]]) * 3 >= np.maximum(np.diff(offsets), 1)


@lru_cache(64)
def _salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.sha256(lang.encode()).digest()[:8], "little"))


def _salts(langs: list[str]) -> np.ndarray:
    return np.array([_salt(x) for x in langs], np.uint64)


def _earlier(keys: np.ndarray, amount: np.ndarray | None = None) -> np.ndarray:
    """How often each key stands before its place, or what its earlier places amount to."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.r_[True, k[1:] != k[:-1]][: len(k)]
    sums = np.arange(len(k)) if amount is None else np.r_[0, np.cumsum(amount[order])[:-1]][: len(k)]
    out = np.empty(len(k), sums.dtype)
    out[order] = sums - sums[np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))]
    return out


def _covered(starts: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Share of each text's words that lie in one of the runs of n words that begin at `at`."""
    edge = np.zeros(int(starts[-1]) + n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    total = np.r_[0, np.cumsum(np.cumsum(edge)[: int(starts[-1])] > 0)]
    return (total[starts[1:]] - total[starts[:-1]]) / np.maximum(np.diff(starts), 1)


def letter_share(texts: list[str]) -> np.ndarray:
    """Share of each text in runs of LETTERS that occurred earlier in it; what isn't of an unspaced script counts by words."""
    h, starts, _, _ = words([_LETTER.sub(r" \g<0> ", x) for x in texts])
    grams, at = ngrams(h, starts, LETTERS)
    text = np.searchsorted(starts, at, side="right") - 1
    return _covered(starts, at[_earlier(grams ^ mix(text.astype(np.uint64))) > 0], LETTERS)


def own_runs(texts: list[str]):
    """(words of all texts, where each text's begin, text of each run, its first word, key of the run and of its context in its text)."""
    h, starts, _, _ = words(texts)
    grams, at = ngrams(h, starts, ORDER)
    text = np.searchsorted(starts, at, side="right") - 1
    salt = mix(text.astype(np.uint64))
    context, where = ngrams(h, starts, ORDER - 1)
    mine = context[np.searchsorted(where, at)] ^ salt if len(at) else grams
    return h, starts, text, at, grams ^ salt, mine


def counts_batches(batches):
    """Arrow batches (doc_id, lang, text) -> (lang, n1, n2, n3, n4): how many runs occur once, twice, ... in their document."""
    for b in batches:
        langs = b.column(1).to_pylist()
        _, _, text, _, run, _ = own_runs(b.column(2).to_pylist())
        _, first, count = np.unique(run, return_index=True, return_counts=True)
        names = sorted({x for x in langs})
        number = np.array([names.index(x) for x in langs], np.int64)
        table = np.stack([np.bincount(number[text[first[count == k]]], minlength=len(names)) for k in range(1, 5)], 1) if len(names) else np.zeros((0, 4), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array(table[:, k].astype(np.int64)) for k in range(4)]], ["lang", "n1", "n2", "n3", "n4"])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and above, kept inside (0, count); the usual ones where counts of counts are missing."""
    if not (n1 and n2):
        return 0.9, 1.3, 1.6
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.6
    return min(max(d1, 0.05), 0.98), min(max(d2, 0.1), 1.6), min(max(d3, 0.1), 1.9)


def own_discounts(d: tuple[float, float, float]) -> tuple[float, float, float]:
    """Discounts of a language kept where a run seen before costs less than one that isn't."""
    return max(d[0], 0.5), min(d[1], 1.4), min(d[2], 1.8)


@dataclass
class Corpus:
    """Interpolated probability of the frequent bigrams of all languages, by sorted keys."""

    keys: np.ndarray
    values: np.ndarray

    def find(self, pair: np.ndarray) -> np.ndarray:
        """Probability of the last word of each pair, NaN where the pair isn't held."""
        if not len(self.keys):
            return np.full(len(pair), np.nan)
        place = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[place] == pair, self.values[place], np.nan)

    def probability(self, before: np.ndarray, word: np.ndarray, lang: np.ndarray, langs: list[str]) -> np.ndarray:
        """Of each word after the one before it; `lang` numbers the languages of `langs`."""
        return self.find(_pair(before, word, _salts(langs)[lang]))


def _pair(before: np.ndarray, word: np.ndarray, salt: np.ndarray) -> np.ndarray:
    return mix(mix(before ^ salt) + word)


def bigram_batches(batches):
    """Arrow batches (doc_id, lang, text) -> (lang, pair, before, word, n): bigrams of a batch, keys salted by language."""
    for b in batches:
        langs = sorted(set(b.column(1).to_pylist()))
        number = {x: i for i, x in enumerate(langs)}
        h, starts, _, _ = words(b.column(2).to_pylist())
        lang = np.repeat(np.array([number[x] for x in b.column(1).to_pylist()], np.int64), np.diff(starts))
        at = np.flatnonzero(np.r_[np.repeat(np.arange(len(starts) - 1), np.diff(starts)), -1][1:] == np.repeat(np.arange(len(starts) - 1), np.diff(starts))) if len(h) else np.zeros(0, np.int64)
        salt = _salts(langs)[lang[at]] if len(at) else np.zeros(0, np.uint64)
        u, first, n = np.unique(_pair(h[at], h[at + 1], salt) if len(at) else salt, return_index=True, return_counts=True)
        at, salt = at[first], salt[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array([langs[i] for i in lang[at].tolist()], pa.string()), *[pa.array(x.view(np.int64)) for x in (u, mix(h[at] ^ salt), mix((h[at + 1] if len(at) else salt) ^ salt))], pa.array(n.astype(np.int64))],
            ["lang", "pair", "before", "word", "n"],
        )


def bigram_model(docs: DataFrame) -> DataFrame:
    """(pair, hot, p) of every bigram of (doc_id, lang, text): modified Kneser-Ney of each language, counted over all of it and
    interpolated to the words; hot are those with more than 1 / HOT of all occurrences."""
    two = cut(docs.mapInArrow(bigram_batches, "lang string, pair bigint, before bigint, word bigint, n bigint").groupBy("lang", "pair").agg(F.first("before").alias("before"), F.first("word").alias("word"), F.sum("n").alias("n")))
    one = cut(two.groupBy("lang", "word").agg(F.count("*").alias("n")))

    def sums(df: DataFrame) -> dict:
        return {r.lang: r for r in df.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("v"), *[F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)]).collect()}  # a row per language

    of_two, of_one = sums(two), sums(one)
    rows = []
    for x, t in of_two.items():
        o = of_one[x]
        b = discounts(o.n1, o.n2, o.n3, o.n4)
        left = b[0] * o.n1 + b[1] * o.n2 + b[2] * (o.v - o.n1 - o.n2)
        rows.append((x, *discounts(t.n1, t.n2, t.n3, t.n4), *b, float(o.total), left / o.total / o.v))
    d = F.broadcast(docs.sparkSession.createDataFrame(rows, "lang string, a1 double, a2 double, a3 double, b1 double, b2 double, b3 double, total double, least double"))
    cost = lambda p: F.when(F.col("n") == 1, F.col(f"{p}1")).when(F.col("n") == 2, F.col(f"{p}2")).otherwise(F.col(f"{p}3"))
    hot = F.col("n") * HOT > sum(r.total for r in of_two.values())
    p1 = one.join(d, "lang").select("word", ((F.col("n") - cost("b")) / F.col("total") + F.col("least")).alias("p1"))
    mine = two.join(d, "lang").select("pair", "before", "word", "n", cost("a").alias("cost"))
    after = mine.groupBy("before").agg(F.sum("n").alias("t"), F.sum("cost").alias("left"))
    return cut(mine.join(p1, "word").join(after, "before").select("pair", hot.alias("hot"), ((F.col("n") - F.col("cost") + F.col("left") * F.col("p1")) / F.col("t")).alias("p")))


def held(model: DataFrame) -> Corpus:
    """The hot bigrams of a model, at most HOT."""
    got = model.where("hot").select("pair", "p").toPandas()
    keys = got["pair"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Corpus(keys[order], got["p"].to_numpy(float)[order])


def corpus_model(docs: DataFrame) -> Corpus:
    """Modified Kneser-Ney bigrams of each language of (doc_id, lang, text) that are hot."""
    return held(bigram_model(docs))


SCORES = (
    "doc_id bigint, lang string, words bigint, runs bigint, again bigint, bits double, saved double, repeated_share double, repeated_content double, "
    "rare array<bigint>, rare_again array<bigint>, part array<double>, extra array<double>"
)


def score_batches(d_of: dict[str, tuple[float, float, float]], corpus: Corpus, whole: bool = True):
    """Arrow batches (doc_id, lang, text) -> SCORES: bits of the words that end a run, and the bits they would cost more had no run
    been seen before; the share of repeated words is null for unspaced scripts only, 0 for a text of fewer words than a run has,
    that of repeated content is null for none.

    Bigrams that the corpus doesn't hold are handed on: `rare` of runs not seen before, whose bits lack log2 of the bigram's
    probability p, `rare_again` of the others, whose probability is part * p + extra and which count nowhere yet. Without
    `whole` bits are null and `rare` is empty, as it saves nothing.
    """

    def run(batches):
        for b in batches:
            texts, names = b.column(2).to_pylist(), b.column(1).to_pylist()
            langs = sorted(set(names))
            lang = np.searchsorted(np.array(langs), np.array(names)) if names else np.zeros(0, np.int64)
            h, starts, text, at, keys, context = own_runs(texts)
            seen, before = _earlier(keys), _earlier(context)
            d = np.array([(0.0, *d_of[x]) for x in langs]).reshape(-1, 4)[lang[text]] if len(at) else np.zeros((0, 4))
            row = np.arange(len(at))
            mine, after = d[row, np.minimum(seen, 3)], d[row, np.minimum(seen + 1, 3)]
            left = _earlier(context, after - mine)  # discounts of all runs seen with this context
            pair = _pair(h[at + ORDER - 2], h[at + ORDER - 1], _salts(langs)[lang[text]]) if len(at) else h[:0]
            base = corpus.find(pair)
            part = np.where(before > 0, left / np.maximum(before, 1), 1.0)
            again = seen > 0
            extra = np.where(again, (seen - mine) / np.maximum(before, 1), 0.0)
            rare = np.isnan(base)
            low = part * np.where(rare, 1.0, base)
            late = rare & again
            per = lambda x: np.bincount(text, x, minlength=len(texts)).astype(float)  # noqa: E731; whole numbers where no text has a run

            def lists(of, *values, text=text, size=len(texts)):
                ends = pa.array(np.r_[0, np.cumsum(np.bincount(text[of], minlength=size))].astype(np.int32))
                return [pa.ListArray.from_arrays(ends, pa.array(x[of])) for x in values]

            share, loose = _covered(starts, at[again], ORDER), unspaced(texts)
            content = share.copy()
            if loose.any():
                content[loose] = letter_share([x for x, y in zip(texts, loose, strict=True) if y])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(x.astype(np.int64)) for x in (np.diff(starts), np.bincount(text, minlength=len(texts)), per(again.astype(float)))],
                 pa.array(per(np.where(late, 0.0, -np.log2(low + extra))), mask=np.full(len(texts), not whole)), pa.array(per(np.where(late, 0.0, np.log2((low + extra) / low)))),
                 pa.array(share, mask=loose), pa.array(content), *lists(rare & ~again & whole, pair.view(np.int64)), *lists(late, pair.view(np.int64), part, extra)],
                ["doc_id", "lang", "words", "runs", "again", "bits", "saved", "repeated_share", "repeated_content", "rare", "rare_again", "part", "extra"],
            )

    return run


def scores(docs: DataFrame, whole: bool = True) -> DataFrame:
    """(doc_id, lang, words, runs, again, bits, saved, repeated_share, repeated_content) of each row of (doc_id, lang, text), see
    `score_batches`, over all bigrams of the corpus: hot ones are looked up, the others joined, none of which is in more than
    1 / HOT of the rows. Without `whole` bits are null."""
    sums = docs.mapInArrow(counts_batches, "lang string, n1 bigint, n2 bigint, n3 bigint, n4 bigint").groupBy("lang").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(1, 5)])
    d_of = {r.lang: own_discounts(discounts(r.n1, r.n2, r.n3, r.n4)) for r in sums.collect()}  # a row per language name known, and 'und'
    model = bigram_model(docs)
    first = cut(docs.mapInArrow(score_batches(d_of, held(model), whole), SCORES).withColumn("row", F.monotonically_increasing_id()))
    rare = first.select("row", F.inline(F.arrays_zip(F.col("rare_again").alias("pair"), "part", "extra")))
    if whole:
        rare = rare.unionAll(first.select("row", F.explode("rare").alias("pair"), F.lit(1.0).alias("part"), F.lit(0.0).alias("extra")))
    low = F.col("part") * F.col("p")
    late = rare.join(model.where("not hot").select("pair", "p"), "pair").groupBy("row").agg(F.sum(-F.log2(low + F.col("extra"))).alias("late_bits"), F.sum(F.log2(1 + F.try_divide("extra", low))).alias("late_saved"))
    both = lambda x: (F.col(x) + F.coalesce(f"late_{x}", F.lit(0.0))).alias(x)
    return cut(first.join(late, "row", "left").select("doc_id", "lang", "words", "runs", "again", both("bits"), both("saved"), "repeated_share", "repeated_content"))


def bands(scored: DataFrame) -> DataFrame:
    """(lang, least, most): bits a repeated run saves at least and at most, in the mean of a document, over all documents.

    A document whose words save REPEATED * most each has so many repeated runs as REPEATED of its words, and as many words
    begin one. One in which REPEATED of the words lie in repeated runs has REPEATED / ORDER of them as repeated runs at least,
    and saves REPEATED / ORDER * least a word.
    """
    each = F.try_divide("saved", "again")
    return scored.where("again > 0").groupBy("lang").agg((F.min(each) * (1 - 1e-9)).alias("least"), (F.max(each) * (1 + 1e-9)).alias("most"))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.where("text is not null").select("doc_id", F.coalesce(label_language(F.col("lang")), F.lit("und")).alias("lang"), "text")


def _judged(scored: DataFrame) -> DataFrame:
    """Scores with their language's `least` and `most` and the verdict of the bands."""
    placed = scored.join(F.broadcast(bands(scored)), "lang", "left")  # a row per language name known, and 'und'
    word = F.col("saved") / F.greatest("words", F.lit(1))
    live = (F.col("runs") > 0) & F.col("repeated_share").isNotNull() & F.col("least").isNotNull()
    return placed.withColumn("verdict", F.when(~live | (word < F.col("least") * (REPEATED / ORDER)), "above").when(word >= F.col("most") * REPEATED, "below").otherwise("counted"))


def repetition(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, words, self_perplexity, lower_band, upper_band, below_band, verdict, repeated_share, repeated_content) of
    every document.

    The bands are of perplexity, for the document's language and words. verdict: 'below' the lower band or at it, 'above' the
    upper band, else 'counted'; below_band tells that it isn't above. Null texts are left out; a text of fewer than ORDER words
    has no perplexity, is 'above' and repeats nothing; one in an unspaced script has no words to tell apart, is 'above' and has a
    null share of repeated words. repeated_content is that share, and in an unspaced script the share in repeated runs of LETTERS.
    Columns beside doc_id, lang and text are ignored.
    """
    perplexity = lambda bits: F.when(F.col("runs") > 0, F.round(F.pow(F.lit(2.0), F.try_divide(bits, F.col("runs"))), 6))
    upto = F.col("bits") + F.col("saved")
    return _judged(scores(_texts(documents))).select(
        "doc_id", "lang", "words", perplexity(F.col("bits")).alias("self_perplexity"), perplexity(upto - F.col("words") * F.col("most") * REPEATED).alias("lower_band"),
        perplexity(upto - F.col("words") * F.col("least") * (REPEATED / ORDER)).alias("upper_band"), "verdict", "repeated_share", "repeated_content",
    ).withColumn("below_band", F.col("verdict") != "above")


def repeating(documents: DataFrame) -> DataFrame:
    """doc_id of every document that repeats enough: below the lower band, or between the bands and REPEATED of its words counted."""
    return _judged(scores(_texts(documents), whole=False)).where((F.col("verdict") == "below") | ((F.col("verdict") == "counted") & (F.col("repeated_share") >= REPEATED))).select("doc_id").distinct()


# ---- the corpus model


def trigram_batches(batches):
    """Arrow batches (doc_id, lang, text) -> (h3, h12, h23, h2, h3w, n): trigrams of a batch, their parts and counts."""
    for b in batches:
        texts = b.column(2).to_pylist()
        h, starts, _, _ = words(texts)
        g3, at = ngrams(h, starts, 3)
        u, first, n = np.unique(g3, return_index=True, return_counts=True)
        at = at[first]
        g2, where = ngrams(h, starts, 2)
        head, tail = g2[np.searchsorted(where, at)], g2[np.searchsorted(where, at + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (u, head, tail, h[at + 1] if len(at) else u, h[at + 2] if len(at) else u, n.astype(np.uint64))], ["h3", "h12", "h23", "w2", "w3", "n"])


def kneser_ney(trigrams: DataFrame) -> DataFrame:
    """(h3, n, bits): modified Kneser-Ney cost of each trigram's last word, interpolated down to the vocabulary."""
    g3 = cut(trigrams.groupBy("h3").agg(F.first("h12").alias("h12"), F.first("h23").alias("h23"), F.first("w2").alias("w2"), F.first("w3").alias("w3"), F.sum("n").alias("n")))
    g2 = cut(g3.groupBy("h23").agg(F.first("w2").alias("w2"), F.first("w3").alias("w3"), F.count("*").alias("n")))
    g1 = cut(g2.groupBy("w3").agg(F.count("*").alias("n")))

    def d(df: DataFrame) -> tuple[float, float, float]:
        r = df.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)]).first()
        return discounts(*r)

    def cost(d_: tuple[float, float, float]):
        return F.when(F.col("n") == 1, d_[0]).when(F.col("n") == 2, d_[1]).otherwise(d_[2])

    d3, d2, d1 = d(g3), d(g2), d(g1)
    size = g1.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(cost(d1)).alias("left")).first()
    total, vocabulary, left = size.n or 1, size.v or 1, size.left or 0.0
    p1 = g1.select("w3", ((F.col("n") - cost(d1)) / total + left / total / vocabulary).alias("p1"))
    c1 = g2.groupBy("w2").agg(F.sum("n").alias("t"), F.sum(cost(d2)).alias("left"))
    p2 = g2.join(p1, "w3").join(c1, "w2").select("h23", ((F.col("n") - cost(d2)) / F.col("t") + F.col("left") / F.col("t") * F.col("p1")).alias("p2"))
    c2 = g3.groupBy("h12").agg(F.sum("n").alias("t"), F.sum(cost(d3)).alias("left"))
    return g3.join(p2, "h23").join(c2, "h12").select("h3", "n", (-F.log2((F.col("n") - cost(d3)) / F.col("t") + F.col("left") / F.col("t") * F.col("p2"))).alias("bits"))


def lookup_batches(hot_keys: np.ndarray, hot_bits: np.ndarray):
    """Arrow batches (doc_id, lang, text) -> (doc_id, lang, h3, n, bits): cold trigrams with their counts, and with h3 null the
    number and cost of a document's hot ones, found in the sorted array of hashes."""

    def run(batches):
        for b in batches:
            ids, langs = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
            h, starts, _, _ = words(b.column(2).to_pylist())
            g, at = ngrams(h, starts, 3)
            text = np.searchsorted(starts, at, side="right") - 1
            place = np.minimum(np.searchsorted(hot_keys, g), max(len(hot_keys) - 1, 0))
            hot = hot_keys[place] == g if len(hot_keys) else np.zeros(len(g), bool)
            bits = np.bincount(text[hot], hot_bits[place[hot]] if len(hot_keys) else None, len(ids))
            number = np.bincount(text[hot], minlength=len(ids))
            cold = ~hot
            order = np.lexsort((g[cold], text[cold]))
            t, k = text[cold][order], g[cold][order]
            new = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (k[1:] != k[:-1])]) if len(t) else np.zeros(0, np.int64)
            n = np.diff(np.r_[new, len(t)])
            row = np.r_[np.arange(len(ids)), t[new]].astype(np.int64)
            keys = np.r_[np.zeros(len(ids), np.uint64), k[new]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row]), langs.take(pa.array(row)), pa.array(keys.view(np.int64), mask=np.arange(len(row)) < len(ids)), pa.array(np.r_[number, n].astype(np.int64)), pa.array(np.r_[bits.astype(float), np.zeros(len(new))])],
                ["doc_id", "lang", "h3", "n", "bits"],
            )

    return run


def corpus_perplexity(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, trigrams, perplexity, verdict) of every document under the corpus model; 'below' and 'above' are outside
    the middle 98 % of the document's language. Texts of fewer than three words have no perplexity and verdict null."""
    docs = _texts(documents)
    model = cut(kneser_ney(docs.mapInArrow(trigram_batches, "h3 bigint, h12 bigint, h23 bigint, w2 bigint, w3 bigint, n bigint")))
    total = model.agg(F.sum("n")).first()[0] or 0
    hot = model.where(F.col("n") * HOT > total).select("h3", "bits").toPandas()  # at most HOT rows, by counting
    keys = hot["h3"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    parts = docs.mapInArrow(lookup_batches(keys[order], hot["bits"].to_numpy(float)[order]), "doc_id bigint, lang string, h3 bigint, n bigint, bits double")
    parts = cut(parts)
    cold = parts.where("h3 is not null").drop("bits").join(model.select("h3", "bits"), "h3").select("doc_id", "lang", "n", (F.col("n") * F.col("bits")).alias("bits"))
    sums = parts.where("h3 is null").select("doc_id", "lang", "n", "bits").unionAll(cold).groupBy("doc_id", "lang").agg(F.sum("n").alias("trigrams"), F.sum("bits").alias("bits"))
    scored = cut(sums.select("doc_id", "lang", "trigrams", F.when(F.col("trigrams") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("trigrams"))).alias("perplexity")))
    band = scored.groupBy("lang").agg(F.percentile_approx("perplexity", [0.01, 0.99], 10000).alias("q"))
    verdict = F.when(F.col("perplexity") < F.col("q")[0], "below").when(F.col("perplexity") > F.col("q")[1], "above").when(F.col("perplexity").isNotNull(), "inside")
    return scored.join(F.broadcast(band), "lang").select("doc_id", "lang", "trigrams", F.round("perplexity", 4).alias("perplexity"), verdict.alias("verdict"))
