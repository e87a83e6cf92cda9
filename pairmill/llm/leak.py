"""Test passages inside training documents: a BM25 index of the passages, queried with every stretch of every document.

Terms are pairs of words with at most one word between them in a passage, and two in a document: such a pair survives
a changed word between its two. Weights are divided by what a stretch that repeats enough of the passage has at least,
so that one threshold, 1, holds for all and no case stays below it. Passages lie in blocks with the greatest weight of
each term; a stretch first adds up the terms' bounds, then the bounds of each block, and only blocks that can reach the
threshold are scored passage by passage. What is retrieved is verified by aligning the words.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.plans.runtime import cut

from .streams import BASE2, mix, powers, words

K1, B = 1.2, 0.75
#: Passages of a block; passages of one index.
BLOCK, SLICE = 16, 20000
#: Share of a passage's words that must be repeated.
REPEATED = 0.5
#: Most words between two repeated ones where one word is changed: in the passage, in the document (a word may become two).
PASSAGE_GAP, DOCUMENT_GAP = 1, 2
#: Least words between the begins of two stretches; a stretch has twice as many.
STEP = 64


def links(h: np.ndarray, starts: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pairs of words of a text with at most `gap` words between them, and the word each begins at, in order."""
    p = powers(int(BASE2))
    end = np.repeat(starts[1:], np.diff(starts))
    at, out = [], []
    for d in range(1, gap + 2):
        i = np.flatnonzero(np.arange(len(h)) + d < end)
        at.append(i)
        out.append(mix(h[i] * p[1] + h[i + d] * p[2]))
    at, out = np.concatenate(at), np.concatenate(out)
    order = np.argsort(at, kind="stable")
    return out[order], at[order]


class PassageIndex:
    """Immutable; its size is bounded by SLICE passages."""

    def __init__(self, ids: list[int], passages: list[str]):
        h, starts, _, _ = words(passages)
        order = sorted(range(len(ids)), key=lambda i: (passages[i][:1] > "ỹ", ids[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.words = [h[starts[i] : starts[i + 1]] for i in order]
        grams = []
        for w in self.words:
            grams.append(links(w, np.array([0, len(w)]), PASSAGE_GAP)[0])
        self.places = []
        for w in self.words:
            places = defaultdict(list)
            for k, x in enumerate(w.tolist()):
                places[x].append(k)
            self.places.append(dict(places))
        size = np.array([len(g) for g in grams], float)
        self.vocabulary = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        term, item, tf = [], [], []
        for i, g in enumerate(grams):
            u, n = np.unique(np.searchsorted(self.vocabulary, g), return_counts=True)
            term.append(u)
            item.append(np.full(len(u), i))
            tf.append(n)
        term, item, tf = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (term, item, tf))
        df = np.bincount(term, minlength=len(self.vocabulary))
        idf = np.log1p((len(grams) - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * size / max(size.mean(), 1)) if len(size) else size
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[item]) if len(term) else np.zeros(0)
        self.step = stretch_of(max(map(len, self.words), default=0))
        # a case repeats half of the words, so half less one of the links; the lightest so many, each counted once, are its least score
        least = [-(-len(w) // 2) - 1 - (len(g) - len(np.unique(g))) for w, g in zip(self.words, grams, strict=True)]
        need = np.maximum(1, np.array(least, np.int64))
        at = np.lexsort((weight, item))
        first = np.searchsorted(item[at], np.arange(len(grams) + 1))
        total = np.r_[0.0, np.cumsum(weight[at])]
        least = total[np.minimum(first[:-1] + need, first[1:])] - total[first[:-1]]
        weight = weight / (least[item] * (1 - 1e-6)) if len(term) else weight
        # postings by term and block of passages, and the greatest weight of each
        at = np.lexsort((item, item // BLOCK, term))
        self.term, self.item, self.weight = term[at], item[at], weight[at].astype(np.float32)
        key = self.term * (len(grams) // BLOCK + 1) + self.item // BLOCK
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.blocks = len(grams) // BLOCK + 1
        self.b_first, self.b_last = first, np.r_[first[1:], len(key)]
        self.b_term, self.b_block = self.term[first], self.item[first] // BLOCK
        self.b_max = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        self.t_first = np.searchsorted(self.b_term, np.arange(len(self.vocabulary) + 1))
        self.t_max = np.maximum.reduceat(self.b_max, self.t_first[:-1]) if len(first) else self.b_max

    def retrieve(self, grams: np.ndarray, at: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, passage's place, first and last word) of all passages that some stretch of a text retrieves.

        grams: hashes of links that begin at words `at`; starts: where each text's words begin.
        """
        if not len(self.vocabulary) or not len(grams):
            return []
        place = np.minimum(np.searchsorted(self.vocabulary, grams), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[place] == grams)
        term, pos = place[known], at[known]
        if not len(term):
            return []
        text = np.searchsorted(starts, pos, side="right") - 1
        # the stretches that hold each place: two, but for the first
        local = pos - starts[text]
        last = local // self.step
        s_text, s_no, s_term = np.r_[text, text[last > 0]], np.r_[last, last[last > 0] - 1], np.r_[term, term[last > 0]]
        stretch = s_text * (1 << 32) + s_no
        order = np.lexsort((s_term, stretch))
        stretch, s_term = stretch[order], s_term[order]
        new = np.r_[True, (stretch[1:] != stretch[:-1]) | (s_term[1:] != s_term[:-1])]
        stretch, s_term = stretch[new], s_term[new]
        first = np.flatnonzero(np.r_[True, stretch[1:] != stretch[:-1]])
        reach = np.add.reduceat(self.t_max[s_term], first) >= 1
        own = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(stretch)]))
        keep = reach[own]
        own, s_term = own[keep], s_term[keep]
        if not len(own):
            return []
        # bounds of the blocks
        n = self.t_first[s_term + 1] - self.t_first[s_term]
        post = np.repeat(self.t_first[s_term] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        pair = np.repeat(own, n) * self.blocks + self.b_block[post]
        u, inv = np.unique(pair, return_inverse=True)
        alive = np.bincount(inv, self.b_max[post]) >= 1
        keep = alive[inv]
        post, inv = post[keep], inv[keep]
        if not len(post):
            return []
        # scores of the passages of the blocks that are left
        m = self.b_last[post] - self.b_first[post]
        one = np.repeat(self.b_first[post] - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(m.sum())
        where = np.repeat(u[inv] // self.blocks, m) * len(self.ids) + self.item[one]
        w, inv = np.unique(where, return_inverse=True)
        hit = w[np.bincount(inv, self.weight[one]) >= 1]
        s = stretch[first[hit // len(self.ids)]]
        out: dict[tuple[int, int], list[int]] = {}
        for t, no, i in zip((s >> 32).tolist(), (s & 0xFFFFFFFF).tolist(), (hit % len(self.ids)).tolist(), strict=True):
            out.setdefault((t, i), []).append(no)
        return [(t, i, max(0, (min(nos) - 1) * self.step), (max(nos) + 3) * self.step) for (t, i), nos in out.items()]


def stretch_of(n: int) -> int:
    """Words between the begins of two stretches for passages of n words, a power of two times STEP: a stretch holds
    half of the words whole, with DOCUMENT_GAP between any two."""
    step = STEP
    while step < (DOCUMENT_GAP + 1) * -(-n // 2):
        step *= 2
    return step


def indexes(ids: list[int], passages: list[str]) -> list[PassageIndex]:
    """An index for each length of stretch, so that a long passage does not widen the stretches of the others."""
    h, starts, _, _ = words(passages)
    by = defaultdict(list)
    for i, n in enumerate(np.diff(starts).tolist()):
        if n:
            by[stretch_of(n)].append(i)
    return [PassageIndex([ids[i] for i in rows], [passages[i] for i in rows]) for _, rows in sorted(by.items())]


def chained(places: dict[int, list[int]], stretch: list[int]) -> int:
    """Most words of a passage that a stretch repeats in order, with no more than PASSAGE_GAP and DOCUMENT_GAP words
    between two. places: where each word stands in the passage."""
    best = 0
    last: list[dict[int, int]] = [{}] * (DOCUMENT_GAP + 1)  # for the words just before: place in the passage -> words so far
    for w in stretch:
        now: dict[int, int] = {}
        if w in places:
            rows = [row for row in last if row]
            for i in places[w]:
                n = 0
                for row in rows:
                    for k in range(i - PASSAGE_GAP - 1, i):
                        if k in row and row[k] > n:
                            n = row[k]
                now[i] = n + 1
                if n >= best:
                    best = n + 1
        last = [*last[1:], now]
    return best


def found_batches(parts: list[PassageIndex]):
    """Arrow batches (doc_id, text) -> (doc_id, item_id, repeated) of documents that hold passages."""

    def run(batches):
        for b in batches:
            docs, items, shares = [], [], []
            texts = b.column(1).to_pylist()
            ids = b.column(0).to_pylist()
            for lo in range(0, len(texts), 1000):
                h, starts, _, _ = words(texts[lo : lo + 1000])
                grams, at = links(h, starts, DOCUMENT_GAP)
                own = h.tolist()
                for index in parts:
                    for t, i, first, last in index.retrieve(grams, at, starts):
                        n = chained(index.places[i], own[starts[t] + first : min(starts[t] + last, starts[t + 1])])
                        if n < REPEATED * len(index.words[i]):
                            continue
                        docs.append(ids[lo + t])
                        items.append(int(index.ids[i]))
                        shares.append(round(n / len(index.words[i]), 4))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64()), pa.array(shares, pa.float64())], ["doc_id", "item_id", "repeated"])

    return run


def leaks(documents: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, item_id, repeated) of every document that repeats half of a passage's words in one stretch.

    An index holds SLICE passages at most; more passages take a further run over the documents each, whose rows are
    written before the next index is made, so that the driver holds one. Null and empty texts hold no passage, and in
    unspaced scripts a stretch between blanks is one word; a passage of one word is never found.
    """
    rows = passages.select("item_id", "passage").where("passage is not null").orderBy("item_id")
    out, ids, texts = None, [], []

    def search() -> DataFrame:
        found = documents.select("doc_id", "text").where("text is not null").mapInArrow(found_batches(indexes(ids, texts)), "doc_id bigint, item_id bigint, repeated double")
        return found if out is None else out.unionAll(found)

    for r in rows.toLocalIterator():
        if len(ids) == SLICE:
            out, ids, texts = cut(search()), [], []
        ids.append(r.item_id)
        texts.append(r.passage)
    if ids or out is None:
        out = search()
    return out.groupBy("doc_id", "item_id").agg(F.max("repeated").alias("repeated"))
