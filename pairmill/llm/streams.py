"""Texts as streams of folded characters, hashed without being rewritten.

A table over all code points says of each whether it is skipped (white space, punctuation) and else its folded form;
rolling polynomial hashes run over what is left, of whole texts or of their words, for all texts of a batch at once.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np

BASE1, BASE2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
LONGEST = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def folded(c: str) -> str:
    """A character without regard to case: what its case folding is, or, where that is several characters, its capital's small
    form, so that each character stays one (a sharp s is its own capital's, not two letters)."""
    for low in (c.casefold(), c.lower()):
        if len(low) == 1:
            return low
    return c


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point: its folded form (0: skipped), whether it is white space, a random value of its folded form."""
    fold = np.arange(0x110000, dtype=np.uint32)
    space = np.zeros(0x110000, bool)
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        if c.isspace():
            space[cp], fold[cp] = True, 0
        elif (kind := unicodedata.category(c))[0] == "P":
            fold[cp] = 0
        elif kind in ("Lu", "Lt", "Ll", "Nl", "So", "Mn"):
            fold[cp] = ord(folded(c))
    value = mix(fold.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    return fold, space, value


@lru_cache(2)
def powers(base: int) -> np.ndarray:
    out = np.empty(LONGEST, np.uint64)
    x = 1
    for i in range(LONGEST):
        out[i] = x
        x = x * base & 0xFFFFFFFFFFFFFFFF
    return out


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text begins (one entry more)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.r_[0, np.cumsum(sizes)]


def text_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit polynomial hashes of each text's folded stream, and its length. An empty stream hashes to 0."""
    fold, _, value = tables()
    code, offsets = codes(texts)
    at = np.flatnonzero(fold[code])
    first = np.searchsorted(at, offsets)
    size = np.diff(first)
    h1, h2 = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        v = value[code[at]]
        place = (np.arange(len(at)) - np.repeat(first[:-1], size)).astype(np.int64)
        low, high = place % LONGEST, place // LONGEST
        far = high.any()
        for h, base in ((h1, BASE1), (h2, BASE2)):
            p = powers(int(base))
            x = v * p[low]
            if far:  # texts beyond LONGEST characters: the place's higher digits count with another power
                x *= mix(high.astype(np.uint64) + base) | np.uint64(1)
            h[some] = np.add.reduceat(x, first[:-1][some])
    return mix(h1 + size.astype(np.uint64)), mix(h2), size


def same_streams(a: list[str], b: list[str]) -> np.ndarray:
    """Whether the folded streams of each pair are equal: two pointers that skip what the table skips, moved together."""
    fold, _, _ = tables()
    ca, oa = codes(a)
    cb, ob = codes(b)
    ia, ib = np.flatnonzero(fold[ca]), np.flatnonzero(fold[cb])
    fa, fb = np.searchsorted(ia, oa), np.searchsorted(ib, ob)
    same = np.diff(fa) == np.diff(fb)
    size = np.diff(fa)[same]
    if size.sum():
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        pa_, pb_ = ia[np.repeat(fa[:-1][same], size) + step], ib[np.repeat(fb[:-1][same], size) + step]
        differs = fold[ca[pa_]] != fold[cb[pb_]]
        owner = np.repeat(np.flatnonzero(same), size)
        same[np.unique(owner[differs])] = False
    return same


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, where each text's words begin, first and last code point of each word in the batch).

    Words are parted by white space; punctuation and case don't count, and a word of punctuation alone is none.
    """
    fold, space, value = tables()
    code, offsets = codes(texts)
    empty = np.zeros(0, np.int64)
    if not len(code):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), empty, empty
    part = space[code].astype(np.int64)
    part[offsets[:-1][np.diff(offsets) > 0]] += 1
    run = np.cumsum(part)
    at = np.flatnonzero(fold[code])
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), empty, empty
    r = run[at]
    begin = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    size = np.diff(np.r_[begin, len(at)])
    place = np.arange(len(at)) - np.repeat(begin, size)
    h = np.add.reduceat(value[code[at]] * powers(int(BASE1))[place % LONGEST], begin)
    firsts, lasts = at[begin], at[np.r_[begin[1:], len(at)] - 1]
    return mix(h + size.astype(np.uint64)), np.searchsorted(firsts, offsets), firsts, lasts


def ngrams(h: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within a text, and the word each begins at."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    p = powers(int(BASE2))
    x = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        x += h[j : len(h) - n + 1 + j] * p[j + 1]
    owner_end = np.repeat(starts[1:], np.diff(starts))
    at = np.flatnonzero(np.arange(len(x)) + n <= owner_end[: len(x)])
    return mix(x[at] + np.uint64(n)), at
