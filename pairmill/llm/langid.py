"""Language of each text and of each segment of a mixed text, with a confidence.

Texts are cut at sentence ends, line ends and separators; a segment's bytes go in windows of fixed length through a
byte convolutional network, whose log probabilities add up over the segment. Counts of letters only tell whether a segment
has enough of them to be one; its language is the network's. The network is trained on a bounded sample of labelled documents.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bytecnn import LENGTH, ByteCNN, Compiled

LANGS = ("ko", "vi", "en", "zh", "ja", "id", "fr", "ru")
# Spellings of the languages' labels, without script and region.
SPELLINGS = {
    "ko": ("ko", "kor", "korean"), "vi": ("vi", "vie", "vietnamese"), "en": ("en", "eng", "english"), "zh": ("zh", "zho", "chi", "cmn", "chinese"),
    "ja": ("ja", "jpn", "jp", "japanese"), "id": ("id", "ind", "in", "indonesian"), "fr": ("fr", "fra", "fre", "french"), "ru": ("ru", "rus", "russian"),
}

#: Bounds of the training sample: documents a label, characters of each, windows in all.
DOCS_PER_LABEL, CHARS_PER_DOC, MAX_WINDOWS = 200, 3000, 20000
#: Rows that training goes through at least, each row of the sample counted once an epoch.
LEAST_ROWS = 120_000
#: Least letters of a segment that counts: Latin, Cyrillic; Hangul, Han and kana. Least words of a Latin segment.
LEAST_LATIN, LEAST_BLOCK, LEAST_WORDS = 14, 6, 4
#: Letters up to which a Latin segment without a sentence's end is a heading.
HEADING = 45
#: Most bytes of a segment.
LONGEST = 30000
#: Least probability of a segment's language.
SURE = 0.55


def label_language(label: Column) -> Column:
    """Language a label names, whatever its spelling; null for none."""
    base = F.lower(F.regexp_extract(label, r"^\s*([A-Za-z]+)", 1))
    out = F.lit(None).cast("string")
    for lang, names in SPELLINGS.items():
        out = F.when(base.isin(*names), lang).otherwise(out)
    return out


# Kinds of bytes, counted over each segment: ASCII letters, first bytes of other Latin letters, of letters only
# Vietnamese has, of Hangul, Han, kana and Cyrillic.
def _tables() -> np.ndarray:
    t = np.zeros((256, 2), np.int64)
    a, v, l1, ko, han, kana, cyr = (1, 0), (1 << 21, 0), (1 << 42, 0), (0, 1), (0, 1 << 16), (0, 1 << 32), (0, 1 << 48)
    for b in [*range(65, 91), *range(97, 123)]:
        t[b] = a
    t[0xC3] = l1
    t[0xC4] = t[0xC6] = t[0xE1] = v
    t[0xEA:0xEE] = ko
    t[0xE4:0xEA] = han
    t[0xE3] = kana
    t[0xD0] = t[0xD1] = cyr
    return t


_KIND = _tables()
_TERM = np.zeros(256, bool)
_TERM[[ord(c) for c in ".!?"]] = True
_CLOSE = np.zeros(256, bool)
_CLOSE[[ord(c) for c in "\"')]"]] = True


def _kinds(b: np.ndarray) -> np.ndarray:
    """Bytes with first bytes told apart by the byte after them: those of Hangul letters from the Vietnamese letters that
    share them, those of ideographic punctuation from kana."""
    jamo = np.flatnonzero(b[:-1] == 0xE1)
    jamo = jamo[b[jamo + 1] < 0x88]
    sign = np.flatnonzero(b[:-1] == 0xE3)
    sign = sign[b[sign + 1] == 0x80]
    if len(jamo) or len(sign):
        b = b.copy()
        b[jamo] = 0xEA
        b[sign] = 32
    return b


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each text begins (one more entry than texts). Nulls are empty."""
    arr = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if arr.null_count:
        arr = arr.fill_null(b"")
    _, offsets, data = arr.buffers()
    offsets = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    whole = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(arr) else np.zeros(0, np.uint8)
    return whole, offsets - offsets[0]


def cut(b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where segments begin."""
    n = len(b)
    p = np.concatenate([np.zeros(4, np.uint8), b, np.zeros(3, np.uint8)])
    b1, b2, b3, b4, n1, n2 = p[3 : n + 3], p[2 : n + 2], p[1 : n + 1], p[:n], p[5 : n + 5], p[6 : n + 6]
    space = b == 32
    quote = (b3 == 0xE2) & (b2 == 0x80)
    ended = _TERM[b1] | (_CLOSE[b1] & _TERM[b2]) | (quote & (((b1 == 0x9D) | (b1 == 0x99)) & _TERM[b4] | (b1 == 0xA6)))
    parted = ((n1 == 124) | (n1 == 47) | (n1 == 45)) & (n2 == 32)
    after = (space & (ended | parted)) | (b == 10)
    wide = ((b2 == 0xE3) & (b1 == 0x80) & (b == 0x82)) | ((b2 == 0xEF) & (b1 == 0xBC) & ((b == 0x81) | (b == 0x9F)))
    before = (b == 40) & (b1 == 32)
    marks = np.zeros(n + 1, bool)
    marks[1:][after | wide] = True
    marks[:-1][before] = True
    marks[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(marks[:n])
    long = np.diff(np.append(at, n)) > LONGEST
    if long.any():  # text without any sentence end goes in parts, so that the counts of a part fit their fields
        at = np.unique(np.concatenate([at, *[np.arange(a, e, LONGEST) for a, e in zip(at[long], np.append(at[1:], n)[long], strict=True)]]))
    return at


def _ended(b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether stretches end with a sentence's end, blanks and closing signs aside."""
    at = ends - 1
    for _ in range(6):
        last = b[np.maximum(at, 0)]
        skip = (last <= 32) | _CLOSE[last]
        at = np.where(skip & (at > 0), at - 1, at)
    last = b[np.maximum(at, 0)]
    quote = (at >= 3) & (b[np.maximum(at - 1, 0)] == 0x80) & ((last == 0x9D) | (last == 0x99))
    return _TERM[last] | (last == 0xA6) | (quote & _TERM[b[np.maximum(at - 3, 0)]])


def windows(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of LENGTH bytes that cover each stretch, the last one against its end; zeros fill short ones. (rows, owner)"""
    size = ends - starts
    count = np.maximum(1, -(-size // LENGTH))
    owner = np.repeat(np.arange(len(starts)), count)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = starts[owner] + k * LENGTH
    last = (k == count[owner] - 1) & (size[owner] >= LENGTH)
    at = np.where(last, ends[owner] - LENGTH, at)
    idx = at[:, None] + np.arange(LENGTH)
    rows = b[np.minimum(idx, len(b) - 1)]
    short = size[owner] < LENGTH
    if short.any():
        rows[short] *= (idx[short] < ends[owner[short], None]).astype(np.uint8)
    return rows, owner


class Detector:
    """prior: log probability of each language before a text is read, from `priors`; without, all are as likely."""

    def __init__(self, net: Compiled, prior: np.ndarray | None = None):
        self.net, self.prior = net, np.zeros(len(LANGS), np.float32) if prior is None else prior

    @staticmethod
    def _evidence(b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bytes of each kind in stretches that begin at `starts`: Latin, Vietnamese, other Latin, Hangul, Han, kana, Cyrillic."""
        kind = _kinds(b)
        c = np.add.reduceat(_KIND[:, 0][kind], starts)
        d = np.add.reduceat(_KIND[:, 1][kind], starts)
        return c & 0x1FFFFF, (c >> 21) & 0x1FFFFF, c >> 42, d & 0xFFFF, (d >> 16) & 0xFFFF, (d >> 32) & 0xFFFF, d >> 48

    def _scores(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log probabilities of the languages, added up over each stretch."""
        score = np.zeros((len(starts), len(LANGS)), np.float32)
        for lo in range(0, len(starts), 20000):
            rows, own = windows(b, starts[lo : lo + 20000], ends[lo : lo + 20000])
            score[lo : lo + 20000] = np.add.reduceat(self.net.log_probabilities(rows), np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), axis=0)
        return score

    def _decide(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number and its probability."""
        score = score + self.prior
        score -= score.max(1, keepdims=True)
        prob = np.exp(score)
        prob /= prob.sum(1, keepdims=True)
        best = prob.argmax(1)
        return best, prob[np.arange(len(score)), best]

    def segments(self, texts: pa.Array):
        """(owner, start, end, language number or -1, confidence) of every segment; bytes within the batch, and the batch's bytes and offsets."""
        b, offsets = flat(texts)
        if not len(b):
            z = np.zeros(0, np.int64)
            return z, z, z, z.astype(np.int8), z.astype(np.float32), b, offsets
        starts = cut(b, offsets)
        ends = np.append(starts[1:], len(b))
        owner = np.searchsorted(offsets, starts, side="right") - 1
        ends = np.minimum(ends, offsets[owner + 1])
        latin, viet, l1, ko, han, kana, cyr = self._evidence(b, starts)
        spaces = np.add.reduceat((b == 32).view(np.uint8), starts, dtype=np.int32)
        roman = latin + viet + l1
        sentence = (roman > HEADING) | _ended(b, ends)
        counts = ((roman >= LEAST_LATIN) & (spaces >= LEAST_WORDS - 1) & sentence) | (ko >= LEAST_BLOCK) | (han + kana >= LEAST_BLOCK) | (cyr >= LEAST_LATIN)
        lang = np.full(len(starts), -1, np.int8)
        sure = np.zeros(len(starts), np.float32)
        at = np.flatnonzero(counts)
        if len(at):
            best, conf = self._decide(self._scores(b, starts[at], ends[at]))
            lang[at] = np.where(conf >= SURE, best, -1)
            sure[at] = conf
        return owner, starts, ends, lang, sure, b, offsets

    def main(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language number and confidence of each text as a whole: the language of most of its segments' bytes, each weighed
        by its confidence, and its part of all bytes judged. Without a sure segment all of a text is judged at once;
        -1 and 0 where it has no letters of a known script."""
        owner, starts, ends, lang, sure, b, offsets = self.segments(texts)
        size, good = ends - starts, lang >= 0
        weight = np.zeros((len(texts), len(LANGS)))
        np.add.at(weight, (owner[good], lang[good]), (size * sure)[good])
        judged = np.bincount(owner[sure > 0], size[sure > 0], minlength=len(texts))
        best, conf = weight.argmax(1), weight.max(1, initial=0) / np.maximum(judged, 1)
        left = (weight.sum(1) == 0)[owner]
        if left.any():
            text, first = np.unique(owner[left], return_index=True)
            kinds = [np.add.reduceat(x[left], first) for x in self._evidence(b, starts)]
            some, p = self._decide(np.add.reduceat(self._scores(b, starts[left], ends[left]), first, axis=0))
            best[text], conf[text] = some, np.where(sum(kinds) > 0, p, 0)
        return np.where(conf > 0, best, -1), conf

    def languages(self, texts: pa.Array) -> np.ndarray:
        """Set of languages of each text, as bits; 0 where nothing can be told."""
        owner, starts, ends, lang, _, b, offsets = self.segments(texts)
        out = np.zeros(len(texts), np.int32)
        good = lang >= 0
        np.bitwise_or.at(out, owner[good], (1 << lang[good].astype(np.int32)))
        # a text too short for segments goes to the network as a whole, if most of its letters are of one script
        left = np.flatnonzero((out == 0) & (np.diff(offsets) > 0))
        if len(left):
            spans, stops = offsets[left], offsets[left + 1]
            sizes = stops - spans
            idx = np.repeat(spans - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            first = np.r_[0, np.cumsum(sizes)[:-1]]
            kind = _kinds(b[idx])
            # one sum a kind, as a text of any length may be among them
            latin, viet, other = (np.add.reduceat(_KIND[:, 0][kind] >> at & 1, first) for at in (0, 21, 42))
            ko, han, kana, cyr = (np.add.reduceat(_KIND[:, 1][kind] >> at & 1, first) for at in (0, 16, 32, 48))
            roman = latin + viet + other
            enough = np.flatnonzero((ko >= 4) & (ko * 2 >= roman) | (ko == 0) & ((viet >= 2) & (roman >= 10) | (han + kana >= 4)) | (cyr >= 8))
            if len(enough):
                best, conf = self._decide(self._scores(b, spans[enough], stops[enough]))
                out[left[enough]] = np.where(conf >= SURE, 1 << best, 0)
        return out


def _strip(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text.replace("đ", "d").replace("Đ", "D")) if not unicodedata.combining(c))


def fitting(lang: str, text: str) -> str:
    """The segments of a labelled text whose letters don't contradict the label, a line each: labels are noisy and texts mixed."""
    b, _ = flat(pa.array([text]))
    if not len(b):
        return ""
    starts = cut(b, np.array([0, len(b)]))
    latin, viet, l1, ko, han, kana, cyr = Detector._evidence(b, starts)
    roman, east = latin + viet + l1, han + kana
    fits = {
        "ko": ko * 3 > roman, "zh": (han * 3 > roman) & (kana * 6 < han) & (ko == 0), "ja": (kana > 0) & (east * 3 > roman) & (ko == 0), "ru": (cyr * 2 > roman) & (ko == 0),
        "vi": (viet * 12 >= roman) & (roman > 0) & (ko + east == 0) & (cyr == 0),
    }.get(lang, (viet * 40 < roman) & (ko + east == 0) & (cyr == 0))
    ends = np.append(starts[1:], len(b))
    return "\n".join(b[i:e].tobytes().decode("utf-8", "replace").strip() for i, e in zip(starts[fits], ends[fits], strict=True))


def train(labelled: list[tuple[str, str]], epochs: int = 6) -> Compiled:
    """Fit on (language, text) rows."""
    r = np.random.default_rng(1)
    xs: dict[int, list[np.ndarray]] = {}
    for lang, whole in labelled:
        text = fitting(lang, whole)
        # forms a text comes in, each with its chance: without accents, decomposed, in capitals
        plain = _strip(text) if lang == "vi" else text
        forms = [(text, 1.0), (plain, float(lang == "vi")), (unicodedata.normalize("NFD", text), 0.4 * (lang in ("vi", "ko"))), (text.upper(), 1.0 if lang == "vi" else 0.3), (plain.upper(), 0.3 * (lang == "vi"))]
        for t in [t for t, chance in forms if r.random() < chance]:
            b, offsets = flat(pa.array([t]))
            if not len(b):
                continue
            starts = cut(b, offsets)
            ends = np.append(starts[1:], len(b))
            keep = ends - starts >= 20
            if keep.any():
                xs.setdefault(LANGS.index(lang), []).append(windows(b, starts[keep], ends[keep])[0])
    if not xs:  # nothing to learn from: every language is as likely
        net = ByteCNN(len(LANGS))
        net.out[:] = 0
        return Compiled(net)
    x, y = [], []
    each = MAX_WINDOWS // len(LANGS)
    for k, parts in xs.items():
        rows = np.concatenate(parts)
        # Latin languages are the hard ones: twice as many of them
        rows = rows[r.permutation(len(rows))[: each * 2 if LANGS[k] in ("vi", "en", "id", "fr") else each // 2]]
        # windows begin anywhere in a text
        shift = r.integers(0, 12, len(rows))
        cols = np.minimum(np.arange(LENGTH) + shift[:, None], LENGTH)
        x.append(np.take_along_axis(np.pad(rows, ((0, 0), (0, 1))), cols, 1))
        y.append(np.full(len(rows), k))
    rows, labels = np.concatenate(x), np.concatenate(y)
    # a small sample is gone through more often
    net = ByteCNN(len(LANGS)).fit(rows, labels, epochs=max(epochs, -(-LEAST_ROWS // len(rows))))
    return Compiled(net)


def training_rows(documents: DataFrame) -> list[tuple[str, str]]:
    """The bounded sample: DOCS_PER_LABEL documents of each language by hash, CHARS_PER_DOC characters of each."""
    order = Window.partitionBy("l").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = (
        documents.select("doc_id", label_language(F.col("lang")).alias("l"), F.substring("text", 1, CHARS_PER_DOC).alias("t"))
        .where("l is not null and length(t) > 20")
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= DOCS_PER_LABEL)
        .orderBy("l", "n")
        .select("l", "t")
        .collect()
    )
    return [(r.l, r.t) for r in rows]


def priors(documents: DataFrame) -> np.ndarray:
    """Log share of each language among the labels of all documents, every language counted once more."""
    rows = documents.groupBy(label_language(F.col("lang")).alias("l")).count().where("l is not null").collect()  # a row per language
    n = np.ones(len(LANGS))
    for r in rows:
        n[LANGS.index(r.l)] += r["count"]
    return np.log(n / n.sum()).astype(np.float32)


def found_batches(detector: Detector):
    """Arrow batches (rec_table, rec_id, field, expected, text) -> a row per language of each case. `expected` is the
    language the field or label claims, null for none; documents count mixed texts, too."""
    import regex

    from .mojibake import SUSPECT, garbled

    suspect = regex.compile(SUSPECT)
    number = {lang: k for k, lang in enumerate(LANGS)}

    def run(batches):
        for batch in batches:
            text = batch.column(4)
            bits = detector.languages(text)
            claim = np.array([1 << number[e] if e in number else 0 for e in batch.column(3).to_pylist()], np.int32)
            at = np.flatnonzero((bits != 0) & (bits != claim))
            doubt = [i for i in at.tolist() if suspect.search(text[i].as_py())]
            if doubt:
                bad = {i for i, g in zip(doubt, garbled([text[i].as_py() for i in doubt]), strict=True) if g}
                at = np.array([i for i in at.tolist() if i not in bad], np.int64)
            rows = [(i, k) for i in at.tolist() for k in range(len(LANGS)) if bits[i] >> k & 1]
            take = pa.array([i for i, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), pa.array([LANGS[k] for _, k in rows], pa.string())], ["rec_table", "rec_id", "field", "lang"])

    return run


def segment_batches(detector: Detector):
    """Arrow batches (rec_table, rec_id, field, text) -> (rec_table, rec_id, field, seg_no, start, bytes, lang, confidence): places in bytes of the UTF-8 text; lang is null for a segment too short to tell."""

    def run(batches):
        for batch in batches:
            owner, starts, ends, lang, sure, _, offsets = detector.segments(batch.column(3))
            no = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left")
            names = pa.array([LANGS[k] if k >= 0 else None for k in lang.tolist()], pa.string())
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(take) for k in range(3)], pa.array(no), pa.array(starts - offsets[owner]), pa.array(ends - starts), names, pa.array(np.round(sure.astype(float), 4))], ["rec_table", "rec_id", "field", "seg_no", "start", "bytes", "lang", "confidence"])

    return run


def text_batches(detector: Detector):
    """Arrow batches (rec_table, rec_id, field, text) -> (rec_table, rec_id, field, lang, confidence) of every text; lang is null without letters of a known script."""

    def run(batches):
        for batch in batches:
            lang, conf = detector.main(batch.column(3))
            names = pa.array([LANGS[k] if k >= 0 else None for k in lang.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(3)], names, pa.array(np.round(conf, 4))], ["rec_table", "rec_id", "field", "lang", "confidence"])

    return run
