"""One form for text that looks the same: a longest-match transducer over grapheme clusters.

The mapping is computed from rules (widths, accents, spaces, unseen characters, look-alike letters), checked for
conflicts once, and laid out as a tree of characters; a text is rewritten in one pass that enters the tree only where
a character can begin an entry. Look-alike letters are rewritten inside words that also have Latin letters, full-width
signs outside Chinese and Japanese, joiners outside emoji.
"""

from __future__ import annotations

import bisect
import itertools
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex

# Letters of other scripts, and of Latin, that look like the Latin or Vietnamese letter below them: Cyrillic and
# Greek, Armenian, Cherokee, Lisu, Latin.
LOOKALIKES = dict(
    zip(
        "асеорхуѕіјһԁԛԝкАВСЕНІЈКМОРЅТУХԌԚԜӏӀѵѴαοινρτυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϹϳ" + "օհոսցյ" + "ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏙᏚᏞᏟᏢᏦᏴ" + "ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ" + "ɑɡıðÐƉɖ",
        "aceopxysijhdqwkABCEHIJKMOPSTYXGQWlIvVaoivptukABEZHIKMNOPTYXcCj" + "ohnugj" + "DRTiAJEWMHYGhZbVSLCPKB" + "BPDTGKJCZFMNLSRVHWXYAEIOU" + "agiđĐĐđ",
        strict=True,
    )
)


def _named_lookalikes() -> dict[str, str]:
    """Small capitals, and Roman numerals of one letter, as the letters they are."""
    out = {}
    for cp in [*range(0x1D00, 0x1D23), *range(0x262, 0x2A0)]:
        name = unicodedata.name(chr(cp), "")
        if name.startswith("LATIN LETTER SMALL CAPITAL ") and len(name) == 28:
            out[chr(cp)] = name[-1].lower()
    for cp in range(0x2160, 0x2180):
        if len(letter := unicodedata.normalize("NFKC", chr(cp))) == 1:
            out[chr(cp)] = letter
    return out


LOOKALIKES |= _named_lookalikes()
# Characters that cannot be seen.
UNSEEN = "\xad͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩ㅤ﻿ﾠ︀︁︂︃︄︅︆︇︈︉︊︋︌︍︎️"
JOINERS = "‍️︎"
#: Letters that are written so wherever they stand for this one.
_ETH = "ðÐƉɖ"
LATIN_MARKS = "̛̣̀́̂̃̆̉̈̊̄̌̋̇̈̇"
EMOJI = r"[\p{Extended_Pictographic}\p{Emoji_Modifier}\U0001F1E6-\U0001F1FF]"


def mapping() -> dict[str, str]:
    """Source sequence -> usual form. Raises if two rules disagree or the result would be rewritten again."""
    out: dict[str, str] = {}

    def add(source: str, target: str) -> None:
        if source != target and out.setdefault(source, target) != target:
            raise ValueError(f"conflict: {source!r} to {out[source]!r} and {target!r}")

    for cp in range(0xFF01, 0xFF5F):
        add(chr(cp), chr(cp - 0xFEE0))
    wide = [*range(0xFF61, 0xFFA0), *range(0xFFA1, 0xFFDD), *range(0xFFE0, 0xFFE7), *range(0x1D400, 0x1D800), *range(0xFB00, 0xFB07), *range(0x1F130, 0x1F14A), 0x2126, 0x212A, 0x212B, *range(0xF900, 0xFB00)]
    for cp in wide:
        if unicodedata.category(chr(cp)) != "Cn" and (t := unicodedata.normalize("NFKC", chr(cp))) != chr(cp):
            add(chr(cp), t)
    for cp in range(0x110000):
        if unicodedata.category(chr(cp)) == "Zs" and cp != 32:
            add(chr(cp), " ")
    for c in UNSEEN:
        add(c, "")
    for cp in range(0x110000):  # characters that are never composed themselves
        if not 0xD800 <= cp < 0xE000 and chr(cp) not in out and (t := unicodedata.normalize("NFC", chr(cp))) != chr(cp):
            add(chr(cp), t)
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        whole = chr(cp)
        base, *marks = unicodedata.normalize("NFD", whole)
        for n in range(1, len(marks) + 1):
            for order in itertools.permutations(marks, n):
                if (done := unicodedata.normalize("NFC", base + "".join(order))) and unicodedata.normalize("NFC", done) == done:
                    add(base + "".join(order), done)
                    for k in range(1, n):
                        head = unicodedata.normalize("NFC", base + "".join(order[:k]))
                        if len(head) == 1:
                            add(head + "".join(order[k:]), done)
    for lead in range(19):
        for vowel in range(21):
            block = 0xAC00 + (lead * 21 + vowel) * 28
            for tail in range(28):
                last = chr(0x11A7 + tail) if tail else ""
                add(chr(0x1100 + lead) + chr(0x1161 + vowel) + last, chr(block + tail))
                add(chr(block) + last, chr(block + tail))
    for c, t in LOOKALIKES.items():
        add(c, t)
    for source, target in out.items():
        if any(c in out and c not in LOOKALIKES for c in target):
            raise ValueError(f"{source!r} to {target!r} would be rewritten again")
    return out


@lru_cache(1)
def transducer() -> dict:
    """The mapping as nested dicts; key None holds the target of the sequence that ends there."""
    root: dict = {}
    for source, target in mapping().items():
        node = root
        for c in source:
            node = node.setdefault(c, {})
        node[None] = target
    return root


def _cls(chars) -> str:
    return "".join(f"\\U{ord(c):08X}" for c in chars)


@lru_cache(1)
def _patterns():
    singles = [s for s in mapping() if len(s) == 1]
    # grapheme clusters that hold something the mapping may change
    cluster = regex.compile(rf"(?:(?=[{_cls(singles)}\p{{M}}\U00001100-\U000011FF])|(?=[^\p{{M}}][\p{{M}}{_cls(JOINERS)}\U0000200C\U00001160-\U000011FF]))\X")
    word = regex.compile(r"[\p{L}\p{M}\p{Cf}\p{Nl}]+")
    alike = "".join(c for c in LOOKALIKES if c not in _ETH)
    latin = regex.compile(rf"[\p{{Latin}}\U0000FF21-\U0000FF5A--[{_cls(alike)}{_cls(_ETH)}]]", regex.V1)
    foreign = regex.compile(rf"[\p{{Cyrillic}}\p{{Greek}}\p{{Armenian}}\p{{Cherokee}}\p{{Lisu}}{_cls(alike)}]")
    return cluster, word, latin, foreign


_HAN_KANA = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\U00003001-\U00003011\U0000FF01-\U0000FF0F\U0000FF1A-\U0000FF20]")
_EMOJI = regex.compile(EMOJI)
#: Java pattern of texts that may have an entry; the transducer leaves every other text as it is.
TRIGGER = r"[^ -~\n\r\tÀ-ÏÑ-ïñ-\u0130\u0132-\u0188\u018A-ɏẠ-ỹ가-힣一-鿿ぁ-\u3098\u309B-ヾ、-】‐-―‘-‟…·«»°♪]"


def canonical(text: str) -> str:
    """The usual form of a text, in one pass over its grapheme clusters. Idempotent; an empty text stays empty."""
    pattern, word, latin, foreign = _patterns()
    out, done = [], 0
    words: _Words | None = None
    for m in pattern.finditer(text):
        cluster, at = m.group(), m.start()
        if _of_emoji(cluster):
            continue
        parts, k = [], 0
        while k < len(cluster):
            target, end = _longest(cluster, k)
            c = cluster[k]
            if target is not None and end == k + 1 and c in LOOKALIKES and c not in _ETH:
                words = words or _Words(text, word, latin, foreign)
                target = target if words.stand_in(at + k, c) else c
            elif (0xFF01 <= ord(c) <= 0xFF20 or c == "　") and not c.isalnum() and _east_asian(text, at + k):
                target = c
            parts.append(c if target is None else target)
            k = max(end, k + 1)
        new = "".join(parts)
        if not unicodedata.is_normalized("NFC", new):  # marks that the tree has no entry for
            new = unicodedata.normalize("NFC", new)
        if new != cluster:
            out += [text[done:at], new]
            done = m.end()
    return "".join([*out, text[done:]])


def _longest(cluster: str, k: int) -> tuple[str | None, int]:
    """Target and end of the longest entry that begins at k."""
    node, target, end = transducer(), None, k
    for j in range(k, len(cluster)):
        if (node := node.get(cluster[j])) is None:
            break
        if None in node:
            target, end = node[None], j + 1
    return target, end


def _of_emoji(cluster: str) -> bool:
    """Whether the joiners of a cluster belong to an emoji or a keycap."""
    joined = [k for k, c in enumerate(cluster) if c in JOINERS]
    return bool(joined) and (bool(_EMOJI.search(cluster)) or (joined[0] > 0 and cluster[joined[0] - 1] in "#*0123456789" and cluster[joined[0]] == "️"))


def _east_asian(text: str, i: int) -> bool:
    """Stands beside Chinese or Japanese text, in which such signs are usual."""
    return any(0 <= k < len(text) and _HAN_KANA.match(text[k]) and text[k] not in "！，．：；？（）－" for k in (i - 1, i + 1))


class _Words:
    """Words of a text with letters of other scripts or look-alikes, and whether these stand in for Latin letters."""

    def __init__(self, text, word, latin, foreign):
        self.starts, own, other_any = [], [], False
        for m in word.finditer(text):
            w = m.group()
            letters = foreign.findall(w)
            if not letters:
                continue
            mixed = bool(latin.search(w)) and any(c in LOOKALIKES for c in letters)
            alike = all(c in LOOKALIKES for c in letters)
            other_any |= not alike and not mixed
            self.starts.append(m.start())
            own.append((m.end(), mixed, alike and len(letters) > 1))
        has_latin = bool(latin.search(text))
        self.words = [(e, mixed or (alike and has_latin and not other_any)) for e, mixed, alike in own]
        self.turkish = bool(_TURKISH.search(text))

    def stand_in(self, i: int, c: str) -> bool:
        k = bisect.bisect_right(self.starts, i) - 1
        return k >= 0 and i < self.words[k][0] and self.words[k][1] and not (c == "ı" and self.turkish)


#: Letters beside which a dotless i is usual.
_TURKISH = regex.compile("[ğşİĞŞ]")


def changed_batches(batches):
    """Arrow batches (id, field, text) -> those whose usual form differs and that are not garbled, with that form."""
    from .mojibake import garbled

    for b in batches:
        texts = b.column(2).to_pylist()
        forms = [canonical(t) for t in texts]
        at = [i for i, (t, f) in enumerate(zip(texts, forms, strict=True)) if t != f]
        bad = garbled([texts[i] for i in at]) if at else []
        at = [i for i, g in zip(at, bad, strict=True) if not g]
        take = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array([forms[i] for i in at], pa.string())], ["pair_id", "field", "canonical"])
