"""Text read with a wrong encoding: a hidden Markov model labels characters, spans are decoded back.

One state is clean text, one state stands for each pair of encodings (and two for characters that were
lost, as U+FFFD or as question marks). A state emits a character given the one before it; the tables are
counted on generated Korean, Vietnamese and other text sent forward through the same pairs, so the model
is the same for every input and size. Viterbi runs over whole texts, many at once.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

# The encodings by which single bytes were misread, and the chains (right encoding, wrong encoding), ... seen.
CHAINS = {
    "utf8_as_latin1": (("utf-8", "latin-1"),),
    "utf8_as_cp1252": (("utf-8", "cp1252"),),
    "utf8_as_cp1258": (("utf-8", "cp1258"),),
    "utf8_as_macroman": (("utf-8", "mac_roman"),),
    "utf8_as_cp437": (("utf-8", "cp437"),),
    "utf8_as_cp850": (("utf-8", "cp850"),),
    "utf8_as_cp949": (("utf-8", "cp949"),),
    "utf8_as_gbk": (("utf-8", "gbk"),),
    "utf8_as_cp932": (("utf-8", "cp932"),),
    "utf8_twice_cp1252": (("utf-8", "cp1252"), ("utf-8", "cp1252")),
    "utf8_cp1252_latin1": (("utf-8", "cp1252"), ("utf-8", "latin-1")),
    "utf8_latin1_cp1252": (("utf-8", "latin-1"), ("utf-8", "cp1252")),
    "utf8_twice_latin1": (("utf-8", "latin-1"), ("utf-8", "latin-1")),
    "cp949_as_cp1252": (("cp949", "cp1252"),),
    "cp949_as_gbk": (("cp949", "gbk"),),
    "cp949_as_cp932": (("cp949", "cp932"),),
    "utf8_as_cp1251": (("utf-8", "cp1251"),),
    "cp1258_as_cp1252": (("cp1258", "cp1252"),),
    "tcvn3_as_cp1252": (("tcvn3", "cp1252"),),
    "vni_as_cp1252": (("vni", "cp1252"),),
    "lost_replacement": (),
    "lost_question": (),
}
STATES = ["clean", *CHAINS]
WIDE = ("cp949", "gbk", "cp932")
#: Characters that go through Viterbi at once, about.
CELLS = 1 << 21
SWITCH_IN, SWITCH_OUT = np.log(1e-3), np.log(0.05)

# Vietnamese letters of older encodings: in TCVN3 a byte for each, small letters and the capitals it has; in VNI
# a vowel is followed by the byte of its marks (tone, and the vowel's own mark with it).
_TONED = "áàảãạắằẳẵặấầẩẫậéèẻẽẹếềểễệíìỉĩịóòỏõọốồổỗộớờởỡợúùủũụứừửữựýỳỷỹỵ"
_TCVN3 = dict(zip("ăâđêôơưĂÂÊÔƠƯĐ" + _TONED, "¨©®ª«¬\xad¡¢£¤¥¦§" + "¸µ¶·¹¾»¼½ÆÊÇÈÉËÐÌÎÏÑÕÒÓÔÖÝ×ØÜÞãßáâäèåæçéíêëìîóïñòôøõö÷ùýúûüþ", strict=True))
_VNI_WHOLE = dict(zip("đíìỉĩịơưỵ", "ñíìæóòôöî", strict=True))
_VNI_MARKS = {"": "ùøûõï", "\u0306": "éèúüë", "\u0302": "áàåãä"}
_TONES = "\u0301\u0300\u0309\u0303\u0323"

#: Characters no garbled span can do without another kind: a text of these alone, with no suspect pair, stays clean.
VIETNAMESE = "".join(sorted({unicodedata.normalize("NFC", v + m + t) for v in "aeiouyAEIOUY" for m in ("", "̂", "̆", "̛") for t in ("", "̀", "́", "̃", "̉", "̣") if len(unicodedata.normalize("NFC", v + m + t)) == 1} | set("đĐ") - {" "}))
_SAFE_CLASS = r" !-~\n\r\tđĐăĂơƠưƯẠ-ỹ" + "".join(sorted(c for c in VIETNAMESE if 0xC0 <= ord(c) < 0x180)) + r"가-힣‘’“”…–"
#: Java and Python regular expression of texts that the model has to look at.
SUSPECT = rf"[^{_SAFE_CLASS}]|\?[A-Za-z?À-ỹ]|[A-Za-zÀ-ỹ][가-힣]|[a-zà-ỹ][ÌÒ]|[aeioâêôãõýy]ì|[aeoâêôãõýuy]ò"


@lru_cache(1)
def _byte_maps() -> dict[str, list[str]]:
    """Of each single-byte encoding, the character of each byte; a byte it leaves open is read as a control character."""
    out = {}
    for name in ("latin-1", "cp1251", "cp1252", "cp1258", "mac_roman", "cp437", "cp850"):
        row = []
        for b in range(256):
            try:
                row.append(bytes([b]).decode(name) if b > 127 else chr(b))
            except UnicodeDecodeError:
                row.append(chr(b))
        out[name] = row
    return out


@lru_cache(1)
def _letters() -> dict[str, dict[str, bytes]]:
    """Of each encoding that spreads Vietnamese letters over bytes its own way, the bytes of each letter that isn't ASCII."""
    out: dict[str, dict[str, bytes]] = {"tcvn3": {c: t.encode("latin-1") for c, t in _TCVN3.items()}, "vni": {c: t.encode("latin-1") for c, t in _VNI_WHOLE.items()}, "cp1258": {}}
    for c in VIETNAMESE:
        base, *marks = unicodedata.normalize("NFD", c)
        tone = "".join(m for m in marks if m in _TONES)
        shape = unicodedata.normalize("NFC", base + "".join(m for m in marks if m not in _TONES))
        try:
            out["cp1258"][c] = (shape + tone).encode("cp1258")
        except UnicodeEncodeError:
            pass
        low = out["vni"].get(c.lower())
        if low:
            out["vni"].setdefault(c, low.decode("latin-1").upper().encode("latin-1"))
            continue
        own = next((m for m in marks if m in ("\u0306", "\u0302")), "")
        horn = "\u031b" in marks
        stem = out["vni"][{"o": "ơ", "u": "ư"}[base.lower()]].decode("latin-1") if horn else base.lower()
        mark = _VNI_MARKS[own][_TONES.index(tone)] if tone else {"\u0306": "ê", "\u0302": "â"}.get(own, "")
        if mark:
            vni = stem + mark
            out["vni"][c] = (vni.upper() if c != c.lower() else vni).encode("latin-1")
    for c, b in list(out["tcvn3"].items()):  # capitals with a tone are written as small ones
        out["tcvn3"].setdefault(c.upper(), b)
    return out


@lru_cache(8)
def _readers(name: str) -> tuple[re.Pattern, dict[bytes, str]]:
    """Pattern of the byte sequences of a letter, long ones first, and the letter of each."""
    back: dict[bytes, str] = {}
    for c, b in _letters()[name].items():
        back.setdefault(b, c)
    if name == "cp1258":  # a capital's mark is the same byte
        back = {b: unicodedata.normalize("NFC", b.decode("cp1258")) for b in back}
    return re.compile(b"|".join(map(re.escape, sorted(back, key=len, reverse=True)))), back


def _encoded(text: str, right: str) -> bytes:
    own = _letters().get(right)
    if own is None:
        return text.encode(right, "replace")
    return b"".join(own[c] if c in own else c.encode("cp1252", "ignore") for c in text)


@lru_cache(1)
def _back_maps() -> dict[str, dict[str, int]]:
    return {name: {c: b for b, c in reversed(list(enumerate(row)))} for name, row in _byte_maps().items()}


def misread(text: str, state: str) -> str:
    """Send text through the encodings of a state."""
    for right, wrong in CHAINS[state]:
        raw = _encoded(text, right)
        text = raw.decode(wrong, "replace") if wrong in WIDE else "".join(map(_byte_maps()[wrong].__getitem__, raw))
    return text


def undo(span: str, state: str) -> tuple[str, bool]:
    """The text a span had, and whether all of it could be recovered. Characters that clean text holds stay where no sequence decodes."""
    whole = bool(CHAINS[state])
    for right, wrong in reversed(CHAINS[state]):
        back = _back_maps().get(wrong)
        raw, at = [], []
        for i, c in enumerate(span):
            code = (bytes([back[c]]) if c in back else b"") if back else _wide_bytes(c, wrong)
            raw.append(code or b"\x00")
            at += [i] * max(1, len(code))
        span = (wrong in WIDE and _strictly(b"".join(raw), right)) or _decode(b"".join(raw), right, span, at)
    span = unicodedata.normalize("NFC", span)
    return span, whole and not _LEFT_OVER.search(span)


#: A character that neither clean text nor a decoded sequence has: part of the span stays lost.
_LEFT_OVER = re.compile("[\x80-\x9f\ufffd\u00a2-\u00a9\u00ac\u00ae-\u00b6\u00b8-\u00bf\u2500-\u25a0\ue000-\uf8ff\u0192\u02c6\u02dc\u2020\u2021\u2030]")
_SEQUENCE = {
    "utf-8": re.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}"),
    "cp949": re.compile(rb"[\x81-\xc8][\x41-\x5a\x61-\x7a\x81-\xfe]|[\xa1-\xfe][\xa1-\xfe]"),
}


def _strictly(raw: bytes, right: str) -> str | None:
    try:
        return raw.decode(right)
    except UnicodeDecodeError:
        return None


def _decode(raw: bytes, right: str, span: str, at: list[int]) -> str:
    """Replace what decodes as whole sequences of the right encoding; keep every other character as it stands."""
    out, done = [], 0
    pattern, letters = _readers(right) if right in _letters() else (_SEQUENCE[right], None)
    for m in pattern.finditer(raw):
        try:
            got = letters[m.group()] if letters else m.group().decode(right)
        except UnicodeDecodeError:
            continue
        first, last = at[m.start()], at[m.end() - 1]
        if first < done:
            continue
        out += [span[done:first], got]
        done = last + 1
    return "".join([*out, span[done:]])


def _wide_bytes(c: str, codec: str) -> bytes:
    try:
        return c.encode(codec)
    except UnicodeEncodeError:
        return b"\xff" if c == "�" else c.encode("utf-8")


# Frequent syllables and characters, from which text is generated that the model is counted on.
KO_FREQUENT = "이다는을에하가고의지사기은한도를니어서로있시습나자인리일대해정전보수들게라제과장것부만주면여원그으까요아동성관회계오안구상용조국문비신경행교학물마와공유화업연래무스식치진선생간세미음분방실체불발트우소내료심설추양건개당적환드후중"
KO_ENDINGS = ("습니다.", "합니다.", "했습니다.", "입니다.", "어요?", "에서는", "에게", "보다", "으로", "하고", "까지", "에 대해서는")
ZH_FREQUENT = "的一是在了有和人这中大为上个国我以要他时来用们生到作地于出就分对成会可主发年动同工也能下过子说产种面而方后多定行学法所民得经十三之进着等部度家电力里如水化高自二理起小物现实加量都两体制机当使点从业本去把性好应开它合还因由其些然前外天政四日那社义事平形相全表间样与关各重新线内数正心反你明看原又么利比或但质气第向道命此变条只没结解问意建月公无系军很情者最立代想已通并提直题党程展五果料象员革位入常文总次品式活设及管特件长求老头基资边流路级少图山统接知较将组见计别她手角期根论运农指几九区强放决西被干做必战先回则任取据处队南给色光门即保治北造百规热领七海口东导器压志世金增争济阶油思术极交受联什认六共权收证改清己美再采转更单风切打白教速花带安场身车例真务具万每目至达走积示议声报斗完类八离华名确才科张信马节话米整空元况今集温传土许步群广石记需段研界拉林律叫且究观越织装影算低持音众书布复容儿须际商非验连断深难近矿千周委素技备半办青省列习响约支般史感劳便团往酸历市克何除消构府称太准精值号率族维划选标写存候毛亲快效斯院查江型眼王按格养易置派层片始却专状育厂京识适属圆包火住调满县局照参红细引听该铁价严"
ONSETS = ("", "b", "c", "ch", "d", "đ", "g", "gi", "h", "k", "kh", "l", "m", "n", "ng", "ngh", "nh", "ph", "qu", "r", "s", "t", "th", "tr", "v", "x")
NUCLEI = ("a", "ă", "â", "e", "ê", "i", "o", "ô", "ơ", "u", "ư", "y", "iê", "ươ", "uô", "oa", "ia", "ưa", "ua")
CODAS = ("", "", "n", "ng", "nh", "m", "t", "c", "p", "ch", "i", "o", "u")
TONES = ("", "", "̀", "́", "̃", "̉", "̣")


class Writer:
    """Generates text from a fixed seed."""

    def __init__(self, seed: int = 7):
        self.r = np.random.default_rng(seed)
        self.ksx = [bytes([a, b]).decode("euc_kr") for a in range(0xB0, 0xC9) for b in range(0xA1, 0xFF)]
        self.gb = [bytes([a, b]).decode("gb2312", "ignore") for a in range(0xB0, 0xF8) for b in range(0xA1, 0xFF)]
        self.gb = [c for c in self.gb if c]
        self.jis = [bytes([a, b]).decode("euc_jp", "ignore") for a in range(0xB0, 0xF4) for b in range(0xA1, 0xFF)]
        self.jis = [c for c in self.jis if c]

    def pick(self, xs):
        return xs[self.r.integers(len(xs))]

    def ko_word(self) -> str:
        w = "".join(self.pick(KO_FREQUENT if self.r.random() < 0.75 else self.ksx) for _ in range(self.r.integers(1, 5)))
        return w + (self.pick(KO_ENDINGS) if self.r.random() < 0.25 else "")

    def vi_word(self) -> str:
        v = self.pick(NUCLEI)
        v = unicodedata.normalize("NFC", v[0] + self.pick(TONES) + v[1:]) if len(v) > 1 and v[0] not in "iươu" else unicodedata.normalize("NFC", v + self.pick(TONES))
        w = self.pick(ONSETS) + v + self.pick(CODAS)
        return w.capitalize() if self.r.random() < 0.12 else w

    def latin_word(self) -> str:
        w = "".join(self.pick("aeiou" if i % 2 else "bdghjkmnprstrlnc") for i in range(self.r.integers(1, 9)))
        w = w.capitalize() if self.r.random() < 0.3 else w
        return "".join(self.pick("éèêàçôîûùïëâœ") if self.r.random() < 0.04 else c for c in w)

    def line(self, kind: str, n: int = 14) -> str:
        r = self.r
        if kind in ("zh", "ja"):
            kana = "あいうえおかがきくけこさしすせそただちつてでとなにぬのはばひふへほまみむめもやゆよらりるれろわをんアイウエオカキクスタテトナニフマメラリルレロンー"
            han = self.jis if kind == "ja" else self.gb
            s = "".join(self.pick(kana) if kind == "ja" and r.random() < 0.5 else self.pick(ZH_FREQUENT if r.random() < 0.5 else han) for _ in range(n + 8))
            return s[:9] + self.pick("，、") + s[9:] + "。"
        if kind == "ru":
            return " ".join("".join(self.pick("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфё") for _ in range(r.integers(1, 9))) for _ in range(n)).capitalize() + "."
        words = []
        for _ in range(n):
            x = r.random()
            w = str(r.integers(1, 3000)) if x < 0.05 else self.latin_word() if x < (0.12 if kind in ("ko", "vi") else 2) else self.ko_word() if kind == "ko" else self.vi_word()
            w = self.pick(("“{}”", "‘{}’", '"{}"', "({})", "{},", "{}…", "- {}", "{}:")).format(w) if r.random() < 0.07 else w
            words.append(w)
        return " ".join(words) + self.pick(".?!")

    def odd(self, s: str) -> str:
        """Oddities of clean text: other spaces, unseen characters, look-alikes, decomposed letters, symbols."""
        r, x = self.r, self.r.integers(9)
        if x == 0:
            return s.replace(" ", self.pick("\xa0　   "))
        if x == 1:
            return "".join(c + self.pick("​‌‍⁠﻿\xad") if r.random() < 0.1 else c for c in s)
        if x == 2:
            return s.translate(str.maketrans("aceopxysijTHBKMPCX", "асеорхуѕіјТНВКМРСХ"))
        if x == 3:
            return s.translate(str.maketrans("oavTBHNMPX", "οανΤΒΗΝΜΡΧ"))
        if x == 4:
            return unicodedata.normalize("NFD", s)
        if x == 5:
            return "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" and r.random() < 0.6 else c for c in s)
        if x == 6:
            return s.translate(str.maketrans("đĐ", self.pick(("ðÐ", "ɖƉ")))) + " ð Ðơn"
        if x == 7:
            return s + " " + self.pick(("👩‍🏫", "👨‍👩‍👧", "❤️", "👍🏽", "♪", "😀")) + " " + self.pick(("Ω", "λ", "Д", "β", "®", "©", "™", "°", "№", "€", "£", "²")) + " «" + s[:9] + "»" + "·" + s[:3]
        return self.pick("♪[(*") + " " + s + " " + self.pick("♪])*") + " — " + s.upper()


@lru_cache(1)
def _clean_lines() -> tuple[list[str], list[str], list[str]]:
    w = Writer()
    ko = [w.line("ko") for _ in range(700)]
    vi = [w.line("vi", 20) for _ in range(700)]
    rest = [w.line(k) for k in ("zh", "ja", "ru", "en") for _ in range(150)]
    return ko, vi, rest


def _lose(s: str, r: np.random.Generator) -> str:
    out = []
    for c in s:
        out.append("�" * int(r.integers(1, 4)) if ord(c) > 127 and r.random() < 0.3 else c)
    return "".join(out)


@lru_cache(1)
def model() -> tuple[np.ndarray, np.ndarray, int]:
    """(class of each code point, log P(class | class before, state) as [before, class, state], number of classes)."""
    ko, vi, rest = _clean_lines()
    w, r = Writer(11), np.random.default_rng(3)
    streams: dict[str, list[str]] = {"clean": [*ko, *vi, *rest, *[w.odd(s) for s in (ko[:400] + vi[:500] + rest[450:]) * 3]]}
    both = ko + vi
    nfd = [unicodedata.normalize("NFD", s) for s in vi[:200]]
    for state in STATES[1:]:
        if state.startswith("cp949"):
            streams[state] = [misread(s, state) for s in ko]
        elif CHAINS[state] and CHAINS[state][0][0] in _letters():
            streams[state] = [misread(s.replace("?", "."), state) for s in vi]  # question marks speak for lost characters
        elif state == "lost_replacement":
            streams[state] = [_lose(s, r) for s in both]
        elif state == "lost_question":
            streams[state] = ["".join("?" if ord(c) > 127 else c for c in s) for s in vi] + [s.encode("ascii", "replace").decode() for s in ko]
        else:
            streams[state] = [misread(s, state) for s in both + (nfd if state == "utf8_as_cp1252" else [])]
    classes, n = _classes()
    emit = np.zeros((n, n, len(STATES)), np.float32)
    for k, state in enumerate(STATES):
        count = np.zeros((n, n))
        for s in streams[state]:
            ids = classes[np.frombuffer((" " + s).encode("utf-32-le"), np.uint32)]
            np.add.at(count, (ids[:-1], ids[1:]), 1)
        uni = (count.sum(0) + 0.02) / (count.sum() + 0.02 * n)
        emit[:, :, k] = np.log((count + 3 * uni) / (count.sum(1, keepdims=True) + 3))
    # a pair that SUSPECT passes over never speaks for a garbled state: what it leaves out stays clean by construction
    safe = _safe_pairs(classes, n)
    emit[safe, 1:] = np.minimum(emit[safe, 1:], emit[safe, :1])
    return classes, emit, n


def _safe_pairs(classes: np.ndarray, n: int) -> np.ndarray:
    import regex

    one = regex.compile(SUSPECT)
    members: dict[int, str] = {}
    for c in [*map(chr, range(32, 127)), "\n", *VIETNAMESE, "다", "뷁", "갂", *"‘’“”…–"]:
        members.setdefault(int(classes[ord(c)]), c)
    ok = np.zeros((n, n), bool)
    for a, x in members.items():
        for b, y in members.items():
            ok[a, b] = not one.search(x + y)
    return ok


@lru_cache(1)
def _classes() -> tuple[np.ndarray, int]:
    """Classes of code points: each character of the single-byte encodings alone, the rest by kind."""
    table = np.zeros(0x110000, np.uint16)
    nxt = [1]

    def group(chars) -> None:
        ids = np.fromiter((ord(c) if isinstance(c, str) else c for c in chars), np.int64)
        table[ids] = nxt[0]
        nxt[0] += 1

    group(range(0xAC00, 0xD7A4))
    w = Writer()
    group(w.ksx)
    group(KO_FREQUENT)
    group(range(0x4E00, 0xA000))
    group(w.gb)
    group(ZH_FREQUENT)
    group({g for c in w.ksx if len(g := misread(c, "cp949_as_gbk")) == 1 and 0x4E00 <= ord(g) < 0xA000} - set(ZH_FREQUENT))
    group({g for c in KO_FREQUENT if len(g := misread(c, "cp949_as_gbk")) == 1 and 0x4E00 <= ord(g) < 0xA000})
    group(range(0xE000, 0xF900))
    group(range(0x3041, 0x30FF))
    group(range(0xFF61, 0xFFA0))
    group(range(0xFF01, 0xFF5F))
    group(range(0x400, 0x530))
    group(range(0x370, 0x400))
    group(range(0x300, 0x370))
    group([*range(0x1100, 0x1200), *range(0x3130, 0x3190)])
    group(range(0x2500, 0x25A0))
    group([*range(0x1F000, 0x1FB00), *range(0x2600, 0x27C0), 0x266A, 0xFE0F])
    group([*range(0x2000, 0x200B), 0x202F, 0x3000])
    group([0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
    group("，。、；：「」《》")
    group("abcdefghijklmnopqrstuvwxyz")
    group("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    group("0123456789")
    for c in map(chr, [9, 10, 13, *range(32, 48), *range(58, 65), *range(91, 97), *range(123, 127)]):
        group(c)
    alone = {c for row in _byte_maps().values() for c in row[128:]} | set("�“”‘’…–")
    letters = set(VIETNAMESE)
    for c in sorted(alone):
        group(c)
    group([c for c in letters if c not in alone and c.islower()])
    group([c for c in letters if c not in alone and c.isupper()])
    return table, nxt[0]


def label(texts: list[str]) -> list[np.ndarray]:
    """State of each character of each text (0: clean), by Viterbi over whole texts."""
    if not texts:
        return []
    classes, emit, _ = model()
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    labels: list[np.ndarray] = [None] * len(texts)
    at = 0
    while at < len(order):
        rows = order[at : at + max(1, min(2048, CELLS // max(int(lengths[order[at]]), 1)))]
        for i, path in zip(rows, _viterbi([texts[i] for i in rows], lengths[rows], classes, emit), strict=True):
            labels[i] = path
        at += len(rows)
    return labels


def _viterbi(texts: list[str], lengths: np.ndarray, classes: np.ndarray, emit: np.ndarray) -> list[np.ndarray]:
    """texts come longest first."""
    n, width, k = len(texts), int(lengths[0]), emit.shape[2]
    if width == 0:
        return [np.zeros(0, np.uint8) for _ in texts]
    ids = np.full((n, width + 1), classes[32], np.intp)
    flat = classes[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    ids[:, 1:][np.arange(width) < lengths[:, None]] = flat
    stay_out = np.log1p(-(k - 1) * np.exp(SWITCH_IN))
    stay_in = np.log1p(-np.exp(SWITCH_OUT))
    v = np.full((n, k), SWITCH_IN)
    v[:, 0] = stay_out
    to_clean = np.zeros((width, n), np.uint8)
    entered = np.zeros((width, n, (k + 6) // 8), np.uint8)  # a bit a state
    last = np.zeros((n, k))
    active = np.searchsorted(-lengths, -np.arange(1, width + 1), side="right")
    for t in range(width):
        m = active[t]
        e = emit[ids[:m, t], ids[:m, t + 1]]
        if t:
            cur = v[:m]
            best = cur[:, 1:].argmax(1)
            back = cur[np.arange(m), best + 1] + SWITCH_OUT
            out = cur[:, 0] + stay_out
            to_clean[t, :m] = np.where(back > out, best + 1, 0)
            enter = (cur[:, 0] + SWITCH_IN)[:, None]
            stay = cur[:, 1:] + stay_in
            entered[t, :m] = np.packbits(enter > stay, axis=1)
            v[:m, 1:] = np.maximum(enter, stay)
            v[:m, 0] = np.maximum(out, back)
        v[:m] += e
        done = m if t + 1 == width else active[t + 1]
        last[done:m] = v[done:m]
    state = last.argmax(1)
    path = np.zeros((n, width), np.uint8)
    rows = np.arange(n)
    for t in range(width - 1, -1, -1):
        m = active[t]
        s = state[:m]
        path[:m, t] = s
        if t:
            k_ = np.maximum(s, 1) - 1
            came = entered[t, rows[:m], k_ >> 3] >> (7 - (k_ & 7)) & 1
            state[:m] = np.where(s > 0, np.where(came, 0, s), to_clean[t, :m])
    return [path[i, :m] for i, m in enumerate(lengths)]


def repair(text: str, states: np.ndarray) -> tuple[str | None, list[str]]:
    """The text with every garbled span turned back, None if part of it is lost; the states that occur.

    A span reaches to the blanks around it, and the states of the single-byte encodings, which share most characters,
    are tried beside its own where that one leaves something over.
    """
    out, whole, done = [], True, 0
    found = [STATES[k] for k in dict.fromkeys(states.tolist()) if k]
    for m in re.finditer("[^ \n]+(?: +[^ \n]+)*", text):
        kinds = [STATES[k] for k in dict.fromkeys(states[m.start() : m.end()].tolist()) if k]
        if not kinds:
            continue
        span, good = min((undo(m.group(), k) for k in kinds), key=lambda x: (not x[1], len(_LEFT_OVER.findall(x[0]))))
        if not good:
            others = [k for k in CHAINS if CHAINS[k] and CHAINS[k][0][0] == (CHAINS[kinds[0]] or (("",),))[0][0] and k not in kinds]
            span, good = min([(span, good), *(undo(m.group(), k) for k in others)], key=lambda x: (not x[1], len(_LEFT_OVER.findall(x[0]))))
        out += [text[done : m.start()], span]
        done, whole = m.end(), whole and good
    return ("".join([*out, text[done:]]) if whole else None), found


#: What a span of these states has, beside letters that usual text may have alone (an eth for a d with stroke, a soft hyphen,
#: a look-alike): a mark after its vowel, a sign inside a word.
_PROOF = {
    "cp1258_as_cp1252": re.compile("[aeioyâêôãõýAEIOYÂÊÔÃÕÝ][ÌÒÞìò]|[uU][ÌÒÞò]|[UÝ]ì"),
    "tcvn3_as_cp1252": re.compile("[A-Za-z®§][¸µ¶·¹¨¾»¼½©ª«¬Æ]|[®¬¨©ª«][a-z]"),
    "vni_as_cp1252": re.compile("[aeiouyôöAEIOUYÔÖ][ùøûõïêéèúüëâáàåãäÙØÛÕÏÊÉÈÚÜËÂÁÀÅÃÄ]|ñ[aeiouyôö]"),
}


def _proven(span: str, state: str) -> bool:
    if state in _PROOF:
        return bool(_PROOF[state].search(span))
    if state == "utf8_as_cp1251":
        return any(c in VIETNAMESE or "가" <= c <= "힣" for c in undo(span, state)[0] if c not in span)
    return True


def _confirmed(text: str, states: np.ndarray) -> bool:
    """Some labelled span decodes to other text, has lost characters, or question marks inside words."""
    for m in re.finditer("[^ \n]+(?: +[^ \n]+)*", text):
        for k in dict.fromkeys(states[m.start() : m.end()].tolist()):
            if not k:
                continue
            if STATES[k] == "lost_replacement":
                if "�" in m.group():
                    return True
            elif STATES[k] == "lost_question":
                marks = [t.start() for t in re.finditer(r"\?", m.group()) if states[m.start() + t.start()] == k]
                if len(marks) > 1:
                    return True
            else:
                at = np.flatnonzero(states[m.start() : m.end()] == k) + m.start()
                lo, hi = text.rfind(" ", 0, at[0]) + 1, text.find(" ", at[-1])
                span = text[lo : hi if hi >= 0 else len(text)]
                if _proven(span, STATES[k]) and unicodedata.normalize("NFC", span) != undo(span, STATES[k])[0]:
                    return True
    return False


def paths(texts: list[str]) -> list[np.ndarray]:
    """Labels of texts, all clean where no labelled span is confirmed by decoding it."""
    out = label(texts)
    for i, p in enumerate(out):
        if p.any() and not _confirmed(texts[i], p):
            out[i] = np.zeros_like(p)
    return out


def garbled(texts: list[str]) -> np.ndarray:
    """Whether each text is garbled somewhere."""
    return np.array([bool(p.any()) for p in paths(texts)], bool)


def found_batches(batches):
    """Arrow batches (id, field, text) of suspect texts -> (id, field, encodings, restored) of the garbled ones."""
    for b in batches:
        texts = b.column(2).to_pylist()
        ids, fields, encodings, restored = [], [], [], []
        for i, path in enumerate(paths(texts)):
            if path.any():
                fixed, states = repair(texts[i], path)
                ids.append(b.column(0)[i].as_py())
                fields.append(b.column(1)[i].as_py())
                encodings.append(states)
                restored.append(fixed)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fields, pa.string()), pa.array(encodings, pa.list_(pa.string())), pa.array(restored, pa.string())], ["pair_id", "field", "encodings", "restored"])
