"""Prompt and response pairs whose response is no proper answer.

A response is parsed by a pushdown automaton (fences, brackets, quotations, markup, list items, sentences) for what it
leaves open, compared with the prompt by greedy string tiling, tried against a grammar of refusals, and its script and
syllables tell whether any of it is Vietnamese. The first defect of DEFECTS that applies counts.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import regex

from .canonical import TRIGGER, canonical
from .mojibake import SUSPECT, garbled

DEFECTS = ("empty", "refusal", "copied", "other_language", "truncated")

# What stands in an answer's place, and letters that of the languages here only Vietnamese has.
PLACEHOLDERS = {"n/a", "na", "null", "none", "nan", "nil", "tbd", "todo"}
VIETNAMESE_ONLY = "[ăđơưĂĐƠƯẠ-ỹ]"

# The words of refusals: inability, an act of an assistant, the text it was given; for a thing that could be
# anything ("this", "that"), the assistant itself, too.
_VI_UNABLE = "(?:không thể|chưa thể|không được phép|chưa được phép|không có khả năng|từ chối|xin phép không|không hỗ trợ|khong the|chua the|khong duoc phep|khong co kha nang|tu choi)"
_VI_ACT = "(?:hỗ trợ |giúp (?:bạn )?|thực hiện việc |thực hiện |ho tro )?(?:dịch thuật|phiên dịch|dịch|chuyển ngữ|trả lời|xử lý|bình luận|đáp ứng|thực hiện|hỗ trợ|giúp|cung cấp bản dịch|dich|chuyen ngu|tra loi|xu ly|ho tro)"
_VI_OBJECT = "(?:về |cho |với |loại )?(?:nội dung|yêu cầu|câu|đoạn văn|đoạn|văn bản|bài|noi dung|yeu cau|cau|doan van|van ban)(?: (?:này|trên|được gửi|đã gửi|bạn gửi|đó|nay|tren|duoc gui|da gui))"
_VI_SELF = "(?:tôi|mình|em|chúng tôi|toi|minh|chung toi)(?: rất tiếc| xin lỗi)?(?: nhưng)?"
_VI_HELP = "(?:giúp đỡ|giúp|hỗ trợ|thực hiện|đáp ứng|làm|giup|ho tro|thuc hien|lam)(?: (?:bạn|quý vị|anh|chị|ban))?(?: (?:với|về|trong|cho|làm))?"
_VI_THING = "(?:việc|điều|chuyện|viec|dieu|chuyen) (?:này|đó|ấy|nay|do)"
_EN_UNABLE = "(?:cannot|can ?not|can['’]t|could not|am unable to|['’]m unable to|am not able to|['’]m not able to|am not allowed to|['’]m not allowed to|must decline to|decline to|refuse to|won['’]t|will not)"
_EN_ACT = "(?:translate|answer|process|help|comment|respond|assist|complete|fulfil|provide a translation)"
_EN_OBJECT = "(?:with |on |to |of |for )?(?:this|that|the|your) (?:\\w+ ){0,3}?(?:request|sentence|passage|text|content|message|question|input|material)"
_EN_HELP = "(?:(?:help|assist)(?: you)? with|translate|answer|do)"
_EN_THING = "(?:this|that|it|so)(?= *(?:[.,!?;]|$))"
_KO_OBJECT = "(?:이|위|해당|그|보내 주신|보내주신|요청하신) ?(?:문장|글|요청|내용|텍스트|질문)"
_KO_UNABLE = "(?:번역|답변|처리|응답)?(?:을|를|이|가|은|는)? ?(?:도와드릴 수 없|도와 드릴 수 없|드릴 수 없|해 드릴 수 없|해드릴 수 없|할 수 없|해 드리기 어렵|해드리기 어렵|드리기 어렵|불가능|거부|거절)"
_KO_THING = "(?:그건|이건|그것은|이것은|그 일은|이 일은|그 부분은|이 부분은)(?: 제가)? ?(?:도와드릴 수 없|도와 드릴 수 없|해 드릴 수 없|해드릴 수 없)"
REFUSAL = regex.compile(
    rf"{_VI_UNABLE} {_VI_ACT} {_VI_OBJECT}|\bI(?:'m sorry[^.]*?)? ?(?:\w+ )?{_EN_UNABLE} {_EN_ACT} {_EN_OBJECT}|{_KO_OBJECT}(?:은|는|을|를|에 대해서는|에 대해)? ?{_KO_UNABLE}",
    regex.I,
)
#: Refusals of "this" or "that": a translation of a prompt that says so itself reads the same.
LOOSE = regex.compile(rf"\b{_VI_SELF} {_VI_UNABLE} {_VI_HELP} {_VI_THING}|\bI(?:'m sorry[^.]*?)? ?(?:\w+ )?{_EN_UNABLE} {_EN_HELP} {_EN_THING}|{_KO_THING}", regex.I)
#: What such a prompt says.
DECLINES = regex.compile("없|못|않|어렵|어려|불가|거부|거절|không|chưa|từ chối|\\bnot\\b|n['’]t\\b|cannot|unable|decline|refuse", regex.I)
#: Java pattern of every text that REFUSAL or LOOSE can match.
REFUSAL_HINT = r"(?iu)(không|chưa|từ chối|khong|chua|tu choi)[^.]*?(nội dung|yêu cầu|câu|đoạn|văn bản|bài|việc|điều|chuyện|noi dung|yeu cau|cau|doan van|van ban|viec|dieu|chuyen)|\b(request|sentence|passage|text|content|message|question|input|material|this|that|it|so)\b|(없|어렵|불가능|거부|거절)"

_HINT = regex.compile(REFUSAL_HINT)
_OPENERS = {"“": "”", "‘": "’", "«": "»", "「": "」", "『": "』", "(": ")", "[": "]", "{": "}", "（": "）"}
_CLOSERS = {v: k for k, v in _OPENERS.items()}


def open_frames(text: str, sentences: bool = False) -> list[str]:
    """What a text leaves open, outermost first: quotations, brackets, fences, tags, or a list item without content.

    With `sentences`, a sentence is a frame, too: its first word opens it, its end sign closes it, dots make it 'dots'. A
    closing sign that nothing opened is passed over, as apostrophes and emoticons are; one right after an end sign ends the
    sentence around it, and one before it leaves the sentence open outside.
    """
    stack: list[str] = []
    told = ""  # 'full' or 'dots' right after an end sign

    def close(at: int) -> None:
        nonlocal told
        inside = any(f in _SENTENCE for f in stack[at:])
        del stack[at:]
        if told and stack and stack[-1] in _SENTENCE:
            stack[-1:] = ["dots"] * (told == "dots")
        elif inside and not told and not (stack and stack[-1] in _SENTENCE):
            stack.append("sentence")

    i = 0
    sign = _TOKEN if sentences else _SIGN
    while (m := sign.search(text, i)) is not None:
        i = m.start()
        c = text[i]
        if c == "`":
            run = len(text[i:]) - len(text[i:].lstrip("`"))
            mark = "`" * run
            if mark in stack:
                told = "full" if run > 2 else told  # a block of code ends the sentence that leads to it
                close(stack.index(mark))
            else:
                stack.append(mark)
            i += run
            continue
        if stack and stack[-1][0] == "`":  # code has no sentences
            i = m.end()
            continue
        if m.group(1):  # a word
            if not stack or stack[-1] not in _SENTENCE:
                stack.append("sentence")
            stack[-1], told, i = "sentence", "", m.end()
            continue
        if m.group(2):  # an end sign
            told = "dots" if _DOTS.search(m.group(2)) else "full"
            if stack and stack[-1] in _SENTENCE:
                stack.pop()
            if told == "dots":
                stack.append("dots")
            i = m.end()
            continue
        if c == '"':
            if '"' in stack:
                close(stack.index('"'))
            else:
                stack.append('"')
        elif c == "<" and (m := _TAG.match(text, i)):
            name = m.group(2).lower()
            if m.group(1):
                if f"<{name}" in stack:
                    close(len(stack) - 1 - stack[::-1].index(f"<{name}"))
            elif not m.group(3) and name not in ("br", "hr", "img"):
                stack.append(f"<{name}")
            i = m.end()
            continue
        elif c in _OPENERS:
            apostrophe = c == "‘" and i and text[i - 1].isalpha()
            emoticon = c in "([" and i and text[i - 1] in ":;="
            if not apostrophe and not emoticon:
                stack.append(c)
        elif c in _CLOSERS and _CLOSERS[c] in stack:
            close(len(stack) - 1 - stack[::-1].index(_CLOSERS[c]))
        i += 1
    if _BARE_ITEM.search(text):
        stack.append("item")
    return stack


_SENTENCE = ("sentence", "dots")
_SIGN = regex.compile("()()[`\"<“‘«「『(\\[{（”’»」』)\\]}）]")
_TOKEN = regex.compile("([\\p{L}\\p{N}][\\p{L}\\p{N}\\p{M}\\s,;:%/-]*)|([.!?。！？…‥]+)|[`\"<“‘«「『(\\[{（”’»」』)\\]}）]")
_TAG = regex.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)[^<>]*?(/?)>")
_BARE_ITEM = regex.compile(r"(?:^|\n|\s)(?:[-*•]|\d{1,2}\.)\s*$")
_TRAIL = regex.compile(r"[\s\p{So}\p{Sk}\p{Cf}\p{M}♪”’»」』\"')\]}）*_`~|]+$")
_END = regex.compile(r"[.!?。！？…‥]$")
_DOTS = regex.compile(r"(?:…|\.\.\.|‥)$")
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_FOLD = regex.compile(r"[^\p{L}\p{N}]+")
#: Korean sentence endings, for prompts that lack the full stop.
_KO_END = regex.compile(r"(?:니다|니까|어요|아요|세요|해요|예요|이에요|지요|시오|했다|한다|된다|이다|있다|없다)$")


def ended(text: str) -> str:
    """'full' for a text that ends its sentence, 'dots' for one that trails off, '' otherwise."""
    t = _TRAIL.sub("", text)
    return "" if not _END.search(t) else "dots" if _DOTS.search(t) else "full"


def unfinished(text: str) -> str:
    """The innermost frame that a text leaves open: 'sentence', 'dots', or that of its last sentence's end; '' for none.

    Single quotation marks are left out, since apostrophes look alike."""
    frames = [f for f in open_frames(text, sentences=True) if f not in ("item", "‘", "`")]
    return frames[-1] if frames else ""


def complete(prompt: str) -> bool:
    return (bool(_WORD.search(prompt)) and unfinished(prompt) not in _SENTENCE) or bool(_KO_END.search(_TRAIL.sub("", prompt)))


def truncated(prompt: str, response: str) -> bool:
    """The response breaks off while the prompt is whole."""
    what = unfinished(response)
    return bool(what) and complete(prompt) and (what in _SENTENCE or not [f for f in open_frames(prompt) if f not in ("item", "‘", "`")])


def tiled(a: str, b: str, least: int = 4) -> float:
    """Share of the longer text that greedy string tiling covers with common stretches of at least `least` characters."""
    a, b = _FOLD.sub("", a).casefold(), _FOLD.sub("", b).casefold()
    if not a or not b or 2 * len(set(a) & set(b)) < len(set(b)):
        return 0.0
    if min(len(a), len(b)) < 0.8 * max(len(a), len(b)):
        return 0.0
    grams: dict[str, list[int]] = {}
    for j in range(len(b) - least + 1):
        grams.setdefault(b[j : j + least], []).append(j)
    used_a, used_b, covered = bytearray(len(a)), bytearray(len(b)), 0
    while True:
        best = (0, 0, 0)
        i = 0
        while i + least <= len(a):
            step = 1
            if not used_a[i]:
                for j in grams.get(a[i : i + least], ()):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not used_a[i + k] and not used_b[j + k]:
                        k += 1
                    if k > best[0]:
                        best, step = (k, i, j), max(step, k - least)
            i += step
        k, i, j = best
        if k < least:
            return covered / max(len(a), len(b))
        used_a[i : i + k] = b"\x01" * k
        used_b[j : j + k] = b"\x01" * k
        covered += k


_SYLLABLE = regex.compile(r"(?:ngh|ng|nh|gh|gi|kh|ph|th|tr|ch|qu|[bcdghklmnprstvx])?(?:uye|uya|uyu|oai|oao|oay|uay|ieu|yeu|uoi|uou|ia|ie|io|iu|oa|oe|oi|oo|ua|ue|ui|uo|uu|uy|ai|ao|au|ay|eo|eu|ye|oe|[aeiouy])(?:ng|nh|ch|[cmnpt])?")
_FOREIGN = regex.compile(r"[\p{Hangul}\p{Han}\p{Hiragana}\p{Katakana}\p{Cyrillic}]")


def speaks_vietnamese(text: str) -> bool | None:
    """Whether some of a text is Vietnamese, written with or without accents; None if it has too few words to tell."""
    if regex.search(VIETNAMESE_ONLY, text):
        return True
    words = regex.findall(r"\p{Latin}[\p{Latin}'’]*", text)
    plain = [w for w in words if w.islower() or text.isupper()]
    foreign = len(_FOREIGN.findall(text))
    if len(plain) < 3:
        return False if foreign >= 4 and foreign > sum(map(len, plain)) else None
    shaped = sum(bool(_SYLLABLE.fullmatch(w.lower())) for w in plain)
    return shaped >= 0.8 * len(plain)


def empty(response: str | None) -> bool:
    if response is None:
        return True
    return not _WORD.search(response) or response.strip().strip(".").casefold() in PLACEHOLDERS


_TRIGGER = regex.compile(TRIGGER)
_SUSPECT = regex.compile(SUSPECT)


def defects(prompts: list[str | None], responses: list[str | None]) -> list[str | None]:
    """The defect of each pair, None for a proper one. A null prompt counts as an empty one, a null response as empty."""
    out: list[str | None] = []
    doubtful: list[int] = []
    for i, (p, r) in enumerate(zip(prompts, responses, strict=True)):
        p = p or ""
        if empty(r):
            out.append("empty")
            continue
        r2 = canonical(r) if _TRIGGER.search(r) else r
        p2 = canonical(p) if _TRIGGER.search(p) else p
        kind = None
        if _HINT.search(r2) and (REFUSAL.search(r2) or (LOOSE.search(r2) and not DECLINES.search(p2))):
            kind = "refusal"
        elif _WORD.search(p2) and len(_FOLD.sub("", p2)) > 3 and tiled(p2, r2) >= 0.9:
            kind = "copied"
        elif speaks_vietnamese(r2) is False:
            kind = "other_language"
        elif truncated(p2, r2):
            kind = "truncated"
        if kind in ("other_language", "truncated") and _SUSPECT.search(r):
            doubtful.append(i)
        out.append(kind)
    if doubtful:  # garbled text is a matter of its encoding
        for i, bad in zip(doubtful, garbled([responses[i] for i in doubtful]), strict=True):
            if bad and (out[i] == "other_language" or ended(responses[i]) != "" or not responses[i][-1:].isascii()):
                out[i] = "truncated" if out[i] == "other_language" and not ended(responses[i]) and complete(prompts[i] or "") and responses[i][-1:].isascii() else None
    return out


def needs_parsing(prompt, response):
    """Spark condition that leaves out only pairs in which `defects` could find none: the response is in part Vietnamese,
    ends its sentence, opens no frame and has no word of a refusal, the prompt is in another language, and both are in their usual form."""
    from pyspark.sql import functions as F

    sound = (
        response.rlike(VIETNAMESE_ONLY)
        & response.rlike(r"(?<![.])[.!?][”’»\"')\]]*$")
        & ~response.rlike(r"[`<{\[(“«「\"]")
        & ~response.rlike(REFUSAL_HINT)
        & ~response.rlike(TRIGGER)
        & ~F.coalesce(prompt, F.lit("")).rlike(TRIGGER)
        & ~F.coalesce(prompt, F.lit("")).rlike(VIETNAMESE_ONLY)
    )
    return ~F.coalesce(sound, F.lit(False))


@lru_cache(1)
def _schema():
    return pa.schema([("rec_table", pa.string()), ("rec_id", pa.int64()), ("sample_no", pa.int64()), ("defect", pa.string())])


def defect_batches(batches):
    """Arrow batches (rec_table, rec_id, sample_no, prompt, response) -> defective pairs with their defect."""
    for b in batches:
        kinds = defects(b.column(3).to_pylist(), b.column(4).to_pylist())
        at = pa.array([i for i, k in enumerate(kinds) if k], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), pa.array([k for k in kinds if k], pa.string())], schema=_schema())
