"""Column functions on one text. All are native expressions; null in gives null out unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.split and \s see it.
WS = "[\t-\r\x1c-\x20\x85\xa0  -     　]"
WORD = f"[^{WS[1:]}+"
# Patterns of boilerplate, whole texts that say nothing, words that mark a literal translation.
BOILERPLATE = (r"\[.*?\]", r"\(.*?\)", r"♪+", r"www\.", r"http[s]?://", r"subscribe", r"episode \p{Nd}+", rf"^{WS}*[A-Z]:{WS}*", r"^\p{Nd}{1,2}:\p{Nd}{2}", rf"^-+{WS}*$")
USELESS = ("ㅋㅋ", "ㅎㅎ", "응", "아", "예", "네", "ờ", "ừ", "à", "ô")
LITERAL_MARKERS = ("các", "những", "một", "cái", "này", "đó")
# Language codes of the two fields.
LANGUAGE_CODES = {"kor_Hang": "ko", "vie_Latn": "vi"}

HANGUL = "[ᄀ-ᇿ㄰-㆏가-힣]"
VIETNAMESE = "[ăâđêôơưĂÂĐÊÔƠƯạ-ỹẠ-Ỹàáãèéìíòóõùúýĩũ]"


def normalized(t: Column) -> Column:
    """Lower case, white space collapsed to one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(t), f"{WS}+", " "))


def words(t: Column) -> Column:
    return F.filter(F.split(t, f"{WS}+"), lambda x: x != "")


def word_count(t: Column) -> Column:
    return F.regexp_count(t, F.lit(WORD)).cast("bigint")


def char_length(t: Column) -> Column:
    """Code points."""
    return F.length(t).cast("bigint")


def length_ratio(src: Column, tgt: Column) -> Column:
    """Words of tgt per word of src; null if src has none."""
    return F.try_divide(word_count(tgt).cast("double"), word_count(src).cast("double"))


def numbers(t: Column) -> Column:
    return F.regexp_extract_all(t, F.lit(r"\p{Nd}+"), F.lit(0))


def number_divergence(src: Column, tgt: Column) -> Column:
    """Difference of the two counts of numbers by the greater one; 0 if neither text has any. Values don't matter."""
    a, b = F.size(numbers(src)).cast("double"), F.size(numbers(tgt)).cast("double")
    return F.coalesce(F.try_divide(F.abs(a - b), F.greatest(a, b)), F.when(src.isNotNull() & tgt.isNotNull(), 0.0))


def punctuation_density(t: Column) -> Column:
    """Share of punctuation among code points; null for an empty text."""
    return F.try_divide(F.regexp_count(t, F.lit(r"\p{P}")).cast("double"), F.length(t).cast("double"))


def boilerplate(t: Column) -> Column:
    return t.rlike("(?iud)" + "|".join(BOILERPLATE))


def useless(t: Column) -> Column:
    """The text as it stands, in lower case, is a phrase without content."""
    return F.lower(t).isin(*USELESS)


def language_code(code: Column) -> Column:
    """Short code of a language; other codes pass through."""
    out = code
    for long, short in LANGUAGE_CODES.items():
        out = F.when(code == long, short).otherwise(out)
    return out


def threshold_label(t: Column) -> Column:
    """Hundredths of a threshold, cut off, not rounded."""
    return (t * 100).cast("int")


def mixed_language(t: Column) -> Column:
    """Has conjoining Hangul letters; composed syllables don't count."""
    return t.rlike("[ᄁ-ᇾ]")


def literal_score(t: Column) -> Column:
    """How many of the marker words occur somewhere in the text, as parts of words too."""
    low = F.lower(t)
    return sum((F.contains(low, F.lit(m)).cast("int") for m in LITERAL_MARKERS), F.lit(0)).cast("bigint")


def language_probability(t: Column, lang: str) -> Column:
    """Probability, by script, that a text is in a language; null without letters, and for languages other than ko and vi.

    ko: share of Hangul among letters. vi: share of Latin letters, scaled down where less than a tenth of them carry
    Vietnamese marks. These are this engine's own figures, not those of a trained detector.
    """
    # what is left when runs of all else are taken out is counted faster than its characters are one by one
    number = lambda kind: F.length(F.regexp_replace(t, f"[^{kind}]+", "")).cast("double")
    letters = number(r"\p{L}")
    if lang == "ko":
        return F.try_divide(number(HANGUL[1:-1]), letters)
    if lang != "vi":
        return F.lit(None).cast("double")
    latin = number(r"\p{IsLatin}")
    marks = number(VIETNAMESE[1:-1])
    return F.try_divide(latin, letters) * F.least(F.lit(1.0), F.coalesce(F.try_divide(marks * 10, latin), F.lit(0.0)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors of equal length, in double; null for a zero vector."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, norm(a) * norm(b))


def clipped_ids(ids: Column, vocabulary: int, pad: int = 1, ignored: int = -100) -> Column:
    """Token ids with the ignored label as padding and all within the vocabulary."""
    return F.transform(ids, lambda x: F.least(F.greatest(F.when(x == ignored, pad).otherwise(x), F.lit(0)), F.lit(vocabulary - 1)))


def truncated(tokens: Column, most: int) -> Column:
    return F.slice(tokens, 1, most)


def result_name(model: Column) -> Column:
    """Default file name of a model's inference result: the last part of its path."""
    return F.concat(F.lit("inference_"), F.element_at(F.split(F.rtrim(model, F.lit("/")), "/"), -1), F.lit(".json"))
