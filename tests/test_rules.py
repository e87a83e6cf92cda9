"""Predicates at their boundaries, against plain Python written from the rules' statements."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from pairmill.functions import text as T
from pairmill.operators import rules, stats

NO_LANG = rules.FilterConfig(use_langid=False)
TEXTS = [
    "", " ", "abc", "abcd", "한국어 문장입니다.", "Xin chào các bạn!", "[nhạc]", "(cười) ha ha", "♪ la", "www.x.vn", "http://a", "Subscribe now", "episode 12", "A: chào", "12:30 bắt đầu", "---", "--- \n",
    "a　b c", "１２ và 7", "!!!???", "ab..", "이 문장은 100개와 20개", "응", "à", "ữ ờ", "x" * 5000, "\tA: x", "ﾊﾝｶｸ", "một cái này đó", "한", "👩‍🏫 abc", "a\x1cb", "Số 5, 6, 7", "éa",
]


def one(spark, expr, values=TEXTS):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("t"))).collect()]


def test_words_and_lengths(spark):
    assert one(spark, T.word_count) == [len(t.split()) for t in TEXTS]
    assert one(spark, T.char_length) == [len(t) for t in TEXTS]
    assert one(spark, T.normalized) == [re.sub(r"\s+", " ", t.lower()).strip() for t in TEXTS]


def test_numbers_and_punctuation(spark):
    assert one(spark, T.numbers) == [re.findall(r"\d+", t) for t in TEXTS]
    density = [sum(unicodedata.category(c)[0] == "P" for c in t) / len(t) if t else None for t in TEXTS]
    assert one(spark, T.punctuation_density) == density


def test_boilerplate(spark):
    patterns = [r"\[.*?\]", r"\(.*?\)", "♪+", r"www\.", "https?://", "subscribe", r"episode \d+", r"^\s*[A-Z]:\s*", r"^\d{1,2}:\d{2}", r"^-+\s*$"]
    assert one(spark, T.boilerplate) == [bool(re.search("|".join(patterns), t, re.I)) for t in TEXTS]


def test_null_in_gives_null_out(spark):
    for f in (T.word_count, T.char_length, T.normalized, T.punctuation_density, T.boilerplate, T.useless, T.mixed_language, T.literal_score):
        assert one(spark, f, [None, "a"])[0] in (None, -1) or f is T.word_count


def reasons(spark, pairs, config=NO_LANG):
    rows = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(pairs)], "pair_id int, src string, tgt string")
    return [r.reason for r in rules.verdict(rows, config=config).orderBy("pair_id").collect()]


def test_order_and_boundaries(spark):
    words = lambda n: " ".join(["từng"] * n)
    cases = {
        ("abc", "abcd"): "too_short",
        ("abcd", "abcd"): "passed",
        (None, "abcd"): "too_short",
        ("", ""): "too_short",
        ("abcd (x)", "abcd"): "boilerplate",
        (words(5), words(2)): "passed",  # ratio 0.4
        (words(2), words(5)): "passed",  # ratio 2.5
        (words(6), words(2)): "length_ratio",
        ("     ", "abcd"): "length_ratio",  # no word on one side
        ("1 2 3 4 5 6 7 8 9 10", "1 2 3 4 5 6 7"): "passed",  # divergence 3/10
        ("1 2 3 4 5 6 7 8 9 10", "1 2 3 4 5 6 x"): "number_inconsistent",
        ("abcdefg...", "abcdefgh"): "punct_density",  # exactly 0.3
        ("abcdefgh..", "abcdefgh"): "passed",
    }
    assert reasons(spark, list(cases)) == list(cases.values())


def test_useless_phrases_only_below_the_least_length(spark):
    assert reasons(spark, [("응", "ờ")], rules.FilterConfig(use_langid=False, min_length=1)) == ["boilerplate"]
    assert reasons(spark, [("응", "ờ")]) == ["too_short"]


def test_language_rules(spark):
    c = rules.FilterConfig()
    got = reasons(spark, [("한국어 문장입니다", "Đây là câu tiếng Việt"), ("English text here", "Đây là câu tiếng Việt"), ("한국어 문장입니다", "plain english words"), ("12345", "67890")], c)
    assert got == ["passed", "wrong_lang_ko", "wrong_lang_vi", "passed"]


def test_report_partitions_the_input(spark):
    rows = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)], "pair_id int, src string, tgt string")
    v = rules.verdict(rows)
    report = stats.rejection_report(v).collect()
    assert sum(r.n for r in report) == len(TEXTS) and abs(sum(r.pct for r in report) - 100) < 1e-9
    assert [r.n for r in report] == sorted((r.n for r in report), reverse=True)
    flags = rules.flags(rows)
    first = F.coalesce(*[F.when(F.col(n), n) for n in rules.failures(F.lit(""), F.lit(""), rules.FilterConfig())], F.lit("passed"))
    assert flags.select("pair_id", first.alias("reason")).exceptAll(v.select("pair_id", "reason")).isEmpty()


def test_empty_table(spark):
    rows = spark.createDataFrame([], "pair_id int, src string, tgt string")
    v = rules.verdict(rows)
    assert stats.rejection_report(v).count() == 0
    assert tuple(stats.retention(v).first()) == (0, 0, None)
    assert rules.full_verdict(rows).count() == 0


def test_extra_columns_stay(spark):
    rows = spark.createDataFrame([(1, "abcd", "abcd", "x", 3)], "pair_id int, src string, tgt string, lang string, n int")
    assert rules.verdict(rows, config=NO_LANG).columns == ["pair_id", "src", "tgt", "lang", "n", "reason"]


@pytest.mark.parametrize(("t", "label"), [(0.29, 28), (0.57, 56), (0.58, 57), (0.65, 65), (0.7, 70), (0.75, 75), (0.8, 80)])
def test_threshold_label(spark, t, label):
    assert spark.range(1).select(T.threshold_label(F.lit(t))).first()[0] == label


def test_cosine_and_ids(spark):
    r = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [-100, -5, 7, 2])], "a array<float>, b array<float>, i array<int>")
    got = r.select(T.cosine(F.col("a"), F.col("b")), T.clipped_ids(F.col("i"), 5), T.cosine(F.col("a"), F.array(F.lit(0.0), F.lit(0.0))), T.truncated(F.col("i"), 2)).first()
    assert abs(got[0] - 0.96) < 1e-9 and got[1] == [1, 0, 4, 2] and got[2] is None and got[3] == [-100, -5]
