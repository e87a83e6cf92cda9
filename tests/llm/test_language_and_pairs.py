"""Problems 1 and 4: languages of texts, defective answers."""

import numpy as np
import pyarrow as pa
import pytest

from pairmill.llm import bytecnn, catalog, langid
from pairmill.llm import pairdefects as D

SENTENCES = {
    "ko": ["오늘 아침에 선생님은 학교에서 새로운 책을 읽었습니다.", "저는 친구와 함께 시장에 가고 싶습니다.", "내일은 비가 올 예정이라고 합니다.", "우리는 도서관에서 자료를 정리했습니다."],
    "vi": ["Hôm nay thầy giáo đã đọc một cuốn sách mới ở trường học.", "Tôi muốn cùng bạn đi chợ vào buổi sáng.", "Ngày mai trời sẽ mưa ở thành phố này.", "Chúng tôi đã sắp xếp tài liệu trong thư viện."],
    "en": ["This morning the teacher read a new book at the school.", "I would like to go to the market with my friend.", "They say that it will rain in the city tomorrow.", "We sorted the documents in the library together."],
    "zh": ["今天早上老师在学校看了一本新书。", "我想和朋友一起去市场买东西。", "他们说明天城市里会下雨的。", "我们在图书馆里整理了资料。"],
    "ja": ["今朝、先生は学校で新しい本を読みました。", "私は友達と一緒に市場へ行きたいです。", "明日は町で雨が降るそうです。", "私たちは図書館で資料を整理しました。"],
    "id": ["Tadi pagi guru itu membaca buku baru di sekolah kami.", "Saya ingin pergi ke pasar bersama teman saya.", "Mereka berkata besok akan turun hujan di kota.", "Kami sudah menyusun dokumen di perpustakaan itu."],
    "fr": ["Ce matin, le professeur a lu un nouveau livre à l'école.", "Je voudrais aller au marché avec mon ami demain.", "On dit qu'il va pleuvoir dans la ville demain soir.", "Nous avons rangé les documents à la bibliothèque."],
    "ru": ["Сегодня утром учитель прочитал новую книгу в школе.", "Я хочу пойти на рынок вместе с другом.", "Говорят, что завтра в городе будет дождь.", "Мы разобрали документы в городской библиотеке."],
}


@pytest.fixture(scope="module")
def detector():
    r = np.random.default_rng(0)
    rows = [(lang, " ".join(r.permutation(s)) + "\n" + " ".join(r.permutation(s))) for lang, s in SENTENCES.items() for _ in range(40)]
    return langid.Detector(langid.train(rows, epochs=8))


def languages(detector, texts):
    return [{langid.LANGS[k] for k in range(8) if b >> k & 1} for b in detector.languages(pa.array(texts, pa.string()))]


def test_each_language_and_mixtures(detector):
    for lang, s in SENTENCES.items():
        assert languages(detector, s) == [{lang}] * len(s)
    assert languages(detector, [SENTENCES["ko"][0] + " " + SENTENCES["zh"][1], SENTENCES["vi"][0] + " | " + SENTENCES["en"][1], SENTENCES["vi"][1] + " (" + SENTENCES["ja"][0] + ")"]) == [{"ko", "zh"}, {"vi", "en"}, {"vi", "ja"}]
    assert languages(detector, [langid._strip(SENTENCES["vi"][2])]) == [{"vi"}]


def test_the_network_decides():
    """Without what training found no language can be told, whatever the script."""
    net = bytecnn.ByteCNN(len(langid.LANGS))
    net.out[:] = 0
    blank = langid.Detector(bytecnn.Compiled(net))
    assert languages(blank, [s[0] for s in SENTENCES.values()]) == [set()] * 8


def test_forms_of_a_text(detector):
    """Capitals, decomposed letters and missing accents leave the language as it is."""
    import unicodedata

    for s in SENTENCES["vi"] + SENTENCES["ko"]:
        lang = "vi" if s in SENTENCES["vi"] else "ko"
        assert languages(detector, [s.upper(), unicodedata.normalize("NFD", s)]) == [{lang}] * 2


def test_priors(spark):
    docs = spark.createDataFrame([(1, "vi"), (2, "VI"), (3, "kor"), (4, None), (5, "und")], "doc_id bigint, lang string")
    p = np.exp(langid.priors(docs))
    assert abs(p.sum() - 1) < 1e-6 and np.allclose(p[[1, 0, 2]] * 11, [3, 2, 1])
    assert np.allclose(np.exp(langid.priors(docs.limit(0))), 1 / 8)


def test_nothing_to_tell(detector):
    assert languages(detector, ["", None, "  \n", "♪ ♪", "N/A", "123 456", "Wi-Fi USB"]) == [set()] * 7
    assert languages(detector, []) == []


def test_long_text_without_sentence_ends(detector):
    assert languages(detector, ["책을 읽고 " * 20000])[0] == {"ko"}


def test_segments_tile_the_text(detector):
    texts = [" ".join(SENTENCES["ko"]) + "\n" + SENTENCES["en"][0], "", SENTENCES["vi"][0]]
    owner, starts, ends, lang, _, b, offsets = detector.segments(pa.array(texts))
    assert (ends[:-1] == starts[1:]).all() and starts[0] == 0 and ends[-1] == len(b) and set(owner) == {0, 2}
    assert [langid.LANGS[k] for k in lang] == ["ko"] * 4 + ["en", "vi"]


def test_compiled_network_is_the_network():
    r = np.random.default_rng(1)
    x, y = r.integers(0, 256, (400, bytecnn.LENGTH)).astype(np.uint8), r.integers(0, 3, 400)
    x[np.arange(400), 5] = x[np.arange(400), 6] = y + 10
    net = bytecnn.ByteCNN(3).fit(x, y, epochs=3)
    assert np.abs(np.exp(bytecnn.Compiled(net).log_probabilities(x)) - net.probabilities(x)).max() < 0.02


def test_labels(spark):
    rows = spark.createDataFrame([(x,) for x in ("ko", "KO", "ko-KR", "kor_Hang", "vie", "vi-VN", "und", "", None, "xx", "English")], "l string")
    assert [r[0] for r in rows.select(langid.label_language(rows.l)).collect()] == ["ko", "ko", "ko", "ko", "vi", "vi", None, None, None, None, "en"]


K, V = "어젯밤에 선생님은 새로운 책을 발표했습니다.", "Đêm qua, thầy giáo đã công bố cuốn sách mới."
PAIRS = [
    (K, V, None), (K, None, "empty"), (K, "", "empty"), (K, "N/A", "empty"), (K, "…", "empty"), (None, V, None), ("[음악]", "[Âm nhạc]", None), ("(웃음)", "(cười)", None), ("새로운 책 목록", "Danh sách sách mới", None),
    (K, "Xin lỗi, tôi không thể dịch nội dung này.", "refusal"), (K, "I'm sorry, but I cannot translate this sentence.", "refusal"), (K, "죄송합니다. 이 문장은 번역할 수 없습니다.", "refusal"),
    ("죄송하지만 이 지점에서는 책을 번역할 수 없습니다.", "Xin lỗi, chi nhánh này không thể dịch cuốn sách.", None),
    (K, K, "copied"), (K, '"' + K.replace(" ", "  ") + '"', "copied"), (K, K[:-1], "copied"), (K, "The teacher announced the new book last night.", "other_language"), (K, "昨天晚上老师发布了新书。", "other_language"),
    (K, "내일은 비가 온다고 친구가 말했습니다.", "other_language"), (K, "Kemarin guru itu sudah mengumumkan buku baru.", "other_language"), (K, "Dem qua, thay giao da cong bo cuon sach moi.", None),
    (K, "Đêm qua, thầy giáo đã công bố", "truncated"), (K, "Đêm qua, thầy giáo đã,", "truncated"), (K, "Đêm qua, thầy giáo…", "truncated"), (K[:-1] + "…", "Đêm qua, thầy giáo…", None), (K, V[:-1] + "．", None),
    (K, "Thầy hỏi: “Cuốn sách m", "truncated"), (K, V + " 👍🏽", None), (K, "Ng?y 26 th?ng 3, ??u b?p ?? ph?n t?ch t?p PDF ?m nh?c.", None), (K, V + " " + V, None), ("", "Đêm qua", None),
]


def test_defects():
    got = D.defects([p for p, _, _ in PAIRS], [r for _, r, _ in PAIRS])
    assert [(r, g) for (_, r, w), g in zip(PAIRS, got, strict=True) if g != w] == []


def test_filter_before_parsing_keeps_every_defect(spark):
    rows = spark.createDataFrame([(i, p, r) for i, (p, r, _) in enumerate(PAIRS)], "i int, p string, r string")
    parsed = {r.i for r in rows.where(D.needs_parsing(rows.p, rows.r)).collect()}
    assert {i for i, (_, _, w) in enumerate(PAIRS) if w} <= parsed and 0 not in parsed


def test_parser_decides_what_breaks_off():
    whole = "1. Đêm qua (thứ hai), thầy đã đọc.\n2. “Sách đâu?”, em hỏi.\n```\nx = (1\n```\n<b>Hết.</b>"
    assert D.unfinished(whole) == "" and D.complete(whole) and D.unfinished("") == "" and not D.complete("")
    cut = {"Đêm qua (thứ hai, thầy đã đọc.": "(", "Thầy đọc.\n```\nx = 1.": "```", "Thầy đọc. <b>Hết.": "<b", "Thầy nói: “Em đọc.": "“", "Thầy nói: \"Em đọc.": '"', "Thầy đọc. Em": "sentence", "Thầy đọc…": "dots", "Thầy hỏi: “Đâu rồi?”…": "dots", "Thầy đọc (ở nhà)": "sentence", "[Thầy đọc": "sentence", "Số 8.066": "sentence"}
    for text, what in cut.items():
        assert D.unfinished(text) == what, text
        assert D.defects([K], [text]) == ["truncated"], text
    for text in ("Thầy đọc 8.066 trang.", "Thầy hỏi: “Đâu rồi?”", "Thầy đọc sách. (Em cũng đọc.)", "Thầy đọc <i>sách</i> it’s :( rồi!", "- Thầy đọc.\n- Em đọc.", "‘Thầy’ là gì?", "Mã là:\n```\nx = (1\n```", "Gọi `f(x` nhé."):
        assert D.unfinished(text) == "" and D.defects([K], [text]) == [None], text
    # a prompt that leaves a frame open itself, or no sentence to end, says nothing about its answer
    assert D.defects(["“" + K, "새로운 책 목록"], ["“" + V, "Danh sách"]) == [None, None]


def test_refusals_are_composed():
    said = ["Xin lỗi, tôi không thể giúp bạn việc này.", "Rất tiếc, tôi không thể làm điều đó.", "I can't help with that.", "As an AI language model, I cannot do this.", "I'm sorry, but I am unable to help you with this.", "그 부분은 도와드릴 수 없습니다."]
    said += [f"{who} {no} {act} {what}." for who in ("Tôi", "Xin lỗi, chúng tôi") for no in ("không thể", "không được phép") for act in ("dịch", "hỗ trợ dịch", "thực hiện việc cung cấp bản dịch") for what in ("nội dung này", "về đoạn văn này", "cho yêu cầu đó")]
    said += [f"I {no} {act} {what}." for no in ("cannot", "am not able to", "must decline to") for act in ("translate", "process") for what in ("this sentence", "the passage above, which is a text")]
    assert D.defects([K] * len(said), said) == ["refusal"] * len(said)
    # a translated "cannot" is none
    own = ["죄송하지만 저는 이 일을 도와드릴 수 없습니다.", "죄송하지만 이 지점에서는 책을 살 수 없습니다."]
    assert D.defects(own, ["Xin lỗi, tôi không thể giúp bạn việc này.", "Xin lỗi, chi nhánh này không thể bán sách."]) == [None, None]


def test_every_refusal_meets_the_hint(spark):
    """The Java condition lets every response through that the grammar takes, in any case and with unseen characters."""
    from pyspark.sql import functions as F

    no, act = D._VI_UNABLE[3:-1].split("|"), ["dịch", "giúp bạn dịch", "xử lý", "cung cấp bản dịch", "thực hiện việc trả lời"]
    said = [f"Thưa bạn, {n} {a} {o}." for n in no for a in act for o in ("nội dung này", "về câu trên", "cho yêu cầu đã gửi", "văn bản này", "với bài đó")]
    said += [f"Thưa bạn, tôi {n} {h} {t}." for n in no for h in ("giúp bạn", "làm", "đáp ứng") for t in ("việc này", "điều đó", "chuyện ấy")]
    said = [t for t in said if D.REFUSAL.search(t) or D.LOOSE.search(t)]
    assert len(said) > 200
    rows = [(K, f) for t in said for f in (t, t.upper(), t.replace("ông", "\u200bông"))]
    df = spark.createDataFrame(rows, "p string, r string")
    assert df.where(D.needs_parsing(F.col("p"), F.col("r"))).count() == len(rows)


def test_copies_with_edits():
    long = K + " " + "그리고 내일은 학교에서 친구와 함께 오래된 책을 정리할 예정입니다."
    assert D.tiled(long, long) == 1.0 and D.tiled(long, long[:20] + "X" + long[20:]) > 0.9 and D.tiled(long, V) == 0.0
    assert D.defects([long, long], [long[:30] + "가" + long[31:], "“" + long.replace(" ", "\n") + "”"]) == ["copied", "copied"]


def test_pushdown_parser():
    assert D.open_frames('“a (b) [c” d') == [] and D.open_frames("“a (b") == ["“", "("] and D.open_frames("```x(") == ["```"] and D.open_frames("`a` <b>x</b> <i>y") == ["<i"]
    assert D.open_frames("it’s :( fine") == [] and D.open_frames("a\n- ") == ["item"] and D.open_frames("") == []


def test_tiling():
    assert D.tiled("abcdefgh", "ABCD, efgh!") == 1.0 and D.tiled("", "a") == 0 and D.tiled("가나다라마바사아", "마바사아가나다라") == 1.0 and D.tiled("abcdefghij", "zzzzabcdzz") < 0.5


def test_queries(spark, tmp_path):
    pairs = "pair_id bigint, translation struct<kor_Hang:string,vie_Latn:string>, lang string"
    spark.createDataFrame([(1, (K, V), "x"), (2, (K, "x"), "x"), (2, (K, "x"), "x"), (3, None, None), (4, (V, K), "x"), (5, (K + " " + SENTENCES["zh"][0], V), "x"), (6, (None, ""), "x")], pairs).write.parquet(f"{tmp_path}/pair_corpus.parquet")
    spark.createDataFrame([(9, [("q", "r", None), (K, "r", V), (K, "r", "Đêm qua,")]), (8, []), (7, None)], "run_id bigint, samples array<struct<source:string,reference:string,prediction:string>>").write.parquet(f"{tmp_path}/eval_results.parquet")
    docs = [(100 + i, " ".join(SENTENCES[lang]) + f" {i}", lang) for i, lang in enumerate(list(SENTENCES) * 30)]
    docs += [(1, " ".join(SENTENCES["ko"]), None), (2, " ".join(SENTENCES["vi"]), "ko"), (3, SENTENCES["ko"][0] + "\n" + SENTENCES["fr"][0], "ko-KR"), (4, "", None), (5, None, None), (6, " ".join(SENTENCES["vi"]), "vie_Latn")]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    p4 = sorted(map(tuple, catalog.p4_found(spark, str(tmp_path)).collect()))
    assert p4 == [("eval_results", 9, 0, "empty"), ("eval_results", 9, 2, "truncated"), ("pair_corpus", 2, 0, "truncated"), ("pair_corpus", 3, 0, "empty"), ("pair_corpus", 4, 0, "other_language"), ("pair_corpus", 6, 0, "empty")]
    p1 = sorted(map(tuple, catalog.p1_found(spark, str(tmp_path)).collect()))
    assert p1 == sorted([("documents", 1, "text", "ko"), ("documents", 2, "text", "vi"), ("documents", 3, "text", "ko"), ("documents", 3, "text", "fr"), ("pair_corpus", 4, "kor_Hang", "vi"), ("pair_corpus", 4, "vie_Latn", "ko"), ("pair_corpus", 5, "kor_Hang", "ko"), ("pair_corpus", 5, "kor_Hang", "zh")])


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "pair_id bigint, translation struct<kor_Hang:string,vie_Latn:string>").write.parquet(f"{tmp_path}/pair_corpus.parquet")
    spark.createDataFrame([], "run_id bigint, samples array<struct<source:string,reference:string,prediction:string>>").write.parquet(f"{tmp_path}/eval_results.parquet")
    spark.createDataFrame([], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for query in (catalog.p1_found, catalog.p1_segments, catalog.p4_found):
        assert query(spark, str(tmp_path)).count() == 0


def test_segments_and_languages_of_both_tables(spark, tmp_path, detector, monkeypatch):
    monkeypatch.setattr(catalog, "_detector", lambda spark, path: detector)
    ko, vi = SENTENCES["ko"], SENTENCES["vi"]
    spark.createDataFrame([(1, (" ".join(ko), vi[0] + " " + SENTENCES["en"][1])), (1, (" ".join(ko), vi[0] + " " + SENTENCES["en"][1])), (2, ("책", None)), (3, ("", "123 …"))], "pair_id bigint, translation struct<kor_Hang:string,vie_Latn:string>").write.parquet(f"{tmp_path}/pair_corpus.parquet")
    spark.createDataFrame([(1, " ".join(SENTENCES["fr"]) + " " + ko[0], "fr"), (2, None, None)], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(map(tuple, catalog.p1_segments(spark, str(tmp_path)).drop("start", "bytes").collect()))
    assert [r[:5] for r in rows if r[4]] == [("documents", 1, "text", k, "ko" if k == 4 else "fr") for k in range(5)] + [("pair_corpus", 1, "kor_Hang", k, "ko") for k in range(4)] + [("pair_corpus", 1, "vie_Latn", 0, "vi"), ("pair_corpus", 1, "vie_Latn", 1, "en")]
    assert all(r[5] > 0.5 for r in rows if r[4])
    texts = {tuple(r)[:3]: (r.lang, r.confidence) for r in catalog.p1_texts(spark, str(tmp_path)).collect()}
    assert {k: v[0] for k, v in texts.items()} == {("documents", 1, "text"): "fr", ("pair_corpus", 1, "kor_Hang"): "ko", ("pair_corpus", 1, "vie_Latn"): texts["pair_corpus", 1, "vie_Latn"][0], ("pair_corpus", 2, "kor_Hang"): "ko", ("pair_corpus", 3, "kor_Hang"): None, ("pair_corpus", 3, "vie_Latn"): None}
    assert texts["pair_corpus", 1, "vie_Latn"][1] < 0.7 and texts["pair_corpus", 1, "kor_Hang"][1] > 0.9 and texts["pair_corpus", 3, "vie_Latn"][1] == 0


def test_refusals_that_only_the_usual_form_shows(spark):
    import unicodedata

    plain = "Tôi không thể dịch nội dung này, xin lỗi vì điều đó."
    long = "Tôi không thể hỗ trợ giúp bạn cung cấp bản dịch về đoạn văn này được đâu nhé."
    rows = [(K, unicodedata.normalize("NFD", plain)), (K, plain.replace("không", "kh\u200bông")), (K, plain.upper()), (K, plain)]
    assert D.defects(*zip(*rows, strict=True)) == ["refusal"] * 4
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "p string, r string")
    assert df.where(D.needs_parsing(F.col("p"), F.col("r"))).count() == 4
    assert D._HINT.search("không " + "x" * 60 + " nội dung này") and (not D.REFUSAL.search(long) or D._HINT.search(long))


def test_without_training_nothing_is_told():
    own = langid.Detector(langid.train([]))
    assert languages(own, [SENTENCES["ko"][0], SENTENCES["ru"][0], SENTENCES["vi"][0], SENTENCES["en"][0], "가나\n" * 40000]) == [set()] * 5


def test_training_segments_fit_their_label():
    s = SENTENCES
    for lang in s:
        others = " ".join(s[x][0] for x in s if x != lang and not (lang in ("en", "id", "fr") and x in ("en", "id", "fr")))
        assert langid.fitting(lang, others + " " + " ".join(s[lang][:2])).split("\n") == [x for x in s[lang][:2]], lang
    assert langid.fitting("vi", "") == langid.fitting("ko", "123 …") == ""


def test_mixed_and_wrong_labels_do_no_harm():
    """A third of the texts with an Indonesian label is Vietnamese; neither language takes the other's texts."""
    r = np.random.default_rng(2)
    rows = [(lang, " ".join(r.permutation(s))) for lang, s in SENTENCES.items() for _ in range(40)]
    rows += [("id", " ".join(r.permutation(SENTENCES["vi"]))) for _ in range(20)]
    own = langid.Detector(langid.train(rows, epochs=8))
    for lang in ("vi", "id"):
        assert languages(own, SENTENCES[lang]) == [{lang}] * 4
