"""Problems 5 and 3: garbled text, stand-in characters."""

import random
import re
import unicodedata

import pytest

from pairmill.llm import canonical as C
from pairmill.llm import catalog, mojibake

KO = "죄송하지만 무토 지점에서는 비싼 과학 증명서를 번역할 수 없습니다. 그래서 1,234명이 모여 새로운 책을 발표했어요?"
VI = "Ngày 4 tháng 11, người bạn của tôi đã đăng ký dự án “giáo dục” đặc biệt ở Hà Nội. Ở đây có 2 bệnh viện lớn."
SINGLE = [s for s in mojibake.CHAINS if mojibake.CHAINS[s] and not any(w in mojibake.WIDE for _, w in mojibake.CHAINS[s])]


@pytest.mark.parametrize("state", SINGLE)
def test_round_trip(state):
    of_vietnamese = mojibake.CHAINS[state][0][0] in mojibake._letters()
    for text in (VI,) if of_vietnamese else (KO, VI) if not state.startswith("cp949") else (KO,):
        bad = mojibake.misread(text, state)
        path = mojibake.label([bad])[0]
        assert path.any() and re.search(mojibake.SUSPECT, bad)
        case = str.lower if state.startswith("tcvn3") else str  # TCVN3 has no capitals with a tone
        assert case(mojibake.repair(bad, path)[0]) == case(unicodedata.normalize("NFC", text))


@pytest.mark.parametrize("state", ["utf8_as_cp949", "utf8_as_gbk", "cp949_as_gbk", "cp949_as_cp932"])
def test_lossy_encodings_are_found(state):
    text = KO if state.startswith("cp949") else VI
    assert mojibake.garbled([mojibake.misread(text, state)])[0]


def test_parts_of_a_text():
    words = VI.split(" ")
    bad = " ".join(mojibake.misread(w, "utf8_as_cp1252") if i % 3 == 0 else w for i, w in enumerate(words))
    path = mojibake.label([bad])[0]
    assert path.any() and mojibake.repair(bad, path)[0] == VI


def test_clean_text_stays():
    clean = [KO, VI, "", " ", "♪ La la la ♪", "Loại Д: abc", "Ω 유형: 가나다", "Вчера утром водитель подписал договор.", "下雨之后司机在市场介绍了节日的照片。", "先週、隣の人は市場で申し込みの書類を確かめました。",
             "Hier matin, l'étudiante a vérifié le dossier médical.", "Xong chưa? Rồi!", "뭐라고?? 정말?!", "a\xa0b", "Wi\xad-Fi", "👩‍🏫 chào", unicodedata.normalize("NFD", VI), unicodedata.normalize("NFD", KO), "ðơn", "Рhí là wоn"]
    assert not mojibake.garbled(clean).any()


def test_lost_characters_are_found_but_not_restored():
    for bad in ("Ng?y 26 th?ng 3, ??u b?p ?? ph?n t?ch t?p PDF ?m nh?c", "Gi� nghỉ trưa, ông Kahi k� vì sao"):
        path = mojibake.label([bad])[0]
        assert path.any() and mojibake.repair(bad, path)[0] is None


def test_the_filter_before_the_model_leaves_nothing_out():
    r = random.Random(2)
    texts = []
    for _ in range(300):
        words = (KO + " " + VI).split(" ")
        r.shuffle(words)
        texts.append(" ".join(words[:12]))
    passed_over = [t for t in texts if not re.search(mojibake.SUSPECT, t)]
    assert len(passed_over) > 100 and not mojibake.garbled(passed_over).any()


def test_long_and_empty_batches():
    assert mojibake.label([]) == [] and len(mojibake.label([""])[0]) == 0
    long = VI * 100
    path = mojibake.label([long, mojibake.misread(long, "utf8_as_cp1252")])
    assert not path[0].any() and path[1].any() and len(path[0]) == len(long)


CASES = {
    "Ｗｉ－Ｆｉ １２３．": "Wi-Fi 123.", "Рhí là 5 wоn": "Phí là 5 won", "ðơn Ðặng Ɖà": "đơn Đặng Đà", "a\xa0b　c d": "a b c d", "tr\xadướ​c‍ x⁠﻿": "trước x",
    unicodedata.normalize("NFD", VI): VI, unicodedata.normalize("NFD", KO): KO, "Χe buýt Νha": "Xe buýt Nha", "ﬁn 𝐚𝐛": "fin ab", "ệ": "ệ", "ộ": "ộ", "각": "각",
}


@pytest.mark.parametrize("text", CASES)
def test_usual_form(text):
    assert C.canonical(text) == CASES[text] == C.canonical(CASES[text]) and re.search(C.TRIGGER, text)


KEPT = ["", "Loại Д: abc", "Ω 유형: 가", "До обеда директор нашла книгу.", "👩‍🏫 và 👨‍👩‍👧 ❤️ 👍🏽", "先週、隣の人は　市場で。", "下雨之后，司机！", "“a” – b… · «c» ‘d’", "x\ny\tz", VI, KO, "λ β", "Έλληνες μιλούν"]


@pytest.mark.parametrize("text", KEPT)
def test_usual_text_stays(text):
    assert C.canonical(text) == text


def test_mapping_has_no_conflict_and_one_pass_is_enough():
    assert len(C.mapping()) > 20000  # raises on a conflict
    r = random.Random(4)
    pieces = [*CASES, *KEPT]
    for _ in range(200):
        t = " ".join(r.choice(pieces) for _ in range(4))
        once = C.canonical(t)
        assert C.canonical(once) == once and unicodedata.is_normalized("NFC", once)


def test_the_trigger_meets_every_entry():
    assert [s for s in C.mapping() if not re.search(C.TRIGGER, s)] == []
    for t, usual in {"\u0189i vao ga.": "Đi vao ga.", "か\u3099": "が", "は\u309a": "ぱ"}.items():
        assert C.canonical(t) == usual and re.search(C.TRIGGER, t)


def test_a_lone_stand_in_is_found(spark, tmp_path):
    sf = write(spark, tmp_path, "pair_corpus", [(1, ("가", "\u0189i vao ga."))], "pair_id bigint, translation struct<kor_Hang:string,vie_Latn:string>")
    assert list(map(tuple, catalog.p3_canonical(spark, sf).collect())) == [(1, "vie_Latn", "Đi vao ga.")]


def write(spark, path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_queries(spark, tmp_path):
    schema = "pair_id bigint, translation struct<kor_Hang:string,vie_Latn:string>, field string, text int"
    rows = [(1, (KO, mojibake.misread(VI, "utf8_as_cp1252")), "x", 1), (1, (KO, mojibake.misread(VI, "utf8_as_cp1252")), "x", 1), (2, (None, "a\xa0b"), None, None), (3, None, "f", 0), (4, ("", ""), "f", 0), (5, (KO * 200, VI * 200), "f", 0), (6, (unicodedata.normalize("NFD", KO), "Wi\xadFi"), "f", 2)]
    sf = write(spark, tmp_path, "pair_corpus", rows, schema)
    assert sorted(map(tuple, catalog.p5_found(spark, sf).collect())) == [(1, "vie_Latn")]
    assert sorted(map(tuple, catalog.p3_found(spark, sf).collect())) == [(2, "vie_Latn"), (6, "kor_Hang"), (6, "vie_Latn")]
    assert {r.canonical for r in catalog.p3_canonical(spark, sf).collect()} == {"a b", KO, "WiFi"}
    empty = write(spark, tmp_path / "e", "pair_corpus", [], schema)
    assert catalog.p5_found(spark, empty).count() == catalog.p3_found(spark, empty).count() == 0


def test_look_alikes_of_every_script():
    cases = {"vɑn đề": "van đề", "Hà Nộⅾ": "Hà Nộd", "Ꭺn toàn": "An toàn", "ꓐạn": "Bạn", "ϲủa": "của", "nһà ởօ": "nhà ởo", "ᴠiệc": "việc", "tıền": "tiền", "հọc": "học", "ⅼàm": "làm", "ⅰn": "in"}
    for text, want in cases.items():
        assert C.canonical(text) == unicodedata.normalize("NFC", want), text
        assert C.canonical(want) == want
    # alone as a symbol, or in a language that is written so
    for text in ("Loại ɑ", "Chương Ⅱ", "Ⅷ", "ϲ", "ısı ve ışığın değişimi", "Привет, мир", "Հայերեն լեզու", "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ"):
        assert C.canonical(text) == text


def test_clusters_are_rewritten_whole():
    for text in ("\u0958 \u2126 \u1f71", "\u1112\u1161\u11ab", "\ud558\u11ab", "a\u0323\u0302", "a\u0302\u0323", "e\u200c\u0323\u0302", "\uac00\u200d\ub098"):
        assert C.canonical(text) == unicodedata.normalize("NFC", text.replace("\u200c", "").replace("\u200d", ""))
    for text in ("👩‍🏫 1️⃣ ❤️", "x̲y⃗"):
        assert C.canonical(text) == text
    long = "Привет " * 20000 + "vаn"  # a word of look-alikes far from the start
    assert C.canonical(long).endswith("van")


@pytest.mark.parametrize("state", ["cp1258_as_cp1252", "tcvn3_as_cp1252", "vni_as_cp1252", "utf8_as_cp1251"])
def test_older_encodings_of_vietnamese(state):
    texts = ["Hôm nay trời đẹp quá, chúng tôi đi học ở trường.", "Tôi muốn cùng bạn đi chợ mua một ít rau và cá.", "Những người bạn của tôi đã đến Hà Nội từ hôm qua.", *["Ủy ban đã họp ở Ý Yên."] * (state != "tcvn3_as_cp1252")]  # TCVN3 has no capitals with a tone
    for t in texts:
        g = mojibake.misread(t, state)
        assert re.search(mojibake.SUSPECT, g)
        path = mojibake.paths([g])[0]
        assert mojibake.repair(g, path)[0] == t, (g, path)
    # letters that usual text may have alone
    usual = ["Kế toán ðã ðợi ở Hà Nội.", "조용\xad한 공장에서 일합니\xad다.", "Хе\xa0buýt\xa0đі\xa0Nаjaѕu\xa0khởi\xa0hành.", "Quì gối và ăn giò.", "« Où est le café ? », a dit Noël.", "Cà phê Wi-Fi® © 2020 ở Huế."]
    assert not any(p.any() for p in mojibake.paths(usual))


def test_long_texts_go_whole():
    clean = "Hôm nay trời đẹp quá. " * 3000
    g = mojibake.misread("Tôi muốn cùng bạn đi chợ mua một ít rau và cá.", "utf8_as_cp1252")
    for at in (0, 1000, 1023, 1024, 30000, len(clean)):
        text = clean[:at] + " " + g + " " + clean[at:]
        path = mojibake.label([text])[0]
        alone = mojibake.label([clean[max(0, at - 300) : at] + " " + g + " " + clean[at : at + 300]])[0]
        assert path[max(0, at - 300) : at + len(g) + 302].tolist() == alone.tolist()
