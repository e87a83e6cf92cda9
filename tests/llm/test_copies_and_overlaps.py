"""Problems 2, 6 and 7: formatting copies, overlaps of splits, leaked passages."""

import json
import random
import unicodedata

import pytest

from pairmill.llm import crosssplit, formatdup, leak, streams


def fold(t):
    return "".join(c for c in t.lower() if not c.isspace() and unicodedata.category(c)[0] != "P")


def test_hashes_and_comparison():
    texts = ["Xin  chào, bạn!", "xin chàobạn", "", "...", "가나 다", "가나다", "x" * 200000, "X" * 200000 + "!", "xin chao ban"]
    h1, h2, n = streams.text_hashes(texts)
    assert n.tolist() == [len(fold(t)) for t in texts]
    for i in range(len(texts)):
        for j in range(len(texts)):
            same = fold(texts[i]) == fold(texts[j])
            assert ((h1[i], h2[i]) == (h1[j], h2[j])) == same
            assert streams.same_streams([texts[i]], [texts[j]])[0] == same


def test_words():
    texts = ["Xin chào, các-bạn !", "", "  ", "một"]
    h, starts, _, _ = streams.words(texts)
    assert starts.tolist() == [0, 3, 3, 3, 4]
    again, _, _, _ = streams.words(["XIN “chào” cácbạn một"])
    assert again.tolist() == h.tolist()
    grams, at = streams.ngrams(h, starts, 2)
    assert at.tolist() == [0, 1] and len(grams) == 2


def line(k, v, **more):
    return json.dumps({"translation": {"kor_Hang": k, "vie_Latn": v}, **more}, ensure_ascii=bool(more))


def lines(seed=1, n=120):
    r = random.Random(seed)
    base = [(f"문장 {i}번, 입니다.", f"Câu thứ {i}, này.") for i in range(n // 4)] + [("같은 글", "cùng một câu")]
    rows = []
    for i in range(n):
        k, v = base[-1] if r.random() < 0.35 else r.choice(base)
        if r.random() < 0.5:
            k, v = k.replace(" ", ""), "«" + v.upper() + "»"
        rows.append((i + 1, line(k, v, **({"score": i} if r.random() < 0.5 else {}))))
    return rows + [(1000, None), (1001, ""), (1002, "{broken"), (1003, '{"translation": {"kor_Hang": "a"}}'), (1004, line("!!", "a")), (1005, "[1]"), (1006, '{"translation": {"kor_Hang": null, "vie_Latn": "a"}}')]


def expected(rows):
    groups = {}
    for i, raw in rows:
        pair = formatdup.parse(raw)
        if pair and fold(pair[0]) and fold(pair[1]):
            groups.setdefault((fold(pair[0]), fold(pair[1])), []).append(i)
    return groups


@pytest.mark.parametrize("bits", [64, 2])
def test_copies(spark, bits):
    rows = lines()
    df = spark.createDataFrame([(i, raw, "x", 1) for i, raw in rows], "line_id bigint, line string, h1 string, first int").repartition(5)
    hashed = formatdup.hashed_lines(df, bits)
    got = sorted(map(tuple, formatdup.copies(hashed).collect()))
    groups = expected(rows)
    assert got == sorted((min(g), i) for g in groups.values() for i in g if i != min(g))
    records = {r.line_id: r.copies for r in formatdup.records(hashed).collect()}
    assert records == {min(g): len(g) for g in groups.values()}


def test_folding_and_strict_lines():
    same = [("Σίσυφος", "ΣΊΣΥΦΟΣ"), ("straße", "STRAẞE"), ("ǅ", "ǆ"), ("ſo", "SO")]
    for a, b in same:
        assert streams.same_streams([a], [b])[0] and [x[0] for x in streams.text_hashes([a])] == [x[0] for x in streams.text_hashes([b])]
    for word in ("NaN", "Infinity", "-Infinity"):
        assert formatdup.parse('{"translation": {"kor_Hang": "가", "vie_Latn": "a"}, "x": %s}' % word) is None
    assert formatdup.parse('{"translation": {"kor_Hang": "가", "vie_Latn": "a"}, "x": null}') == ("가", "a")


def test_hot_group_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(formatdup, "HOT_ROWS", 500)
    rows = [(i, line("같은 글", "cùng một câu" + "!" * (i % 3))) for i in range(4000)] + [(5000 + i, line(f"글 {i}", f"câu {i}")) for i in range(50)]
    hashed = formatdup.hashed_lines(spark.createDataFrame(rows, "line_id bigint, line string"))
    got = formatdup.copies(hashed)
    assert got.count() == 3999 and got.where("first_line_id = 0").count() == 3999


def test_no_lines(spark):
    hashed = formatdup.hashed_lines(spark.createDataFrame([], "line_id bigint, line string"))
    assert formatdup.copies(hashed).count() == formatdup.records(hashed).count() == 0


SPLIT = "pair_no bigint, kor_Hang string, vie_Latn string, source string, split string, text int"


def test_overlaps(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("가나다라마바사아자차카타파하") for _ in range(3))
    train, dev, want = [], [], set()
    for i in range(300):
        words = [word() for _ in range(20)]
        train.append((1000 + i, " ".join(words), f"câu số {i} riêng biệt hoàn toàn {word()} {word()}", None if i % 5 else "s", "x", 1))
        if i < 40:
            w, kind = words.copy(), i % 5
            for k in range(i % 4 if kind else 0):  # up to 3 of 20 words
                at = r.randrange(len(w))
                if kind == 1:
                    w[at] = word()
                elif kind == 2:
                    del w[at]
                elif kind == 3:
                    w.insert(at, word())
                else:
                    w.insert(r.randrange(len(w)), w.pop(at))
            text = " ".join(w) if kind else "“" + "".join(w) + "”!"
            dev.append((i, text if i % 2 else "khác", "khác" if i % 2 else text, "d", "x", 1))
            want.add(("dev", i, 1000 + i))
    dev += [(900, None, None, None, None, None), (901, "", " ", "d", "x", 1), (902, " ".join(word() for _ in range(20)), "…", "d", "x", 1)]
    train += [(2000 + k, train[0][1], None, "t", "x", 1) for k in range(30)] + [(3000, "", None, "t", "x", 1)]
    want |= {("dev", 0, 2000 + k) for k in range(30)}
    found = crosssplit.overlaps(spark.createDataFrame(train, SPLIT), {"dev": spark.createDataFrame(dev, SPLIT), "test": spark.createDataFrame([], SPLIT)})
    assert {(x.split, x.eval_id, x.train_id) for x in found.collect()} == want
    counts = crosssplit.counts(found).collect()
    assert sum(c.pairs for c in counts) == len(want) and all(c.split == "dev" for c in counts)


def test_changes_at_the_limit():
    words = list("abcdefghijkl")
    assert crosssplit.changes(words, words) == 0 and crosssplit.changes(words, ["x", *words[1:]]) == 1 and crosssplit.changes(words, words[1:]) == 1
    assert crosssplit.changes(words, [*words[1:], words[0]]) == 1 and crosssplit.changes([], []) == 0 and crosssplit.changes(["a"], []) == 1


def sixth_changed(r, n, repeated):
    """A text of n words and one with just a sixth of them changed; with `repeated`, these are all one word."""
    word = lambda: "".join(r.choice("가나다라마바사아자차카타파하") for _ in range(4))
    a = [word() for _ in range(n)]
    at = r.sample(range(n), n // 6)
    if repeated:
        for i in at:
            a[i] = a[at[0]]
    b, new = a.copy(), word()
    for i in at:
        b[i] = new if repeated else word()
    return " ".join(a), " ".join(b)


@pytest.mark.parametrize("n", [6, 12, 18, 24, 30, 130, 150])
@pytest.mark.parametrize("repeated", [False, True])
def test_texts_with_a_sixth_changed_always_meet(n, repeated):
    import numpy as np

    r = random.Random(n)
    pairs = [sixth_changed(r, n, repeated) for _ in range(200)]
    f, starts = crosssplit.features([t for p in pairs for t in p])
    counts = np.random.default_rng(1).integers(0, 9, crosssplit.BUCKETS)
    keys, bits = crosssplit.keys_of(f, starts, counts), crosssplit.bitmaps(f, starts)
    for i in range(0, 400, 2):
        assert set(keys[i].tolist()) & set(keys[i + 1].tolist())
        assert sum((int(x) ^ int(y)).bit_count() for x, y in zip(bits[i].view("u8"), bits[i + 1].view("u8"), strict=True)) <= 2 * n - 2 * -(-5 * n // 6)


def test_overlaps_with_a_repeated_word_changed(spark):
    r = random.Random(5)
    pairs = [sixth_changed(r, n, True) for n in (12, 18, 24) for _ in range(30)]
    row = lambda i, t: (i, t, None, "s", "x", 1)
    train = spark.createDataFrame([row(1000 + i, a) for i, (a, _) in enumerate(pairs)], SPLIT)
    found = crosssplit.overlaps(train, {"dev": spark.createDataFrame([row(i, b) for i, (_, b) in enumerate(pairs)], SPLIT)})
    assert {(x.eval_id, x.train_id) for x in found.collect()} == {(i, 1000 + i) for i in range(len(pairs))}


def test_in_order_against_dynamic_programming():
    r = random.Random(1)
    for _ in range(100):
        a, b = ([r.randrange(6) for _ in range(r.randrange(0, 30))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert crosssplit.in_order(a, b) == row[-1]


def test_hot_texts_are_dealt_out(spark, monkeypatch):
    row = lambda i, t: (i, t, None, "s", "x", 1)
    train = spark.createDataFrame([row(1000 + i, "cùng một câu rất dài ở đây" + "!" * (i % 3)) for i in range(60)] + [row(2000 + i, f"câu khác {i} hẳn ra đó nhé") for i in range(20)], SPLIT)
    dev = spark.createDataFrame([row(i, "Cùng một câu rất dài ở đây.") for i in range(30)] + [row(50, "câu khác 3 hẳn ra đó nhé")], SPLIT)
    want = {(i, 1000 + k) for i in range(30) for k in range(60)} | {(50, 2003)}
    for limit in (100_000, 7):
        monkeypatch.setattr(crosssplit, "HOT_ROWS", limit)
        assert want <= {(x.eval_id, x.train_id) for x in crosssplit.overlaps(train, {"dev": dev}).collect()}


def longest(a, b):
    """Brute force: most words of a that b repeats in order with small gaps."""
    rows = {}
    for j, y in enumerate(b):
        for i, x in enumerate(a):
            if x == y:
                rows[i, j] = 1 + max((rows.get((i - p, j - d), 0) for p in range(1, leak.PASSAGE_GAP + 2) for d in range(1, leak.DOCUMENT_GAP + 2)), default=0)
    return max(rows.values(), default=0)


def places_of(a):
    return {x: [i for i, y in enumerate(a) if y == x] for x in a}


def test_chains_against_brute_force():
    r = random.Random(3)
    for _ in range(100):
        a = [r.randrange(40) for _ in range(20)]
        b = [r.randrange(40) for _ in range(30)] + [x if r.random() < 0.7 else r.randrange(40) for x in a] + [r.randrange(40) for _ in range(20)]
        assert leak.chained(places_of(a), b) == longest(a, b)
    assert leak.chained({}, [1]) == leak.chained(places_of([1]), []) == 0 and leak.chained(places_of([1, 2]), [1, 9, 9, 2]) == 2 and leak.chained(places_of([1, 2]), [1, 9, 9, 9, 2]) == 1


@pytest.mark.parametrize("every", [2, 3])
def test_leaks_with_every_second_or_third_word_changed(spark, every):
    """The query finds just what brute force over all pairs finds, however the rest of the passage is written."""
    r = random.Random(every)
    vocabulary = [f"từ{i}" for i in range(60)]  # few words, so that other passages come near
    items = {i: [r.choice(vocabulary) for _ in range(r.choice([6, 21, 40, 90]))] for i in range(40)}
    docs = {}
    for d in range(120):
        p = items[r.randrange(40)]
        part = [x if (k + 1) % every else ("khác" if d % 2 else "khác hẳn") for k, x in enumerate(p)]
        if d % 3 == 0:  # half of the words only, each third one changed in between
            part = part[: max(2, -(-len(p) * every // (2 * (every - 1))))]
        docs[d] = " ".join([r.choice(vocabulary) for _ in range(r.randrange(60))] + part + [r.choice(vocabulary) for _ in range(r.randrange(60))])
    got = leak.leaks(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), spark.createDataFrame([(i, " ".join(p)) for i, p in items.items()], "item_id bigint, passage string"))
    want = {(d, i) for d, t in docs.items() for i, p in items.items() if longest(p, t.split()) * 2 >= len(p)}
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want and len(want) > 80


def test_leaks(spark):
    r = random.Random(11)
    vocabulary = [f"từ{i}" for i in range(3000)]
    passage = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = {i: passage(r.choice([8, 20, 60, 85])) for i in range(60)}
    docs, want = [], set()
    for d in range(200):
        words = passage(r.randrange(0, 400))
        if d % 3 == 0:
            i = r.randrange(60)
            p = items[i]
            n = len(p) if d % 2 else max(-(-len(p) * 6 // 10), 4)
            start = r.randrange(len(p) - n + 1)
            part = p[start : start + n]
            if d % 4 == 0 and n >= 20:
                part[n // 2] = "khác"
            at = r.randrange(len(words) + 1)
            words[at:at] = part
            want.add((d, i))
        elif d % 3 == 1 and d % 2:
            p = items[r.randrange(60)]
            words[0:0] = p[: len(p) * 3 // 10]  # too short to be a case
        docs.append((d, (" ,\n" if d % 5 == 0 else " ").join(words).upper() if d % 7 == 0 else " ".join(words), "x"))
    docs += [(900, None, "x"), (901, "", "x"), (902, "，" * 50, "x")]
    got = leak.leaks(spark.createDataFrame(docs, "doc_id bigint, text string, item_id string"), spark.createDataFrame([(i, " ".join(p).title() + ".", "t") for i, p in items.items()] + [(99, None, None), (98, "", "t")], "item_id bigint, passage string, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want


def test_leaks_in_slices_and_empty(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "một hai ba bốn năm sáu bảy tám"), (2, "xa xa xa")], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, "một hai ba bốn năm sáu") for i in range(5)], "item_id bigint, passage string")
    whole = sorted(map(tuple, leak.leaks(docs, items).collect()))
    monkeypatch.setattr(leak, "SLICE", 2)
    assert sorted(map(tuple, leak.leaks(docs, items).collect())) == whole and len(whole) == 5
    assert leak.leaks(docs, items.limit(0)).count() == leak.leaks(docs.limit(0), items).count() == 0
