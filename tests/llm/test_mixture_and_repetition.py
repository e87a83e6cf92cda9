"""Problems 8 and 9: mixtures of sources, repetition inside documents."""

import math
import random
from collections import Counter

import pytest

from pairmill.llm import mixture, repetition


def test_instant():
    stock, weight = {"a": 100.0, "b": 1000.0}, {"a": 0.5, "b": 0.5}
    assert mixture.instant(stock, weight, None) == 200 and mixture.instant(stock, weight, 100) == 100 and mixture.instant(stock, weight, 300) == 400 and mixture.instant(stock, weight, 5000) == math.inf and mixture.instant({}, {}, 5) == 0


TARGETS = "source string, target_share double, max_copies int, tokens int"


def fair_queue(tokens, goal, budget):
    """One document at a time: always the one that ends earliest."""
    have = {s: sum(t for _, x, t in tokens if x == s) for s in goal}
    stop = mixture.instant({s: have[s] * goal[s][1] for s in goal if have[s]}, {s: goal[s][0] for s in goal}, budget)
    return have, stop


@pytest.mark.parametrize("budget", [None, 2000.0])
def test_mixture(spark, budget):
    r = random.Random(2)
    tokens = [(i, "big" if i % 3 == 0 else r.choice(["a", "b", "small", "none"]), r.randrange(1, 40)) for i in range(900)]
    goal = {"big": (0.4, 1), "a": (0.3, 2), "b": (0.2, 3), "small": (0.05, 4), "missing": (0.05, 2)}
    t = spark.createDataFrame(tokens, "doc_id bigint, source string, tokens bigint").repartition(6)
    mix, shares = mixture.mixture(t, spark.createDataFrame([(s, *g, 1) for s, g in goal.items()], TARGETS), budget)
    rows = mix.collect()
    have, stop = fair_queue(tokens, goal, budget)
    assert [x.finish for x in rows] == sorted(x.finish for x in rows) and max(x.finish for x in rows) <= stop
    of = {i: n for i, _, n in tokens}
    for s, (share, copies) in goal.items():
        own = [x for x in rows if x.source == s]
        used = sum(x.tokens for x in own)
        assert all(x.tokens == of[x.doc_id] for x in own) and len({(x.doc_id, x.copy) for x in own}) == len(own)
        assert max(Counter(x.doc_id for x in own).values(), default=0) <= copies
        assert min(share * stop, have[s] * copies) - 40 < used <= min(share * stop, have[s] * copies) + 1e-6
        # finish times are the running sums
        assert all(abs(sum(y.tokens for y in own[: k + 1]) / share - x.finish) < 1e-6 for k, x in enumerate(own))
    got = {x.source: x for x in shares.collect()}
    assert set(got) == set(goal) and got["missing"].share_reached == 0 and abs(sum(x.share_reached for x in got.values()) - 1) < 1e-4
    if budget:
        assert budget - 5 * 40 <= sum(x.tokens for x in rows) <= budget


def test_a_tiny_source_does_not_size_the_mixture(spark, monkeypatch):
    from pairmill.llm import catalog

    tokens = spark.createDataFrame([(i, "big" if i else "tiny", 10) for i in range(101)] + [(500, "unused", 10), (501, "none", 10)], "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("big", 0.5, 2), ("tiny", 0.5, 3), ("unused", 0.0, 3)], "source string, target_share double, max_copies int")
    monkeypatch.setattr(catalog, "table", lambda spark, path, name: targets)
    monkeypatch.setattr(mixture, "counted", lambda documents, targets: tokens)
    assert mixture.whole(tokens, targets) == 1010
    rows = catalog.p8_mixture(spark, "").collect()
    assert sorted((x.copy, x.tokens) for x in rows if x.source == "tiny") == [(1, 10), (2, 10), (3, 10)]
    assert sum(x.tokens for x in rows) == 1010 and len({x.doc_id for x in rows if x.source == "big"}) == 98
    got = {x.source: x for x in catalog.p8_shares(spark, "").collect()}
    assert got["tiny"].most_copies == 3 and abs(got["tiny"].share_reached - 30 / 1010) < 1e-5 and got["unused"].tokens == 0


def test_mixture_of_nothing(spark):
    t = spark.createDataFrame([], "doc_id bigint, source string, tokens bigint")
    mix, shares = mixture.mixture(t, spark.createDataFrame([("a", 1.0, 2, 0)], TARGETS))
    assert mix.count() == 0 and shares.first().share_reached == 0
    mix, shares = mixture.mixture(t, spark.createDataFrame([], TARGETS))
    assert mix.count() == 0 and shares.count() == 0


def test_tokens_are_the_tokenizers(spark):
    import os

    if not os.path.exists(f"{mixture.TOKENIZERS}/{mixture.VOCABULARY}"):
        pytest.skip("no vocabulary")
    docs = spark.createDataFrame([(1, "a", "Xin chào các bạn"), (2, "a", ""), (3, "a", None), (4, "b", "x"), (5, None, "x")], "doc_id bigint, source string, text string")
    got = {x.doc_id: x.tokens for x in mixture.counted(docs, spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_copies int")).collect()}
    own = mixture.encoding(f"{mixture.TOKENIZERS}/{mixture.VOCABULARY}")
    assert got == {1: len(own.encode_ordinary("Xin chào các bạn"))} and own.decode(own.encode_ordinary("Xin chào")) == "Xin chào"


def share_of(words):
    seen, covered = set(), [False] * len(words)
    for i in range(len(words) - 4):
        g = tuple(words[i : i + 5])
        if g in seen:
            covered[i : i + 5] = [True] * 5
        seen.add(g)
    return sum(covered) / max(len(words), 1)


def test_repetition_against_brute_force(spark):
    r = random.Random(9)
    docs = []
    for d in range(400):
        words = [f"w{r.randrange(400)}" for _ in range(r.randrange(0, 120))]
        if d % 4 == 0 and len(words) > 10:
            run = [f"r{r.randrange(50)}" for _ in range(r.randrange(5, 15))]
            for _ in range(r.randrange(1, 12)):
                at = r.randrange(len(words))
                words[at:at] = run
        docs.append((d, words, r.choice(["vi", "ko", None, "xx"])))
    rows = [(d, ", ".join(w).upper() if d % 3 == 0 else " ".join(w), lang, 1.0) for d, w, lang in docs] + [(900, None, "vi", 1.0), (901, "", "vi", 1.0), (902, "a b a b", "vi", 1.0), (903, "东 西 南 北 中 " * 20, "zh", 1.0), (904, "a " * 5000, "en", 1.0)]
    got = {x.doc_id: x for x in repetition.repetition(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, words double")).collect()}
    want = {d for d, w, _ in docs if share_of(w) >= 0.4} | {904}
    assert {d for d, x in got.items() if x.below_band and x.repeated_share >= 0.4} == want and len(want) > 20
    assert all(abs(got[d].repeated_share - share_of(w)) < 1e-12 for d, w, _ in docs if got[d].below_band)
    assert 900 not in got and got[901].self_perplexity is None and not got[903].below_band


def test_every_spaced_document_has_a_share(spark):
    r = random.Random(3)
    docs = []
    for d in range(60):
        words = [f"w{r.randrange(10_000)}" for _ in range(100)]
        docs.append((d, words + words[: d % 4 * 7]))
    rows = [(d, " ".join(w), "vi") for d, w in docs] + [(901, "", "vi"), (902, "a b a b", "vi"), (903, "东西南北中。" * 20, "zh")]
    got = {x.doc_id: x for x in repetition.repetition(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert all(abs(got[d].repeated_share - share_of(w)) < 1e-12 for d, w in docs) and sum(not got[d].below_band for d, _ in docs) >= 15
    assert got[901].repeated_share == got[902].repeated_share == 0 and got[903].repeated_share is None


def bigrams_by_hand(texts):
    """Modified Kneser-Ney bigrams, written plainly."""
    bi = Counter(g for t in texts for g in zip(t, t[1:], strict=False))
    uni = Counter(g[1] for g in bi)
    d2, d1 = (repetition.discounts(*[sum(v == k for v in c.values()) for k in range(1, 5)]) for c in (bi, uni))
    total, left = sum(uni.values()), sum(d1[min(n, 3) - 1] for n in uni.values())
    p1 = {w: (n - d1[min(n, 3) - 1]) / total + left / total / len(uni) for w, n in uni.items()}
    out = {}
    for (a, b), n in bi.items():
        mine = [m for h, m in bi.items() if h[0] == a]
        out[a, b] = (n - d2[min(n, 3) - 1]) / sum(mine) + sum(d2[min(m, 3) - 1] for m in mine) / sum(mine) * p1[b]
    return out


def test_corpus_bigrams_against_plain_python(spark):
    import numpy as np

    r = random.Random(6)
    texts = {x: [[r.choice("abcdefg") for _ in range(r.randrange(0, 30))] for _ in range(40)] for x in ("vi", "ko")}
    rows = [(i, x, " ".join(t)) for x, ts in texts.items() for i, t in enumerate(ts)]
    model = repetition.corpus_model(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"))
    for k, x in enumerate(("vi", "ko")):
        want = bigrams_by_hand(texts[x])
        h, _, _, _ = repetition.words([" ".join(g) for g in want])
        got = model.probability(h[::2], h[1::2], np.full(len(want), k), ["vi", "ko"])
        assert np.allclose(got, list(want.values()))


def test_own_model_against_plain_python(spark):
    """Bits of a document read word by word: runs seen before, on top of the corpus model."""
    import numpy as np

    r = random.Random(8)
    text = [r.choice("ab") for _ in range(80)] + [r.choice("abcdefgh") for _ in range(60)]
    docs = spark.createDataFrame([(1, "vi", " ".join(text))], "doc_id bigint, lang string, text string")
    corpus, d = repetition.corpus_model(docs), (0.6, 1.2, 1.7)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["vi"]), pa.array([" ".join(text)])], ["doc_id", "lang", "text"])
    row = next(repetition.score_batches({"vi": d}, corpus)(iter([batch]))).to_pylist()[0]
    seen, bits, saved = Counter(), 0.0, 0.0
    for i in range(4, len(text)):
        h = tuple(text[i - 4 : i])
        mine = {g: n for g, n in seen.items() if g[:4] == h}
        x, _, _, _ = repetition.words([text[i - 1], text[i]])
        low = float(corpus.probability(x[:1], x[1:], np.zeros(1, int), ["vi"])[0])
        if mine:
            low *= sum(d[min(n, 3) - 1] for n in mine.values()) / sum(mine.values())
        n = seen[(*h, text[i])]
        p = low + ((n - d[min(n, 3) - 1]) / sum(mine.values()) if n else 0)
        bits, saved = bits - math.log2(p), saved + math.log2(p / low)
        seen[(*h, text[i])] += 1
    assert abs(row["bits"] - bits) < 1e-6 and abs(row["saved"] - saved) < 1e-6 and row["again"] == sum(n - 1 for n in seen.values() if n)


def test_bands_decide_without_counting(spark):
    """Below the lower band every document repeats enough, above the upper band none does; the found ones are brute force's."""
    r = random.Random(12)
    docs = {}
    for d in range(300):
        words = [f"w{r.randrange(2000)}" for _ in range(120)]
        run = [f"r{r.randrange(900)}" for _ in range(r.choice([5, 8, 30]))]
        for _ in range(d % 7 * r.randrange(0, 6)):
            at = r.randrange(len(words))
            words[at:at] = run
        docs[d] = words
    df = spark.createDataFrame([(d, " ".join(w), ("vi", "ko")[d % 2]) for d, w in docs.items()], "doc_id bigint, text string, lang string")
    got = {x.doc_id: x for x in repetition.repetition(df).collect()}
    below, above = [d for d in got if got[d].verdict == "below"], [d for d in got if got[d].verdict == "above"]
    assert len(below) > 20 and len(above) > 40 and all(share_of(docs[d]) >= 0.4 for d in below) and all(share_of(docs[d]) < 0.4 for d in above)
    assert all((got[d].self_perplexity <= got[d].lower_band + 1e-3) == (got[d].verdict == "below") for d in got if got[d].verdict == "below")
    assert {x.doc_id for x in repetition.repeating(df).collect()} == {d for d, w in docs.items() if share_of(w) >= 0.4}


def test_rare_bigrams_are_joined(spark, monkeypatch):
    """Perplexity and bands are the same whether a bigram is held in every task or joined."""
    r = random.Random(21)
    rows = []
    for d in range(60):
        words = r.choices("abcdefghijklmnop", range(16, 0, -1), k=r.randrange(0, 60))
        rows.append((d // 2, " ".join(words + words[: d % 5 * 6]), ("vi", "ko", None)[d % 3]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    key = lambda x: (x.doc_id, x.lang, x.words, x.self_perplexity or 0)
    want, found = sorted(repetition.repetition(docs).collect(), key=key), sorted(x.doc_id for x in repetition.repeating(docs).collect())
    assert len(want) == 60 and found and sum(x.self_perplexity is not None for x in want) > 40
    for hot in (0, 250):
        monkeypatch.setattr(repetition, "HOT", hot)
        got = sorted(repetition.repetition(docs).collect(), key=key)
        for a, b in zip(got, want, strict=True):
            assert (a.doc_id, a.lang, a.words, a.verdict, a.repeated_share) == (b.doc_id, b.lang, b.words, b.verdict, b.repeated_share)
            assert all((getattr(a, x) or 0) == pytest.approx(getattr(b, x) or 0, rel=1e-6) for x in ("self_perplexity", "lower_band", "upper_band"))
        assert sorted(x.doc_id for x in repetition.repeating(docs).collect()) == found


def test_unspaced_documents_have_a_share_of_repeated_content(spark):
    r = random.Random(22)
    plain = "".join(chr(0x4E00 + i) for i in r.sample(range(5000), 80))
    rows = [(1, plain, "zh"), (2, plain + "。" + plain[:40] + "！", "zh"), (3, "东西南北中。" * 20, "zh"), (4, plain[:9] * 2, "zh"), (5, plain + " a b c d e f g h i j " + "A, b c d e f g h i j.", "zh"), (6, "a b c d e " * 2, "vi"), (7, "", "zh"), (8, "สวัสดีครับทุกคน " * 4, "th")]
    got = {x.doc_id: x for x in repetition.repetition(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    want = {1: 0, 2: 40 / 120, 3: 95 / 100, 4: 0, 5: 10 / 100, 6: 0.5, 7: 0, 8: 0.75}
    assert all(abs(got[d].repeated_content - x) < 1e-12 for d, x in want.items()) and set(got) == set(want)
    assert all(got[d].repeated_share is None and got[d].verdict == "above" for d in (1, 2, 3, 4, 5, 8)) and got[6].repeated_share == 0.5


def test_batches_without_a_run(spark):
    docs = spark.createDataFrame([(1, "a b c d", "vi"), (2, "", "ko"), (3, "x", None)], "doc_id bigint, text string, lang string").coalesce(1)
    got = {x.doc_id: x for x in repetition.repetition(docs).collect()}
    assert {d: (x.words, x.verdict, x.repeated_share, x.repeated_content, x.self_perplexity) for d, x in got.items()} == {d: (n, "above", 0, 0, None) for d, n in ((1, 4), (2, 0), (3, 1))}
    assert not repetition.repeating(docs).collect()


def test_discounts():
    assert repetition.discounts(0, 0, 0, 0) == (0.9, 1.3, 1.6)
    d = repetition.discounts(1000, 100, 40, 20)
    y = 1000 / 1200
    assert abs(d[0] - (1 - 2 * y * 0.1)) < 1e-12 and abs(d[1] - 1.6) < 1e-12 or d[1] <= 1.6
    for counts in ((1000, 100, 40, 20), (5, 50, 50, 50), (1, 1, 1, 1), (0, 3, 0, 0), (10**9, 1, 1, 1)):
        d = repetition.own_discounts(repetition.discounts(*counts))
        assert 0 < d[0] < 1 and 0 < d[1] < 2 and 0 < d[2] < 3


def kneser_ney_by_hand(texts):
    """Modified Kneser-Ney trigrams, written plainly."""
    tri = Counter(g for t in texts for g in zip(t, t[1:], t[2:], strict=False))
    bi = Counter(g[1:] for g in tri)
    uni = Counter(g[1] for g in bi)
    d = [repetition.discounts(*[sum(v == k for v in c.values()) for k in range(1, 5)]) for c in (tri, bi, uni)]
    cost = lambda ds, n: ds[min(n, 3) - 1]
    total = sum(uni.values())
    left = sum(cost(d[2], n) for n in uni.values())
    p1 = {w: (n - cost(d[2], n)) / total + left / total / len(uni) for w, n in uni.items()}

    def level(counts, ds, below, key):
        out = {}
        for g, n in counts.items():
            mine = [m for h, m in counts.items() if h[:-1] == g[:-1]]
            t = sum(mine)
            out[g] = (n - cost(ds, n)) / t + sum(cost(ds, m) for m in mine) / t * below[key(g)]
        return out

    p2 = level(bi, d[1], p1, lambda g: g[1])
    return level(tri, d[0], p2, lambda g: g[1:]), tri


def test_corpus_model_against_plain_python(spark):
    r = random.Random(4)
    texts = [[r.choice("abcdefg") for _ in range(r.randrange(0, 30))] for _ in range(60)]
    p, tri = kneser_ney_by_hand(texts)
    docs = spark.createDataFrame([(i, " ".join(t), "vi", 0.0) for i, t in enumerate(texts)] + [(99, None, "vi", 0.0)], "doc_id bigint, text string, lang string, bits double").repartition(3)
    got = {x.doc_id: x for x in repetition.corpus_perplexity(docs).collect()}
    for i, t in enumerate(texts):
        grams = list(zip(t, t[1:], t[2:], strict=False))
        assert got[i].trigrams == len(grams)
        if grams:
            want = 2 ** (-sum(math.log2(p[g]) for g in grams) / len(grams))
            assert abs(got[i].perplexity - want) < 1e-3 * want
        else:
            assert got[i].perplexity is None and got[i].verdict is None
    assert 99 not in got


def test_cold_trigrams_are_joined(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(random.Random(i).choices("abcdefghij", k=20)), "vi") for i in range(30)], "doc_id bigint, text string, lang string")
    hot = sorted((x.doc_id, x.perplexity) for x in repetition.corpus_perplexity(docs).collect())
    monkeypatch.setattr(repetition, "HOT", 0)
    assert sorted((x.doc_id, x.perplexity) for x in repetition.corpus_perplexity(docs).collect()) == hot
