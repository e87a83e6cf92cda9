import math

from hypothesis import given, settings
from hypothesis import strategies as st

from pairmill.operators import metrics


def rows(spark, data):
    return spark.createDataFrame(data, "run_id int, prediction string, reference string")


def test_identity(spark):
    r = rows(spark, [(1, "Xin chào các bạn thân mến.", "Xin chào các bạn thân mến."), (1, "một hai ba bốn", "một hai ba bốn")])
    out = metrics.all_metrics(r, ["run_id"]).first()
    assert abs(out.bleu - 100) < 1e-9 and abs(out.chrf - 100) < 1e-9 and out.ter == 0 and out.comet is None


def test_bleu_by_hand(spark):
    # hyp: the the cat sat on mat ; ref: the cat sat on the mat  -> 6/6, 3/5, 2/4, 1/3
    r = rows(spark, [(1, "the the cat sat on mat", "the cat sat on the mat")])
    out = metrics.bleu(r, ["run_id"]).first()
    want = [100.0, 60.0, 50.0, 100 / 3]
    assert all(abs(out[f"p{n}"] - w) < 1e-9 for n, w in enumerate(want, 1))
    assert abs(out.bleu - math.exp(sum(map(math.log, want)) / 4)) < 1e-9
    assert abs(metrics.bleu_of([6, 3, 2, 1], [6, 5, 4, 3], 6, 6) - out.bleu) < 1e-9


def test_brevity_smoothing_and_empty(spark):
    r = rows(spark, [(1, "a b c d", "a b c d e f g h"), (2, "a x y z w", "a b c d e"), (3, "", "a b"), (4, None, None), (5, "a b", "a b")])
    got = {x.run_id: x for x in metrics.bleu(r, ["run_id"]).collect()}
    assert abs(got[1].bleu - 100 * math.exp(1 - 2)) < 1e-9
    want = [20.0, 100 / (2 * 4), 100 / (4 * 3), 100 / (8 * 2)]
    assert abs(got[2].bleu - math.exp(sum(map(math.log, want)) / 4)) < 1e-9
    assert got[3].bleu == 0 and got[4].bleu == 0 and got[5].bleu == 0  # no 4-gram at all


def test_tokens_13a(spark):
    r = rows(spark, [(1, "Hello, world! 1,000.5 well-known 3-4 (x) &amp; “y”", "")])
    got = r.select(metrics.tokens_13a(r.prediction)).first()[0]
    assert got == ["Hello", ",", "world", "!", "1,000.5", "well-known", "3", "-", "4", "(", "x", ")", "&", "“y”"]


def test_chrf_by_hand(spark):
    # one order only: "ab" against "ac": unigrams 1 of 2, bigrams 0 of 1
    out = metrics.chrf(rows(spark, [(1, "ab", "ac"), (2, "", "abc"), (3, "a b", "ab")]), ["run_id"])
    got = {x.run_id: x.chrf for x in out.collect()}
    assert abs(got[1] - 25.0) < 1e-9 and got[2] == 0 and abs(got[3] - 100) < 1e-9


def test_ter_counts_a_shift_as_one(spark):
    out = metrics.ter(rows(spark, [(1, "c d a b", "a b c d"), (2, "a b", "a b c d"), (3, "x", "")]), ["run_id"])
    got = {x.run_id: (x.ter, x.wer) for x in out.collect()}
    assert got[1] == (25.0, 100.0) and got[2] == (50.0, 50.0) and got[3] == (None, None)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=7), st.lists(st.sampled_from("abcd"), max_size=7))
def test_edit_bounds(a, b):
    plain, shifted = metrics.edits(a, b), metrics.edits_with_shifts(a, b)
    assert abs(len(a) - len(b)) <= shifted <= plain <= max(len(a), len(b))
    assert (plain == 0) == (a == b)
