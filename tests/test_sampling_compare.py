from pyspark.sql import functions as F

from pairmill.operators import compare, providers, review, sampling, semantic

RESULT = "run_id int, test_file string, model string, test_size bigint, metrics struct<bleu:struct<score:double,precisions:array<double>>,chrf:double,ter:double,comet:double>, samples array<struct<source:string,reference:string,prediction:string>>"


def test_split_sizes_are_exact(spark):
    for n in (0, 1, 7, 40, 1000):
        rows = sampling.split(spark.range(n), "id").collect()
        count = {s: sum(r.split == s for r in rows) for s in ("train", "dev", "test")}
        assert len(rows) == n == len({r.id for r in rows})
        assert count["train"] == int(0.95 * n) and count["dev"] == int(0.025 * n)
    a = sampling.split(spark.range(500), "id")
    b = sampling.split(spark.range(500).repartition(9), "id")
    assert a.exceptAll(b).isEmpty() and not a.exceptAll(sampling.split(spark.range(500), "id", seed=7)).isEmpty()


def test_sample(spark):
    assert sampling.sample(spark.range(5), 9, "id").count() == 5
    a = [r.id for r in sampling.sample(spark.range(100), 10, "id").collect()]
    assert len(set(a)) == 10 and sorted(a) != list(range(10))
    assert [r.id for r in sampling.head(spark.range(100).repartition(5), 3, "id").collect()] == [0, 1, 2]
    assert sampling.first_of_each(spark.range(10).withColumn("g", F.col("id") % 2), "g", 3, "id").count() == 6


def test_sweep_is_nested_and_counts_all(spark):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate([0.65, 0.7, 0.75, 0.8, 0.5, None])], "id int, similarity double")
    kept = {t: {r.id for r in semantic.sweep(rows).where(F.col("threshold") == t).collect()} for t in semantic.THRESHOLDS}
    assert kept[0.8] <= kept[0.75] <= kept[0.7] <= kept[0.65] and len(kept[0.65]) == 4 and kept[0.8] == {3}
    st = {r.threshold: r for r in semantic.sweep_stats(rows).collect()}
    assert st[0.7].input == 6 and st[0.7].output == 3 and st[0.7].retention == 50 and abs(st[0.7].mean_similarity - 0.68) < 1e-9 and st[0.8].label == 80
    assert semantic.sweep_stats(rows.limit(0)).first().retention is None


def result(run, model, bleu, ter, comet, samples=()):
    return (run, "semantic_70", model, 10, ((bleu, []) if bleu is not None else None, 40.0, ter, comet), list(samples))


def test_compare(spark):
    df = spark.createDataFrame([result(1, "base", 20.0, 60.0, None), result(2, "tuned", 25.0, 66.0, 0.9), result(3, "tuned", 0.0, None, 0.5)], RESULT)
    got = {(r.run_id, r.metric): (r.delta, r.percent) for r in compare.previous_runs(df).collect()}
    assert got[2, "bleu"] == (5.0, 25.0) and got[2, "ter"] == (-6.0, -10.0) and (2, "comet") not in got and (3, "ter") not in got
    base = {(r.run_id, r.metric): r.delta for r in compare.against_baseline(df, F.col("model") == "base").collect()}
    assert base[2, "ter"] == 6.0 and base[3, "bleu"] == -20.0
    zero = compare.compare(compare.long_metrics(df.where("run_id = 3")), compare.long_metrics(df.where("run_id = 2")))
    assert {r.metric: r.percent for r in zero.collect()}["bleu"] == 0.0
    table = compare.sweep_table(df, F.lit(0.7))
    assert table.count() == 1 and table.first().run_id == 3
    best = compare.best(spark.createDataFrame([(0.65, 20.0), (0.8, 25.0), (0.75, 25.0), (0.7, None)], "threshold double, bleu double")).first()
    assert tuple(best) == (0.75, 25.0)


def test_review(spark):
    s = [("a", "giống hệt", "Giống hệt "), ("b", "tide", "diet"), ("c", "một các những cái", "khác hẳn"), ("d", None, None), ("e", "한 a b", "x")]
    df = spark.createDataFrame([result(1, "m", 1.0, 1.0, 0.9, s), (2, "t", "m", 0, None, None), result(3, "m", 1.0, 1.0, 0.1)], RESULT)
    rows = review.banded(review.samples(df, "run_id"))
    got = {r.sample_no: (r.band, r.similarity) for r in rows.collect()}
    assert got[0][0] == "perfect" and got[1] == ("wrong", 0.25) and got[3] == ("perfect", 1.0)
    issues = {(r.sample_no, r.issue) for r in review.reference_issues(rows, "run_id").collect()}
    assert issues == {(0, "too_short"), (1, "too_short"), (2, "potentially_literal"), (3, "too_short"), (4, "mixed_language")}
    assert {(r.band, r.n, r.pct) for r in review.band_counts(rows, ["run_id"], requested=10).collect()} == {("perfect", 2, 20.0), ("wrong", 3, 30.0)}
    advice = {(r.run_id, r.advice) for r in review.recommendations(review.band_counts(rows, ["run_id"]), df).collect()}
    assert advice == {(1, "more_data_or_filtering"), (1, "trust_comet")}
    assert review.examples(rows, ["run_id"]).count() == 3


def test_providers(spark):
    rows = spark.createDataFrame([(1, "xin chào", "xin chào"), (2, "xin chào", "hoàn toàn khác biệt"), (3, None, "")], "id int, src string, tgt string")
    vec = providers.provide(rows, "src_vec array<float>, tgt_vec array<float>", providers.hashed_vectors())
    sim = {r.id: r.similarity for r in semantic.with_similarity(vec, "src_vec", "tgt_vec").collect()}
    assert abs(sim[1] - 1) < 1e-6 and sim[2] < 0.7
    said = providers.provide(rows.select("id", F.col("src").alias("source")), "prediction string", providers.echo)
    assert {(r.id, r.prediction) for r in said.collect()} == {(1, "xin chào"), (2, "xin chào"), (3, None)}


def test_exact_median(spark):
    import random
    import statistics

    from pairmill.operators import semantic

    r = random.Random(2)
    for values in ([], [0.5], [1.0, 2.0], [0.25] * 9 + [0.75] * 9, [r.random() for _ in range(501)], [round(r.random(), 1) for _ in range(400)], [1e-300, 1.0, 1e300, -1e300]):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
        want = statistics.median(values) if values else None
        for few in (3, 50_000):
            assert semantic.exact_median(df, "v", buckets=8, few=few) == want, (len(values), few)
