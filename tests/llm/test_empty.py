"""Empty tables through the operators that aggregate before they compare."""

from pairmill.llm import crosssplit, mixture, repetition

SPLIT = "pair_no bigint, kor_Hang string, vie_Latn string, source string"


def test_empty_splits(spark):
    none = spark.createDataFrame([], SPLIT)
    one = spark.createDataFrame([(1, "가나다 라마바", "một hai ba", "s")], SPLIT)
    for train, dev in ((none, none), (one, none), (none, one)):
        found = crosssplit.overlaps(train, {"dev": dev})
        assert found.count() == 0 and crosssplit.counts(found).count() == 0
    null = spark.createDataFrame([(2, None, None, None)], SPLIT)
    assert crosssplit.overlaps(one, {"dev": one.withColumn("pair_no", one.pair_no + 1).unionAll(null)}).count() == 1


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    assert repetition.repetition(docs).count() == repetition.corpus_perplexity(docs).count() == 0
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", None, None)], "source string, target_share double, max_copies int")
    mix, shares = mixture.mixture(mixture.counted(docs.select("doc_id", "text", "source"), targets), targets)
    assert mix.count() == 0 and shares.count() == 2
