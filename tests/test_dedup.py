import random

from pyspark.sql import functions as F

from pairmill.operators import dedup, rules


def greedy(edges, ids):
    kept = set()
    for i in sorted(ids):
        if not any(j in kept for j in edges.get(i, ())):
            kept.add(i)
    return kept


def test_chain_drops_the_middle_only(spark):
    # 1-2 share a bucket, 2-3 share another, 1-3 share none
    rows = spark.createDataFrame([(1, 0, 10), (2, 0, 10), (2, 1, 20), (3, 1, 20), (1, 1, 21), (3, 0, 11)], "id bigint, band int, bucket bigint")
    assert {r.id: r.kept for r in dedup.independent(rows).collect()} == {1: True, 2: False, 3: True}


def test_independent_against_brute_force(spark):
    r = random.Random(3)
    for _ in range(3):
        rows = [(i, b, r.randrange(12)) for i in range(60) for b in range(3)]
        by = {}
        for i, b, k in rows:
            by.setdefault((b, k), []).append(i)
        edges = {}
        for g in by.values():
            for i in g:
                edges.setdefault(i, set()).update(x for x in g if x < i)
        got = dedup.independent(spark.createDataFrame(rows, "id bigint, band int, bucket bigint")).collect()
        assert len(got) == 60 and {x.id for x in got if x.kept} == greedy(edges, range(60))


def test_near_duplicates(spark):
    base = [f"từ{i}" for i in range(40)]
    texts = [" ".join(base), " ".join(base[:39] + ["khác"]), " ".join(f"xa{i}" for i in range(30)), " ".join(base), "", None, " ".join(reversed(base))] + [" ".join(base)] * 50
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "pair_id bigint, text string")
    got = {r.pair_id: r.kept for r in dedup.near_duplicates(rows).collect()}
    assert 4 not in got and 5 not in got  # no words, no verdict
    assert got[0] and got[2] and not got[3] and not got[6] and not got[1] and not any(got[i] for i in range(7, 57))


def test_recall_of_bands_and_partition_independence(spark):
    r = random.Random(1)
    rows = []
    for i in range(200):
        words = [f"w{r.randrange(100000)}" for _ in range(40)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-1] + ["mới"]))]  # Jaccard 39/41
    df = spark.createDataFrame(rows, "pair_id bigint, text string")
    a = {r.pair_id for r in dedup.near_duplicates(df).where("not kept").collect()}
    assert sum(2 * i + 1 in a for i in range(200)) >= 190 and all(i % 2 for i in a)
    assert a == {r.pair_id for r in dedup.near_duplicates(df.repartition(7)).where("not kept").collect()}


def test_jaccard_pairs_is_exact(spark):
    r = random.Random(5)
    rows = [(i, " ".join(sorted({f"v{r.randrange(14)}" for _ in range(10)}))) for i in range(80)] + [(100, None), (101, ""), (102, "v1 v1 V1")]
    members, pairs = dedup.jaccard_pairs(spark.createDataFrame(rows, "pair_id bigint, text string"), threshold=0.6)
    cls = {m.pair_id: m["class"] for m in members.collect()}
    sets = {i: frozenset(t.lower().split()) for i, t in rows if t}
    assert set(cls) == set(sets) and all((cls[i] == cls[j]) == (sets[i] == sets[j]) for i in sets for j in sets)
    reps = sorted(set(cls.values()))
    want = {(a, b) for a in reps for b in reps if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}
    assert {(p.a, p.b) for p in pairs.collect()} == want


def test_exact_groups(spark):
    rows = spark.createDataFrame([(3, "A  b"), (1, "a B "), (2, "c"), (4, None)], "pair_id bigint, text string")
    assert sorted(map(tuple, dedup.exact_groups(rows).collect())) == [(1, 2), (2, 1)]


def test_full_verdict(spark):
    s = " ".join(f"단어{c}" for c in "가나다라마바사아자차카타파하")
    t = " ".join(["việt"] * 14)
    rows = spark.createDataFrame([(1, s, t), (2, s, t), (3, "abc", "x")], "pair_id bigint, src string, tgt string")
    got = {r.pair_id: (r.keep, r.reason) for r in rules.full_verdict(rows).collect()}
    assert got == {1: (True, "passed"), 2: (False, "near_duplicate"), 3: (False, "too_short")}
    assert rules.full_verdict(rows.withColumn("text", F.lit("clash")).withColumn("kept", F.lit(1))).count() == 3


def test_hot_buckets_are_dealt_out(spark, monkeypatch):
    rows = [(i, b, 7 if i % 3 else i * 10 + b) for i in range(90) for b in range(2)] + [(5, 1, 500), (200, 0, 500)]
    plain = {x.id: x.kept for x in dedup.independent(spark.createDataFrame(rows, "id bigint, band int, bucket bigint")).collect()}
    monkeypatch.setattr(dedup, "HOT_ROWS", 5)
    monkeypatch.setattr(dedup, "HOT_BUCKETS", 100)
    assert {x.id: x.kept for x in dedup.independent(spark.createDataFrame(rows, "id bigint, band int, bucket bigint")).collect()} == plain
    assert sum(plain.values()) == 32


def test_similar_sets_against_all_pairs(spark):
    r = random.Random(4)
    texts = []
    for n in (1, 2, 3, 7, 12, 20, 55, 62, 70, 90):
        for _ in range(6):
            w = [f"w{r.randrange(3 * n)}" for _ in range(n)]
            texts.append(w)
            for k in range(0, max(1, n // 5)):
                texts.append([x if r.random() > k / n else f"y{r.randrange(9)}" for x in w])
    for threshold in (0.6, 0.8, 0.85, 1.0):
        _, pairs = dedup.jaccard_pairs(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "pair_id bigint, text string"), threshold=threshold)
        sets, first = [set(t) for t in texts], {}
        for i, s in enumerate(sets):
            first.setdefault(frozenset(s), i)
        ids = sorted(first.values())
        want = {(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-12}
        assert {(x.a, x.b) for x in pairs.collect()} == want
