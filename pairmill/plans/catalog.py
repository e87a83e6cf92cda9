"""Registry of the engine's queries: name -> callable(spark, sf_dir), and name -> equivalent SQL.

Every query runs over its whole tables. Pairs delivered again are rows of their own where a query looks at rows, and
count once where it looks at pairs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.functions import text as T
from pairmill.operators import compare, dedup, metrics, review, rules, sampling, semantic, stats
from pairmill.plans.runtime import cut, shared_dir, table
from pairmill.sources import html, jsonl, results

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _pairs(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return table(spark, sf, "pair_corpus").select("pair_id", F.col("translation.kor_Hang").alias("src"), F.col("translation.vie_Latn").alias("tgt"), *more)


def _distinct(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return _pairs(spark, sf, *more).dropDuplicates(["pair_id"])


# ---- SQL of the same expressions
WS = T.WS
PAIRS = "(SELECT pair_id, translation.kor_Hang AS src, translation.vie_Latn AS tgt FROM pair_corpus)"
DISTINCT = "(SELECT pair_id, any_value(translation.kor_Hang) AS src, any_value(translation.vie_Latn) AS tgt FROM pair_corpus GROUP BY pair_id)"


def q_norm(t: str) -> str:
    return f"trim(regexp_replace(lower({t}), '{WS}+', ' ', 'g'), ' ')"


def q_words(t: str) -> str:
    return f"list_filter(string_split_regex({t}, '{WS}+'), lambda x: x <> '')"


def q_count(t: str, pattern: str) -> str:
    return f"len(regexp_extract_all({t}, '{pattern}'))"


def q_ratio(s: str, t: str) -> str:
    return f"(len({q_words(t)})::DOUBLE / nullif(len({q_words(s)}), 0)::DOUBLE)"


def q_divergence(s: str, t: str) -> str:
    a, b = (f"{q_count(x, chr(92) + 'p{Nd}+')}::DOUBLE" for x in (s, t))
    return f"coalesce(abs({a} - {b}) / nullif(greatest({a}, {b}), 0), CASE WHEN {s} IS NOT NULL AND {t} IS NOT NULL THEN 0.0 END)"


def q_density(t: str) -> str:
    return f"({q_count(t, chr(92) + 'p{P}')}::DOUBLE / nullif(length({t}), 0)::DOUBLE)"


def q_boilerplate(t: str) -> str:
    return f"regexp_matches({t}, '(?i){'|'.join(T.BOILERPLATE)}')"


def q_useless(t: str) -> str:
    return f"lower({t}) IN ({', '.join(repr(x) for x in T.USELESS)})"


def q_prob(t: str, lang: str) -> str:
    letters = f"nullif({q_count(t, chr(92) + 'p{L}')}, 0)::DOUBLE"
    if lang == "ko":
        return f"({q_count(t, T.HANGUL)}::DOUBLE / {letters})"
    latin = f"{q_count(t, chr(92) + 'p{Latin}')}::DOUBLE"
    return f"({latin} / {letters} * least(1.0::DOUBLE, coalesce({q_count(t, T.VIETNAMESE)}::DOUBLE * 10 / nullif({latin}, 0), 0.0::DOUBLE)))"


def q_failures(s: str = "src", t: str = "tgt") -> dict[str, str]:
    s, t = f"coalesce({s}, '')", f"coalesce({t}, '')"
    ratio = q_ratio(s, t)
    return {
        "too_short": f"(length({s}) < 4 OR length({t}) < 4)",
        "boilerplate": f"({q_boilerplate(s)} OR {q_boilerplate(t)} OR {q_useless(s)} OR {q_useless(t)})",
        "wrong_lang_ko": f"coalesce({q_prob(s, 'ko')} < 0.8, false)",
        "wrong_lang_vi": f"coalesce({q_prob(t, 'vi')} < 0.8, false)",
        "length_ratio": f"({ratio} IS NULL OR {ratio} = 0 OR NOT ({ratio} BETWEEN 0.4::DOUBLE AND 2.5::DOUBLE))",
        "number_inconsistent": f"({q_divergence(s, t)} > 0.3::DOUBLE)",
        "punct_density": f"coalesce(greatest({q_density(s)}, {q_density(t)}) >= 0.3::DOUBLE, true)",
    }


Q_REASON = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in q_failures().items()) + " ELSE 'passed' END"
Q_VERDICT = f"(SELECT pair_id, {Q_REASON} AS reason FROM {PAIRS})"

# ---- scalar projections


@query(f"SELECT pair_id, md5({q_norm('src')}) AS src_md5, md5({q_norm('tgt')}) AS tgt_md5 FROM {PAIRS}")
def norm_text_md5(spark, sf):
    return _pairs(spark, sf).select("pair_id", F.md5(T.normalized(F.col("src"))).alias("src_md5"), F.md5(T.normalized(F.col("tgt"))).alias("tgt_md5"))


@query(f"SELECT pair_id, len({q_words('src')})::BIGINT AS src_words, len({q_words('tgt')})::BIGINT AS tgt_words FROM {PAIRS}")
def word_count(spark, sf):
    return _pairs(spark, sf).select("pair_id", T.word_count(F.col("src")).alias("src_words"), T.word_count(F.col("tgt")).alias("tgt_words"))


@query(f"SELECT pair_id, length(src)::BIGINT AS src_chars, length(tgt)::BIGINT AS tgt_chars FROM {PAIRS}")
def char_length(spark, sf):
    return _pairs(spark, sf).select("pair_id", T.char_length(F.col("src")).alias("src_chars"), T.char_length(F.col("tgt")).alias("tgt_chars"))


@query(f"SELECT pair_id, round({q_ratio('src', 'tgt')}, 6) AS ratio, round(coalesce({q_ratio('src', 'tgt')}, 0), 6) AS review_ratio FROM {PAIRS}")
def length_ratio(spark, sf):
    ratio = T.length_ratio(F.col("src"), F.col("tgt"))
    return _pairs(spark, sf).select("pair_id", F.round(ratio, 6).alias("ratio"), F.round(F.coalesce(ratio, F.lit(0.0)), 6).alias("review_ratio"))


@query(rf"SELECT pair_id, array_to_string(regexp_extract_all(src, '\p{{Nd}}+'), ' ') AS src_numbers, {q_count('tgt', chr(92) + 'p{Nd}+')}::BIGINT AS tgt_count FROM {PAIRS}")
def number_extract_count(spark, sf):
    return _pairs(spark, sf).select("pair_id", F.array_join(T.numbers(F.col("src")), " ").alias("src_numbers"), F.size(T.numbers(F.col("tgt"))).cast("bigint").alias("tgt_count"))


@query(f"SELECT pair_id, round({q_divergence('src', 'tgt')}, 6) AS divergence FROM {PAIRS}")
def number_divergence(spark, sf):
    return _pairs(spark, sf).select("pair_id", F.round(T.number_divergence(F.col("src"), F.col("tgt")), 6).alias("divergence"))


@query(f"SELECT pair_id, round({q_density('src')}, 6) AS src_density, round({q_density('tgt')}, 6) AS tgt_density FROM {PAIRS}")
def punct_density(spark, sf):
    return _pairs(spark, sf).select("pair_id", F.round(T.punctuation_density(F.col("src")), 6).alias("src_density"), F.round(T.punctuation_density(F.col("tgt")), 6).alias("tgt_density"))


@query(f"SELECT doc_id, {q_boilerplate('text')} AS boilerplate FROM documents UNION ALL SELECT -pair_id, {q_boilerplate('tgt')} FROM {PAIRS}")
def boilerplate_flag(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", T.boilerplate(F.col("text")).alias("boilerplate"))
    return docs.unionAll(_pairs(spark, sf).select(-F.col("pair_id"), T.boilerplate(F.col("tgt"))))


@query(f"SELECT pair_id, {q_useless('src')} AS src_useless, {q_useless('tgt')} AS tgt_useless FROM {PAIRS}")
def useless_phrase_flag(spark, sf):
    return _pairs(spark, sf).select("pair_id", T.useless(F.col("src")).alias("src_useless"), T.useless(F.col("tgt")).alias("tgt_useless"))


@query("SELECT lang, CASE lang WHEN 'kor_Hang' THEN 'ko' WHEN 'vie_Latn' THEN 'vi' ELSE lang END AS code, count(*) AS n FROM documents GROUP BY lang")
def lang_code_map(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n")).select("lang", T.language_code(F.col("lang")).alias("code"), "n")


@query("SELECT CAST(trunc(similarity * 100) AS INT) AS label, count(*) AS n FROM pair_corpus GROUP BY 1")
def threshold_label(spark, sf):
    return table(spark, sf, "pair_corpus").groupBy(T.threshold_label(F.col("similarity")).alias("label")).agg(F.count("*").alias("n"))


@query(f"SELECT pair_id, regexp_matches(src, '[ᄁ-ᇾ]') AS src_mixed, regexp_matches(tgt, '[ᄁ-ᇾ]') AS tgt_mixed FROM {PAIRS}")
def mixed_language_flag(spark, sf):
    return _pairs(spark, sf).select("pair_id", T.mixed_language(F.col("src")).alias("src_mixed"), T.mixed_language(F.col("tgt")).alias("tgt_mixed"))


@query(f"SELECT pair_id, ({' + '.join(f'contains(lower(tgt), {m!r})::INT' for m in T.LITERAL_MARKERS)})::BIGINT AS score FROM {PAIRS}")
def literal_marker_score(spark, sf):
    return _pairs(spark, sf).select("pair_id", T.literal_score(F.col("tgt")).alias("score"))


@query(f"SELECT pair_id, round({q_prob('src', 'ko')}, 6) AS p_ko, round({q_prob('tgt', 'vi')}, 6) AS p_vi FROM {PAIRS}")
def langid_filter(spark, sf):
    return _pairs(spark, sf).select("pair_id", F.round(T.language_probability(F.col("src"), "ko"), 6).alias("p_ko"), F.round(T.language_probability(F.col("tgt"), "vi"), 6).alias("p_vi"))


@query("SELECT run_id, 'inference_' || list_extract(string_split(rtrim(model, '/'), '/'), -1) || '.json' AS file FROM eval_results")
def result_naming(spark, sf):
    return table(spark, sf, "eval_results").select("run_id", T.result_name(F.col("model")).alias("file"))


@query("SELECT vec_id, list_sum(list_transform(embedding, lambda x: least(greatest(CASE WHEN trunc(x * 100) = -100 THEN 1 ELSE trunc(x * 100)::INT END, 0), 15)))::BIGINT AS total FROM embeddings")
def array_clip_pad(spark, sf):
    ids = F.transform("embedding", lambda x: (x * 100).cast("int"))
    clipped = T.clipped_ids(ids, vocabulary=16)
    return table(spark, sf, "embeddings").select("vec_id", F.aggregate(clipped, F.lit(0), lambda a, x: a + x).cast("bigint").alias("total"))


# ---- filters


@query(f"SELECT pair_id, reason FROM {Q_VERDICT}")
def filter_verdict(spark, sf):
    return rules.verdict(_pairs(spark, sf)).select("pair_id", "reason")


@query(f"SELECT reason, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS pct FROM (SELECT reason, count(*) AS n FROM {Q_VERDICT} GROUP BY reason)")
def filter_rejection_report(spark, sf):
    return stats.rejection_report(rules.verdict(_pairs(spark, sf))).withColumn("pct", F.round("pct", 6))


@query("SELECT pair_id, " + ", ".join(f"{c} AS {n}" for n, c in q_failures().items()) + f" FROM {PAIRS}")
def rule_flags(spark, sf):
    return rules.flags(_pairs(spark, sf)).drop("src", "tgt")


@query(f"SELECT count(*) AS total, count(*) FILTER (reason = 'passed') AS passed, round(count(*) FILTER (reason = 'passed') * 100.0::DOUBLE / count(*), 6) AS retention FROM {Q_VERDICT}")
def retention(spark, sf):
    return stats.retention(rules.verdict(_pairs(spark, sf))).withColumn("retention", F.round("retention", 6))


@query()
def full_filter_verdict(spark, sf):
    """Verdicts by all rules, near duplicates included; MinHash has no SQL."""
    return rules.full_verdict(_distinct(spark, sf))


# ---- duplicates


@query(f"SELECT min(pair_id) AS first, count(*) AS copies FROM {DISTINCT} WHERE src IS NOT NULL GROUP BY md5({q_norm('src')})")
def exact_dedup_keep_first(spark, sf):
    return dedup.exact_groups(_distinct(spark, sf), text="src")


@query()
def lsh_greedy_dedup(spark, sf):
    """Which sources stay when near duplicates go, the first kept."""
    return dedup.near_duplicates(_distinct(spark, sf).select("pair_id", F.col("src").alias("text")))


Q_SPLITS = "(SELECT pair_no, kor_Hang AS text FROM nllb_train UNION ALL SELECT pair_no, kor_Hang FROM nllb_dev UNION ALL SELECT pair_no, kor_Hang FROM nllb_test)"


@query(
    f"""WITH s AS (SELECT pair_no, list_distinct({q_words(q_norm('text'))}) AS w FROM {Q_SPLITS} WHERE text IS NOT NULL),
    c AS (SELECT min(pair_no) AS id, any_value(w) AS w FROM s WHERE len(w) > 0 GROUP BY array_to_string(list_sort(w), ' ')),
    x AS (SELECT id, len(w) AS n, unnest(w) AS t FROM c),
    j AS (SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i FROM x a JOIN x b ON a.t = b.t AND a.id < b.id GROUP BY a.id, b.id)
    SELECT a, b, round(i / (na + nb - i)::DOUBLE, 6) AS jaccard FROM j WHERE i / (na + nb - i)::DOUBLE >= 0.85"""
)
def jaccard_pairs(spark, sf):
    """Sources of all splits with nearly the same words. The SQL counts the common words of all pairs that have any."""
    rows = [table(spark, sf, f"nllb_{s}").select("pair_no", F.col("kor_Hang").alias("text")) for s in ("train", "dev", "test")]
    return dedup.jaccard_pairs(rows[0].unionAll(rows[1]).unionAll(rows[2]), "pair_no")[1].withColumn("jaccard", F.round("jaccard", 6))


# ---- similarity


@query(
    """SELECT a.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 4) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def cosine_similarity(spark, sf):
    a = table(spark, sf, "embeddings")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select("vec_id", F.round(T.cosine(F.col("embedding"), F.col("other")), 4).alias("similarity"))


@query("SELECT pair_id, similarity FROM pair_corpus WHERE similarity >= 0.70")
def semantic_filter(spark, sf):
    return semantic.semantic_filter(table(spark, sf, "pair_corpus").select("pair_id", "similarity"), 0.70)


@query("SELECT pair_id, t::DOUBLE AS threshold FROM pair_corpus, (VALUES (0.65), (0.70), (0.75), (0.80)) v(t) WHERE similarity >= t::DOUBLE")
def threshold_sweep(spark, sf):
    return semantic.sweep(table(spark, sf, "pair_corpus").select("pair_id", "similarity")).select("pair_id", "threshold")


@query(
    """SELECT t::DOUBLE AS threshold, trunc(t::DOUBLE * 100)::INT AS label, count(*) AS input, count(*) FILTER (similarity >= t::DOUBLE) AS output,
    round(count(*) FILTER (similarity >= t::DOUBLE) * 100.0::DOUBLE / count(*), 6) AS retention, round(avg(similarity), 6) AS mean_similarity,
    round(median(similarity), 6) AS median_similarity, round(stddev_pop(similarity), 6) AS std_similarity
    FROM pair_corpus, (VALUES (0.65), (0.70), (0.75), (0.80)) v(t) GROUP BY t"""
)
def threshold_sweep_stats(spark, sf):
    out = semantic.sweep_stats(table(spark, sf, "pair_corpus").select("similarity"))
    return out.withColumns({c: F.round(c, 6) for c in ("retention", "mean_similarity", "median_similarity", "std_similarity")})


# ---- samples and splits


@query("SELECT pair_id FROM (SELECT DISTINCT pair_id FROM pair_corpus) ORDER BY md5('42:' || pair_id), pair_id LIMIT 200")
def sample_hash(spark, sf):
    return sampling.sample(table(spark, sf, "pair_corpus").select("pair_id").distinct(), 200, "pair_id")


@query(
    """WITH r AS (SELECT pair_id, row_number() OVER (ORDER BY md5('42:' || pair_id), pair_id) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT pair_id FROM pair_corpus))
    SELECT pair_id, CASE WHEN k <= trunc(0.95 * n) THEN 'train' WHEN k <= trunc(0.95 * n) + trunc(0.025 * n) THEN 'dev' ELSE 'test' END AS split FROM r"""
)
def split_assign(spark, sf):
    return sampling.split(table(spark, sf, "pair_corpus").select("pair_id").distinct(), "pair_id")


@query("WITH n AS (SELECT count(DISTINCT pair_id) AS n FROM pair_corpus) SELECT 'train' AS split, trunc(0.95 * n)::BIGINT AS n FROM n UNION ALL SELECT 'dev', trunc(0.025 * n)::BIGINT FROM n UNION ALL SELECT 'test', (n - trunc(0.95 * n) - trunc(0.025 * n))::BIGINT FROM n")
def split_sizes(spark, sf):
    return split_assign(spark, sf).groupBy("split").agg(F.count("*").alias("n"))


@query("SELECT line_id FROM raw_lines ORDER BY line_id LIMIT 100")
def head_n(spark, sf):
    return sampling.head(table(spark, sf, "raw_lines").select("line_id"), 100, "line_id")


@query("SELECT source, pair_id, rank FROM (SELECT source, pair_id, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || pair_id), pair_id) AS rank FROM (SELECT DISTINCT source, pair_id FROM pair_corpus)) WHERE rank <= 10")
def sample_per_group(spark, sf):
    return sampling.first_of_each(table(spark, sf, "pair_corpus").select("source", "pair_id").distinct(), "source", 10, "pair_id").withColumn("rank", F.col("rank").cast("bigint"))


# ---- scans of raw lines


@query("SELECT line_id, CASE WHEN json_valid(line) THEN json_extract_string(line, '$.translation.kor_Hang') END AS source, CASE WHEN json_valid(line) THEN json_extract_string(line, '$.translation.vie_Latn') END AS reference FROM raw_lines")
def keyed_scan(spark, sf):
    src, tgt = jsonl.keyed(F.col("line"))
    return table(spark, sf, "raw_lines").select("line_id", src.alias("source"), tgt.alias("reference"))


@query(
    """SELECT line_id, CASE WHEN json_valid(line) THEN json_extract_string(line -> 'translation', '$.' || json_keys(line -> 'translation')[1]) END AS source,
    CASE WHEN json_valid(line) THEN json_extract_string(line -> 'translation', '$.' || json_keys(line -> 'translation')[2]) END AS target FROM raw_lines"""
)
def positional_scan(spark, sf):
    src, tgt = jsonl.positional(F.col("line"))
    return table(spark, sf, "raw_lines").select("line_id", src.alias("source"), tgt.alias("target"))


@query(
    """SELECT line_id AS ordinal, problem FROM (SELECT line_id, CASE WHEN NOT json_valid(line) THEN 'malformed' WHEN NOT json_exists(line, '$.translation') THEN 'no_translation'
    WHEN json_extract_string(line, '$.translation.kor_Hang') IS NULL THEN 'no_kor_Hang' WHEN json_extract_string(line, '$.translation.vie_Latn') IS NULL THEN 'no_vie_Latn' END AS problem FROM raw_lines WHERE line IS NOT NULL) WHERE problem IS NOT NULL"""
)
def format_problems(spark, sf):
    return jsonl.problems(table(spark, sf, "raw_lines").where("line is not null").select(F.col("line_id").alias("ordinal"), F.col("line").alias("raw")))


# ---- comparisons

Q_LONG = "(SELECT run_id, test_file, model, 'bleu' AS metric, metrics.bleu.score AS value FROM eval_results UNION ALL SELECT run_id, test_file, model, 'chrf', metrics.chrf FROM eval_results UNION ALL SELECT run_id, test_file, model, 'ter', metrics.ter FROM eval_results UNION ALL SELECT run_id, test_file, model, 'comet', metrics.comet FROM eval_results)"
Q_DELTA = "round({d}, 6) AS delta, round(CASE WHEN {a} = 0 THEN 0 ELSE {d} * 100 / {a} END, 6) AS percent"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("percent", F.round("percent", 6)).withColumn("delta", F.round("delta", 6))


@query(f"SELECT run_id, metric, value FROM {Q_LONG} WHERE value IS NOT NULL")
def metric_unwrap(spark, sf):
    return compare.long_metrics(table(spark, sf, "eval_results"), "run_id")


@query(
    f"""WITH l AS (SELECT run_id, lag(run_id) OVER (PARTITION BY test_file ORDER BY run_id) AS before FROM eval_results), v AS (SELECT * FROM {Q_LONG} WHERE value IS NOT NULL)
    SELECT b.run_id, b.metric, a.value AS model1, b.value AS model2, {Q_DELTA.format(d="(CASE WHEN b.metric = 'ter' THEN a.value - b.value ELSE b.value - a.value END)", a='a.value')}
    FROM l JOIN v b ON b.run_id = l.run_id JOIN v a ON a.run_id = l.before AND a.metric = b.metric"""
)
def compare_models(spark, sf):
    return _rounded(compare.previous_runs(table(spark, sf, "eval_results")))


@query(
    f"""WITH v AS (SELECT * FROM {Q_LONG} WHERE value IS NOT NULL), base AS (SELECT test_file, max(run_id) AS run_id FROM eval_results WHERE model = 'base-600m' GROUP BY test_file)
    SELECT b.run_id, b.test_file, b.metric, a.value AS model1, b.value AS model2, {Q_DELTA.format(d='(b.value - a.value)', a='a.value')}
    FROM base JOIN v a ON a.run_id = base.run_id JOIN v b ON b.test_file = base.test_file AND b.metric = a.metric AND b.model <> 'base-600m'"""
)
def baseline_table(spark, sf):
    return _rounded(compare.against_baseline(table(spark, sf, "eval_results"), F.col("model") == "base-600m"))


def _threshold():
    return F.try_divide(F.try_to_number(F.regexp_extract("test_file", r"semantic_(\d+)", 1), F.lit("999")).cast("double"), F.lit(100.0))


Q_SWEEP = r"""(SELECT threshold, run_id, metrics.bleu.score AS bleu, metrics.chrf AS chrf, metrics.ter AS ter, metrics.comet AS comet, test_size FROM
    (SELECT *, try_cast(regexp_extract(test_file, 'semantic_(\d+)', 1) AS DOUBLE) / 100.0 AS threshold FROM eval_results) WHERE threshold IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY threshold ORDER BY run_id DESC) = 1)"""


@query(f"SELECT * FROM {Q_SWEEP}")
def sweep_table(spark, sf):
    return compare.sweep_table(table(spark, sf, "eval_results"), _threshold())


@query(f"SELECT arg_max(threshold, bleu) AS best_threshold, max(bleu) AS best_bleu FROM {Q_SWEEP}")
def sweep_best(spark, sf):
    return compare.best(sweep_table(spark, sf))


@query("SELECT test_file, count(*) AS runs, sum(test_size)::BIGINT AS sentences, round(sum(test_size) / sum(translation_time), 6) AS per_second FROM eval_results GROUP BY test_file")
def throughput(spark, sf):
    return table(spark, sf, "eval_results").groupBy("test_file").agg(F.count("*").alias("runs"), F.sum("test_size").alias("sentences"), F.round(F.try_divide(F.sum("test_size"), F.sum("translation_time")), 6).alias("per_second"))


@query(
    f"""WITH s AS (SELECT run_id, coalesce(s.reference, '') AS r FROM (SELECT run_id, unnest(samples) AS s FROM eval_results))
    SELECT run_id, (max(len(w)) * count(*))::BIGINT AS padded, sum(len(w))::BIGINT AS tokens FROM (SELECT run_id, {q_words('r')} AS w FROM s) GROUP BY run_id"""
)
def token_totals(spark, sf):
    rows = review.samples(table(spark, sf, "eval_results"), "run_id").select("run_id", T.words(F.coalesce("reference", F.lit(""))).alias("ids"))
    return stats.token_totals(rows, "ids", "run_id").select("run_id", F.col("padded").cast("bigint"), F.col("tokens").cast("bigint"))


@query(f"SELECT run_id, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS letters, len(w)::BIGINT AS tokens FROM (SELECT run_id, {q_words('r')}[1:8] AS w FROM (SELECT run_id, coalesce(s.reference, '') AS r FROM (SELECT run_id, unnest(samples) AS s FROM eval_results)))")
def truncated_tokens(spark, sf):
    """What is left of each reference when its words are cut to the model's length, eight here."""
    rows = review.samples(table(spark, sf, "eval_results"), "run_id").select("run_id", T.truncated(T.words(F.coalesce("reference", F.lit(""))), 8).alias("w"))
    return rows.select("run_id", F.when(F.size("w") > 0, F.aggregate("w", F.lit(0), lambda a, x: a + F.length(x))).cast("bigint").alias("letters"), F.size("w").cast("bigint").alias("tokens"))


@query("SELECT run_id, sample_no, s.source AS source, s.reference AS reference, s.prediction AS prediction FROM (SELECT run_id, (generate_subscripts(samples, 1) - 1)::BIGINT AS sample_no, unnest(samples) AS s FROM eval_results) WHERE sample_no < 3")
def first_samples(spark, sf):
    """The first three samples of each run."""
    return review.samples(table(spark, sf, "eval_results"), "run_id", first=3)


# ---- written and read again


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder for what a query writes, in the one all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"SELECT src, tgt, count(*) AS n FROM {PAIRS} GROUP BY src, tgt")
def jsonl_round_trip(spark, sf):
    """Pairs written as lines of JSON, read again by key; a null text is a key that is missing."""
    path = _folder(spark, "lines")
    jsonl.write_lines(_pairs(spark, sf).select(jsonl.as_line(F.col("src"), F.col("tgt")).alias("raw")), path)
    return jsonl.pairs(jsonl.read_lines(spark, path)).groupBy("src", "tgt").agg(F.count("*").alias("n"))


@query(f"SELECT src, tgt, count(*) AS n FROM {PAIRS} WHERE src IS NOT NULL AND tgt IS NOT NULL GROUP BY src, tgt")
def strict_scan(spark, sf):
    """Whole pairs written as lines, read again by a scan that fails on a malformed line."""
    path = _folder(spark, "strict")
    whole = _pairs(spark, sf).where("src is not null and tgt is not null")
    jsonl.write_lines(whole.select(jsonl.as_line(F.col("src"), F.col("tgt")).alias("raw")), path)
    return jsonl.read_strict(spark, path).select(F.col("translation.kor_Hang").alias("src"), F.col("translation.vie_Latn").alias("tgt")).groupBy("src", "tgt").agg(F.count("*").alias("n"))


@query(
    """WITH r AS (SELECT line_id, line, row_number() OVER (ORDER BY md5('42:' || line_id), line_id) AS k, count(*) OVER () AS n FROM raw_lines WHERE line IS NOT NULL AND NOT regexp_matches(line, '[\r\n]') AND trim(line) <> ''),
    s AS (SELECT line, CASE WHEN k <= trunc(0.95 * n) THEN 'train' WHEN k <= trunc(0.95 * n) + trunc(0.025 * n) THEN 'dev' ELSE 'test' END AS split FROM r)
    SELECT split, line AS raw, count(*) AS n FROM s GROUP BY split, line"""
)
def split_sink(spark, sf):
    """Lines of each split as its folder holds them."""
    path = _folder(spark, "splits")
    lines = table(spark, sf, "raw_lines").where(F.col("line").isNotNull() & ~F.col("line").rlike("[\\r\\n]") & (F.trim("line") != ""))
    jsonl.write_splits(sampling.split(lines.select("line_id", F.col("line").alias("raw")), "line_id"), path)
    return spark.read.text(path).select("split", F.col("value").alias("raw")).groupBy("split", "raw").agg(F.count("*").alias("n"))


@query("SELECT model, test_file, test_size, metrics.bleu.score AS bleu, metrics.chrf AS chrf, metrics.ter AS ter, metrics.comet AS comet, len(samples)::BIGINT AS samples, count(*) AS n FROM eval_results GROUP BY ALL")
def result_json_read(spark, sf):
    """Results written as a JSON document a file, read again; missing metrics are null."""
    path = _folder(spark, "results")
    rows = table(spark, sf, "eval_results")
    rows.repartition("run_id").withColumn("run", F.col("run_id")).write.partitionBy("run").option("maxRecordsPerFile", 1).json(path)
    read = results.read_results(spark, path).select("model", "test_file", "test_size", F.col("metrics.bleu.score").alias("bleu"), F.col("metrics.chrf").alias("chrf"), F.col("metrics.ter").alias("ter"), F.col("metrics.comet").alias("comet"), F.when(F.col("samples").isNotNull(), F.size("samples")).cast("bigint").alias("samples"))
    return read.groupBy(*read.columns).agg(F.count("*").alias("n"))


@query(f"SELECT src, tgt, count(*) AS n FROM (SELECT regexp_replace(src, '^{WS}+|{WS}+$', '', 'g') AS src, regexp_replace(tgt, '^{WS}+|{WS}+$', '', 'g') AS tgt FROM (SELECT coalesce(src, '') AS src, coalesce(tgt, '') AS tgt FROM {PAIRS}) WHERE NOT regexp_matches(src || tgt, '[\r\n]')) GROUP BY src, tgt")
def parallel_zip(spark, sf):
    """Texts written line by line to two files of the same order, put together again."""
    path = _folder(spark, "parallel")
    rows = cut(_pairs(spark, sf).select(F.coalesce("src", F.lit("")).alias("src"), F.coalesce("tgt", F.lit("")).alias("tgt")).where(~F.concat("src", "tgt").rlike("[\\r\\n]")))
    for name in ("src", "tgt"):  # the same partitions in the same order, so line i of both is row i
        rows.select(name).write.text(f"{path}/{name}")
    return jsonl.read_parallel(spark, f"{path}/src", f"{path}/tgt").groupBy("src", "tgt").agg(F.count("*").alias("n"))


# ---- analysis of samples

Q_SAMPLES = "(SELECT run_id, (generate_subscripts(samples, 1) - 1)::BIGINT AS sample_no, unnest(samples) AS s FROM eval_results)"


def _issue(name: str, condition: str) -> str:
    return f"SELECT run_id, sample_no, field, '{name}' AS issue FROM r WHERE {condition}"


Q_ISSUES = f"WITH r AS (SELECT run_id, sample_no, 'reference' AS field, coalesce(s.reference, '') AS r FROM {Q_SAMPLES} UNION ALL SELECT run_id, sample_no, 'prediction', coalesce(s.prediction, '') FROM {Q_SAMPLES}) " + " UNION ALL ".join(
    [_issue("too_short", f"len({q_words('r')}) < 3"), _issue("mixed_language", "regexp_matches(r, '[ᄁ-ᇾ]')"), _issue("potentially_literal", f"({' + '.join(f'contains(lower(r), {m!r})::INT' for m in T.LITERAL_MARKERS)}) >= 3")]
)


@query(Q_ISSUES)
def reference_issues(spark, sf):
    """Issues of the references, and of the predictions by the same rules, since references here have few."""
    rows = review.samples(table(spark, sf, "eval_results"), "run_id")
    both = rows.withColumn("f", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in ("reference", "prediction")])))
    return review.reference_issues(both.select("run_id", "sample_no", "f.field", F.col("f.text").alias("reference")), "run_id", "field")


@query(f"SELECT field, issue, count(*) AS n FROM ({Q_ISSUES}) GROUP BY field, issue")
def reference_issue_counts(spark, sf):
    return reference_issues(spark, sf).groupBy("field", "issue").agg(F.count("*").alias("n"))


@query()
def similarity_bands(spark, sf):
    """Share of each band of sequence similarity per run; the measure has no SQL."""
    return review.band_counts(review.banded(review.samples(table(spark, sf, "eval_results"), "run_id")), ["run_id"])


@query()
def band_examples(spark, sf):
    return review.examples(review.banded(review.samples(table(spark, sf, "eval_results"), "run_id")), ["run_id"])


@query()
def recommendations(spark, sf):
    return review.recommendations(similarity_bands(spark, sf), table(spark, sf, "eval_results"))


def q_escaped(t: str) -> str:
    out = f"coalesce({t}, '')"
    for x, y in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = f"replace({out}, '{x}', '{y}')"
    return out


def _card_sql() -> str:
    numbers = {t: f"regexp_extract_all({t}, '{chr(92)}p{{Nd}}+')" for t in ("src", "tgt")}
    words = {t: f"len({q_words(t)})" for t in ("src", "tgt")}
    # a null text makes the numbers, and so the card, what the engine's null rules make them
    listed = f"CASE WHEN len({numbers['src']}) + len({numbers['tgt']}) > 0 THEN ' · numbers ' || array_to_string({numbers['src']}, ' ') || ' / ' || array_to_string({numbers['tgt']}, ' ') ELSE '' END"
    marks = " || ".join(f"""'<label><input type="radio" name="q' || pair_id || '" value="{m}"> {m}</label> '""" for m in ("good", "style", "wrong"))
    count = lambda t: f"coalesce({words[t]}::VARCHAR, 'null')"
    ratio = f"printf('%.2f', round(coalesce({q_ratio('src', 'tgt')}, 0), 2))"
    return f"""SELECT pair_id, '<article><b>' || pair_id || '</b><p lang="ko">' || {q_escaped('src')} || '</p><p lang="vi">' || {q_escaped('tgt')} || '</p><small>words ' || {count('src')} || ' / ' || {count('tgt')} || ', ratio ' || {ratio} || {listed} || '</small><div>' || {marks} || '</div></article>' AS card FROM {DISTINCT}"""


@query(_card_sql())
def review_cards(spark, sf):
    """A review card of every pair, as HTML."""
    return html.cards(_distinct(spark, sf))


# ---- metrics


def q_13a(t: str) -> str:
    out = f"coalesce({t}, '')"
    for a, b in metrics.TOKENIZE_13A:
        out = f"replace({out}, '{a}', '{b}')"
    out = f"' ' || {out} || ' '"
    for a, b in metrics.SPACING_13A:
        out = f"regexp_replace({out}, '{a}', '{b.replace('$', chr(92))}', 'g')"
    return q_words(out)


def _bleu_sql() -> str:
    precision = [f"CASE WHEN t{n} = 0 THEN 0.0::DOUBLE WHEN m{n} = 0 THEN 100.0::DOUBLE / (pow(2.0, {' + '.join(f'(m{k} = 0 AND t{k} > 0)::INT' for k in range(1, n + 1))}) * t{n}) ELSE m{n} * 100.0::DOUBLE / t{n} END" for n in range(1, 5)]
    brevity = "CASE WHEN hl = 0 THEN 0.0::DOUBLE WHEN hl < rl THEN exp(1 - rl / hl) ELSE 1.0::DOUBLE END"
    sums = ", ".join(f"coalesce(sum(m) FILTER (n = {n}), 0)::DOUBLE AS m{n}, coalesce(sum(t) FILTER (n = {n}), 0)::DOUBLE AS t{n}" for n in range(1, 5))
    return f"""WITH s AS MATERIALIZED (SELECT run_id, sample_no, {q_13a('s.prediction')} AS h, {q_13a('s.reference')} AS r FROM {Q_SAMPLES}),
    l AS (SELECT run_id, sum(len(h))::DOUBLE AS hl, sum(len(r))::DOUBLE AS rl FROM s GROUP BY run_id),
    k AS (SELECT s.*, n FROM s, (VALUES (1), (2), (3), (4)) v(n)),
    hg AS (SELECT run_id, sample_no, n, g, count(*) AS c FROM (SELECT run_id, sample_no, n, unnest(list_transform(range(1, len(h) - n + 2), lambda i: array_to_string(h[i:i + n - 1], chr(1)))) AS g FROM k) GROUP BY ALL),
    rg AS (SELECT run_id, sample_no, n, g, count(*) AS c FROM (SELECT run_id, sample_no, n, unnest(list_transform(range(1, len(r) - n + 2), lambda i: array_to_string(r[i:i + n - 1], chr(1)))) AS g FROM k) GROUP BY ALL),
    x AS (SELECT hg.run_id, hg.n, sum(hg.c) AS t, sum(least(hg.c, coalesce(rg.c, 0))) AS m FROM hg LEFT JOIN rg USING (run_id, sample_no, n, g) GROUP BY ALL),
    w AS (SELECT l.run_id, any_value(hl) AS hl, any_value(rl) AS rl, {sums} FROM l LEFT JOIN x USING (run_id) GROUP BY l.run_id),
    p AS (SELECT *, {', '.join(f'{e} AS p{n}' for n, e in enumerate(precision, 1))}, {brevity} AS brevity FROM w)
    SELECT run_id, round(CASE WHEN least(t1, t2, t3, t4) > 0 AND m1 > 0 THEN brevity * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) ELSE 0 END, 4) AS bleu,
    {', '.join(f'round(p{n}, 4) AS p{n}' for n in range(1, 5))}, round(brevity, 4) AS brevity, hl::BIGINT AS hyp_len, rl::BIGINT AS ref_len FROM p"""


@query(_bleu_sql())
def bleu_corpus(spark, sf):
    out = metrics.bleu(review.samples(table(spark, sf, "eval_results"), "run_id"), ["run_id"])
    return out.withColumns({c: F.round(c, 4) for c in ("bleu", "p1", "p2", "p3", "p4", "brevity")})


@query(
    f"""WITH s AS (SELECT run_id, sample_no, regexp_replace(coalesce(s.prediction, ''), '{WS}+', '', 'g') AS h, regexp_replace(coalesce(s.reference, ''), '{WS}+', '', 'g') AS r FROM {Q_SAMPLES}),
    k AS (SELECT s.*, n FROM s, (VALUES (1), (2), (3), (4), (5), (6)) v(n)),
    hg AS (SELECT run_id, sample_no, n, g, count(*) AS c FROM (SELECT run_id, sample_no, n, unnest(list_transform(range(1, length(h) - n + 2), lambda i: substring(h, i, n))) AS g FROM k) GROUP BY ALL),
    rg AS (SELECT run_id, sample_no, n, g, count(*) AS c FROM (SELECT run_id, sample_no, n, unnest(list_transform(range(1, length(r) - n + 2), lambda i: substring(r, i, n))) AS g FROM k) GROUP BY ALL),
    m AS (SELECT run_id, n, sum(least(hg.c, rg.c)) AS m FROM hg JOIN rg USING (run_id, sample_no, n, g) GROUP BY ALL),
    t AS (SELECT run_id, n, sum(greatest(length(h) - n + 1, 0)) AS h, sum(greatest(length(r) - n + 1, 0)) AS r FROM k GROUP BY ALL),
    o AS (SELECT t.run_id, avg(coalesce(m, 0) / t.h) AS p, avg(coalesce(m, 0) / t.r) AS r FROM t LEFT JOIN m USING (run_id, n) WHERE t.h > 0 AND t.r > 0 GROUP BY t.run_id)
    SELECT d.run_id, round(coalesce(100.0::DOUBLE * 5 * p * r / nullif(4 * p + r, 0), 0), 4) AS chrf FROM (SELECT DISTINCT run_id FROM s) d LEFT JOIN o USING (run_id)"""
)
def chrf_corpus(spark, sf):
    return metrics.chrf(review.samples(table(spark, sf, "eval_results"), "run_id"), ["run_id"]).withColumn("chrf", F.round("chrf", 4))


@query()
def ter_corpus(spark, sf):
    """TER with greedy shifts, and the word error rate without; no SQL for shifts."""
    return metrics.ter(review.samples(table(spark, sf, "eval_results"), "run_id"), ["run_id"])
