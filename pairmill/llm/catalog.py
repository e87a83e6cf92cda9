"""Queries p1 to p9 and their SQL where SQL can state them."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.plans.runtime import table

from . import canonical, crosssplit, formatdup, langid, leak, mixture, mojibake, pairdefects, repetition
from .fields import corpus_fields


@lru_cache(8)
def _trained(application: str, sf_dir: str) -> langid.Detector:
    documents = table(SparkSession.getActiveSession(), sf_dir, "documents")
    return langid.Detector(langid.train(langid.training_rows(documents)), langid.priors(documents))


def _detector(spark: SparkSession, sf_dir: str) -> langid.Detector:
    """The detector of these documents, trained once in an application."""
    return _trained(spark.sparkContext.applicationId, sf_dir)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of pairs not wholly in their language, and documents mixed or labelled wrongly or not at all: a row per language."""
    pairs = corpus_fields(spark, sf_dir).select(F.lit("pair_corpus").alias("rec_table"), F.col("pair_id").alias("rec_id"), "field", F.when(F.col("field") == "kor_Hang", "ko").otherwise("vi").alias("expected"), "text")
    docs = table(spark, sf_dir, "documents").where("text is not null").select(F.lit("documents").alias("rec_table"), F.col("doc_id").alias("rec_id"), F.lit("text").alias("field"), langid.label_language(F.col("lang")).alias("expected"), "text")
    rows = pairs.unionAll(docs).mapInArrow(langid.found_batches(_detector(spark, sf_dir)), "rec_table string, rec_id bigint, field string, lang string")
    return rows.dropDuplicates(["rec_table", "rec_id", "field", "lang"])


def _all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_table, rec_id, field, text) of both tables."""
    pairs = corpus_fields(spark, sf_dir).select(F.lit("pair_corpus").alias("rec_table"), F.col("pair_id").alias("rec_id"), "field", "text")
    docs = table(spark, sf_dir, "documents").where("text is not null").select(F.lit("documents").alias("rec_table"), F.col("doc_id").alias("rec_id"), F.lit("text").alias("field"), "text")
    return pairs.unionAll(docs)


def p1_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every segment of every text of pairs and documents with its language and confidence; pairs delivered again count once."""
    rows = _all_texts(spark, sf_dir).mapInArrow(langid.segment_batches(_detector(spark, sf_dir)), "rec_table string, rec_id bigint, field string, seg_no bigint, start bigint, bytes bigint, lang string, confidence double")
    return rows.dropDuplicates(["rec_table", "rec_id", "field", "seg_no"])


def p1_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of pairs and documents with its main language and confidence."""
    rows = _all_texts(spark, sf_dir).mapInArrow(langid.text_batches(_detector(spark, sf_dir)), "rec_table string, rec_id bigint, field string, lang string, confidence double")
    return rows.dropDuplicates(["rec_table", "rec_id", "field"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that hold the same pair as an earlier line, with the first line of their group."""
    return formatdup.copies(formatdup.hashed_lines(table(spark, sf_dir, "raw_lines")))


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per pair, with its number of copies."""
    return formatdup.records(formatdup.hashed_lines(table(spark, sf_dir, "raw_lines")))


def p3_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with stand-in characters, with their usual form; one row per field, pairs delivered again count once."""
    rows = corpus_fields(spark, sf_dir).where(F.col("text").rlike(canonical.TRIGGER))
    return rows.mapInArrow(canonical.changed_batches, "pair_id bigint, field string, canonical string").dropDuplicates(["pair_id", "field"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_canonical(spark, sf_dir).select("pair_id", "field")


def p5_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled fields with the encodings found and the original text, null where part of it is lost."""
    rows = corpus_fields(spark, sf_dir).where(F.col("text").rlike(mojibake.SUSPECT))
    return rows.mapInArrow(mojibake.found_batches, "pair_id bigint, field string, encodings array<string>, restored string").dropDuplicates(["pair_id", "field"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_restored(spark, sf_dir).select("pair_id", "field")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective answers in the pair corpus (sample 0 of a pair) and in the samples of evaluation runs, with their first defect."""
    pairs = table(spark, sf_dir, "pair_corpus").select(F.lit("pair_corpus").alias("rec_table"), F.col("pair_id").alias("rec_id"), F.lit(0).cast("bigint").alias("sample_no"), F.col("translation.kor_Hang").alias("prompt"), F.col("translation.vie_Latn").alias("response"))
    runs = table(spark, sf_dir, "eval_results").select("run_id", F.posexplode("samples").alias("sample_no", "s")).select(F.lit("eval_results").alias("rec_table"), F.col("run_id").alias("rec_id"), F.col("sample_no").cast("bigint"), F.col("s.source").alias("prompt"), F.col("s.prediction").alias("response"))
    rows = pairs.unionAll(runs).where(pairdefects.needs_parsing(F.col("prompt"), F.col("response")))
    return rows.mapInArrow(pairdefects.defect_batches, "rec_table string, rec_id bigint, sample_no bigint, defect string").dropDuplicates(["rec_table", "rec_id", "sample_no"])


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosssplit.overlaps(table(spark, sf_dir, "nllb_train"), {name: table(spark, sf_dir, f"nllb_{name}") for name in ("dev", "test")})


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of an evaluation row and a training row that hold the same or nearly the same text."""
    return _overlaps(spark, sf_dir).select("split", "eval_id", "train_id")


def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps per split and sources."""
    return crosssplit.counts(_overlaps(spark, sf_dir))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the test passages they repeat."""
    return p7_leaks(spark, sf_dir).select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the test passages they repeat, with the share of the passage's words."""
    return leak.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_passages"))


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets")
    tokens = mixture.counted(table(spark, sf_dir, "documents"), targets)
    return mixture.mixture(tokens, targets, mixture.whole(tokens, targets))


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all sources, in order."""
    return _mixture(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    return _mixture(spark, sf_dir)[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which at least 40 % of the words lie in repeated runs."""
    return repetition.repeating(table(spark, sf_dir, "documents"))


def p9_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own perplexity of every document with its language's bands, and its share of repeated words."""
    return repetition.repetition(table(spark, sf_dir, "documents"))


def p9_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the corpus model, with its language's band."""
    return repetition.corpus_perplexity(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_segments, p1_texts, p2_found, p2_records, p4_found, p6_found, p6_counts, p7_found, p7_leaks, p8_mixture, p8_shares, p9_found, p9_repetition, p9_perplexity, p3_found, p3_canonical, p5_found, p5_restored)}
# White space as Python's str.isspace sees it.
_SPACE = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _folded(path: str) -> str:
    return f"lower(regexp_replace(json_extract_string(line, '$.translation.{path}'), '[\\p{{P}}{_SPACE}]+', '', 'g'))"


_VALID = " AND ".join(["json_valid(line)", *[f"CASE WHEN json_valid(line) THEN json_type(line, '$.translation.{f}') END = 'VARCHAR'" for f in ("kor_Hang", "vie_Latn")]])
_GROUPS = f"""WITH l AS MATERIALIZED (SELECT line_id, line FROM raw_lines WHERE {_VALID}), f AS (SELECT line_id, {_folded('kor_Hang')} AS k, {_folded('vie_Latn')} AS v FROM l),
    g AS (SELECT line_id, min(line_id) OVER (PARTITION BY k, v) AS first, count(*) OVER (PARTITION BY k, v) AS copies FROM f WHERE k <> '' AND v <> '')"""

ORACLES: dict[str, str] = {
    "p2_found": f"{_GROUPS} SELECT first AS first_line_id, line_id FROM g WHERE line_id <> first",
    "p2_records": f"{_GROUPS} SELECT g.line_id, json_extract_string(line, '$.translation.kor_Hang') AS kor_Hang, json_extract_string(line, '$.translation.vie_Latn') AS vie_Latn, copies FROM g JOIN l USING (line_id) WHERE g.line_id = first",
    "p9_found": f"""WITH w AS (SELECT doc_id, list_filter(list_transform(string_split_regex(lower(text), '[{_SPACE}]+'), lambda x: regexp_replace(x, '\\p{{P}}+', '', 'g')), lambda x: x <> '') AS w
        FROM documents WHERE len(regexp_extract_all(text, '[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]')) * 3 < length(text)),
    g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
    again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS k FROM g) WHERE k > 1),
    covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM again) GROUP BY doc_id)
    SELECT doc_id FROM covered JOIN w USING (doc_id) WHERE n >= 0.4 * len(w)""",
}
