"""Command line: check, filter, sweep, split, review, translate, analyse and compare pairs and results in files."""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.operators import compare, dedup, metrics, providers, review, rules, sampling, semantic, stats
from pairmill.plans.runtime import cut
from pairmill.sources import html, jsonl, results


def _filter(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = jsonl.pairs(jsonl.read_lines(spark, a.input))
    if a.mode == "basic":
        config = rules.FilterConfig(min_length=a.min_length, use_langid=a.langid, use_near_dedup=a.near_dedup, langid_threshold=a.langid_threshold, length_ratio_min=a.length_ratio_min, length_ratio_max=a.length_ratio_max)
        done = rules.full_verdict(rows, config)
        kept = done.where("keep").join(rows.select("pair_id", "raw"), "pair_id")
        jsonl.write_lines(kept, a.output, order="pair_id")
        stats.rejection_report(done).show(truncate=False)
        return
    scored = _scored(rows, a)
    if a.mode == "semantic":
        jsonl.write_lines(semantic.semantic_filter(scored, a.threshold), a.output, order="pair_id")
        return
    scored = scored.persist()
    for t in a.thresholds:
        jsonl.write_lines(semantic.semantic_filter(scored, t), f"{a.output_dir}/semantic_{int(t * 100)}.jsonl", order="pair_id")
    results.write_summary(semantic.sweep_stats(scored, a.thresholds), f"{a.output_dir}/sweep_summary.json", key="threshold", ascii_only=True)


def _scored(rows: DataFrame, a: argparse.Namespace) -> DataFrame:
    """Adds similarity: a field of the lines, or the cosine of the vectors of a named provider."""
    if a.similarity:
        return rows.withColumn("similarity", F.try_variant_get(F.try_parse_json("raw"), f"$.{a.similarity}", "double"))
    if a.provider:
        load = _named(a.provider)
    elif a.mode == "semantic":
        raise SystemExit("--mode semantic takes its similarities from --similarity FIELD or --provider MODULE:FUNCTION")
    else:
        print("warning: without --similarity or --provider the sweep scores pairs with an encoder for tests; its figures mean nothing", file=sys.stderr)
        load = providers.hashed_vectors()
    return semantic.with_similarity(providers.provide(rows, "src_vec array<float>, tgt_vec array<float>", load), "src_vec", "tgt_vec").drop("src_vec", "tgt_vec")


def _named(provider: str):
    """Loader of a model by MODULE:FUNCTION; the function takes no arguments."""
    module, _, name = provider.partition(":")
    return getattr(importlib.import_module(module), name)()


def _split(spark: SparkSession, a: argparse.Namespace) -> None:
    jsonl.write_splits(sampling.split(jsonl.read_lines(spark, a.input), "ordinal", a.seed), a.output)


def _review(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.compare:
        _review_thresholds(spark, a)
        return
    if not a.input:
        raise SystemExit("review takes --input FILE, or --compare with --filtered-dir and --thresholds")
    rows = jsonl.pairs(jsonl.read_lines(spark, a.input))
    html.review_page(sampling.sample(rows, a.num_samples, "pair_id"), a.output)


def _review_thresholds(spark: SparkSession, a: argparse.Namespace) -> None:
    """A sample of what each threshold kept, side by side; thresholds without a file are left out."""
    parts = []
    for t in sorted(a.thresholds):
        path = f"{a.filtered_dir}/semantic_{int(t * 100)}.jsonl"
        if not jsonl.exists(spark, path):
            print(f"no {path}", file=sys.stderr)
            continue
        rows = jsonl.pairs(jsonl.read_lines(spark, path)).withColumn("threshold", F.lit(float(t)))
        # the pages of two thresholds number their pairs alike, so the threshold goes before
        parts.append(sampling.first_of_each(rows, "threshold", a.num_samples, "pair_id").withColumn("pair_id", F.concat(F.format_string("%.2f-", "threshold"), F.col("pair_id").cast("string"))))
    if not parts:
        raise SystemExit(f"no filtered pairs in {a.filtered_dir}")
    shown = parts[0]
    for p in parts[1:]:
        shown = shown.unionAll(p)
    html.threshold_page(shown.select("pair_id", "src", "tgt", "threshold", "rank"), a.output, shown=a.shown)


def _check(spark: SparkSession, a: argparse.Namespace) -> None:
    """Lines that hold no pair, by problem; ends with 1 if there are any."""
    found = jsonl.problems(jsonl.read_lines(spark, a.input), a.first or None).groupBy("problem").agg(F.count("*").alias("lines"), F.min("ordinal").alias("first")).orderBy("problem").collect()  # a row per kind of problem
    for r in found:
        print(f"{r.problem}: {r.lines} lines, the first is {r.first}")
    if found:
        raise SystemExit(1)
    print("every line holds a pair")


def _config(spark: SparkSession, a: argparse.Namespace) -> None:
    for t in a.thresholds:
        results.write_config(results.run_config(t, a.base, a.max_steps), f"{a.output_dir}/sweep_config_{int(t * 100)}.yaml")


def _best(spark: SparkSession, a: argparse.Namespace) -> None:
    """Results of a sweep's runs, the last of each threshold, and the threshold of the highest BLEU."""
    runs = results.read_results(spark, a.results).withColumn("run_id", F.monotonically_increasing_id())
    label = F.try_to_number(F.regexp_extract("test_file", r"semantic_(\d+)", 1), F.lit("999")).cast("double") / 100.0
    rows = compare.sweep_table(runs, label)
    rows.orderBy("threshold").show()
    best = compare.best(rows)
    best.show()
    if a.output:
        found = best.first()
        results.write_document({"results": {str(d["threshold"]): d for d in results.as_dicts(rows)}, "best_threshold": found.best_threshold, "best_bleu": found.best_bleu}, a.output)


def _infer(spark: SparkSession, a: argparse.Namespace) -> None:
    """Translations of a named provider over keyed pairs, scored; a result as `analyse` and `compare` read it."""
    pairs = jsonl.pairs(jsonl.read_lines(spark, a.input)).where("src is not null and tgt is not null")
    pairs = pairs.where(F.col("pair_id") < a.max_samples) if a.max_samples else pairs
    rows = pairs.select(F.lit(0).alias("run_id"), F.col("pair_id").alias("sample_no"), F.col("src").alias("source"), F.col("tgt").alias("reference"))
    done = cut(providers.provide(rows, "prediction string", _named(a.provider)))
    scores = metrics.all_metrics(done, ["run_id"]).first()
    shown = done.orderBy("sample_no").limit(a.num_examples).select("source", "reference", "prediction").collect()
    bleu = {"score": scores.bleu, "precisions": [scores.p1, scores.p2, scores.p3, scores.p4]}
    document = {"model": a.model, "test_file": a.input, "test_size": done.count(), "metrics": {"bleu": bleu, "chrf": scores.chrf, "ter": scores.ter}, "samples": [r.asDict() for r in shown]}
    results.write_document(document, a.output or results.default_name(a.model))


def _analyse(spark: SparkSession, a: argparse.Namespace) -> None:
    runs = results.read_results(spark, a.finetuned).withColumn("run_id", F.lit(2))
    rows = review.banded(review.samples(runs, "run_id", first=a.num_examples))
    bands = review.band_counts(rows, ["run_id"], a.num_examples if a.denominator == "requested" else None)
    bands.show()
    review.recommendations(bands, runs).show(truncate=False)
    review.reference_issues(rows, "run_id").groupBy("issue").count().show()
    if a.baseline:
        base = results.read_results(spark, a.baseline)
        compare.compare(compare.long_metrics(base), compare.long_metrics(runs), ter_inverted=False).show()


def _compare(spark: SparkSession, a: argparse.Namespace) -> None:
    one, two = (results.read_results(spark, p) for p in (a.first, a.second))
    out = compare.compare(compare.long_metrics(one), compare.long_metrics(two))
    out.show()
    if a.output:
        results.write_summary(out, a.output, key="metric")


def _score(spark: SparkSession, a: argparse.Namespace) -> None:
    runs = results.read_results(spark, a.results)
    metrics.all_metrics(review.samples(runs, "model"), ["model"]).show(truncate=False)


def _dedup(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = jsonl.pairs(jsonl.read_lines(spark, a.input))
    kept = dedup.near_duplicates(rows.select("pair_id", F.col("src").alias("text"))).where("kept").join(rows.select("pair_id", "raw"), "pair_id")
    jsonl.write_lines(kept, a.output, order="pair_id")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pairmill", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, *need: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        for n in need:
            c.add_argument(f"--{n}", required=True)
        return c

    f = command("filter", _filter, "input")
    f.add_argument("--output")
    f.add_argument("--output-dir", default="data/sweep")
    f.add_argument("--mode", choices=("basic", "semantic", "sweep"), default="basic")
    given = f.add_mutually_exclusive_group()
    given.add_argument("--similarity", metavar="FIELD", help="field of the lines that holds the similarity")
    given.add_argument("--provider", metavar="MODULE:FUNCTION", help="function that, called without arguments, gives the loader of a model of src_vec and tgt_vec, as providers.hashed_vectors does")
    f.add_argument("--langid", action=argparse.BooleanOptionalAction, default=True)
    f.add_argument("--near-dedup", action=argparse.BooleanOptionalAction, default=True)
    f.add_argument("--langid-threshold", type=float, default=0.8)
    f.add_argument("--length-ratio-min", type=float, default=0.4)
    f.add_argument("--length-ratio-max", type=float, default=2.5)
    f.add_argument("--min-length", type=int, default=4)
    f.add_argument("--threshold", type=float, default=0.70)
    f.add_argument("--thresholds", type=float, nargs="+", default=list(semantic.THRESHOLDS))
    command("split", _split, "input", "output").add_argument("--seed", type=int, default=42)
    r = command("review", _review, "output")
    r.add_argument("--input")
    r.add_argument("--num-samples", type=int, default=200)
    r.add_argument("--compare", action="store_true", help="samples of what each threshold kept instead of one file")
    r.add_argument("--thresholds", type=float, nargs="+", default=list(semantic.THRESHOLDS))
    r.add_argument("--filtered-dir", default="data/sweep")
    r.add_argument("--shown", type=int, default=10, help="pairs of each threshold on the page")
    command("check", _check, "input").add_argument("--first", type=int, default=0, help="lines to look at; 0 for all")
    g = command("config", _config, "output-dir")
    g.add_argument("--thresholds", type=float, nargs="+", default=list(semantic.THRESHOLDS))
    g.add_argument("--base", default=".")
    g.add_argument("--max-steps", type=int, default=5000)
    command("best", _best, "results").add_argument("--output")
    i = command("infer", _infer, "input", "provider", "model")
    i.add_argument("--output")
    i.add_argument("--max-samples", type=int, default=0, help="pairs to translate; 0 for all")
    i.add_argument("--num-examples", type=int, default=10)
    a = command("analyse", _analyse, "finetuned")
    a.add_argument("--baseline")
    a.add_argument("--num-examples", type=int, default=100)
    a.add_argument("--denominator", choices=("requested", "actual"), default="requested")
    command("compare", _compare, "first", "second").add_argument("--output")
    command("score", _score, "results")
    command("dedup", _dedup, "input", "output")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("pairmill").getOrCreate()
    a.run(spark, a)


if __name__ == "__main__":
    main()
