"""Rule-based verdicts on sentence pairs: the first rule that fails gives the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.functions import text as T

REASONS = ("too_short", "boilerplate", "wrong_lang_ko", "wrong_lang_vi", "length_ratio", "number_inconsistent", "punct_density", "near_duplicate", "passed")


@dataclass(frozen=True)
class FilterConfig:
    """Parameters of the rules; languages other than ko and vi need a provider of probabilities."""

    min_length: int = 4
    use_langid: bool = True
    langid_threshold: float = 0.8
    src_lang: str = "ko"
    tgt_lang: str = "vi"
    length_ratio_min: float = 0.4
    length_ratio_max: float = 2.5
    max_number_diff: float = 0.3
    max_punctuation: float = 0.3
    use_near_dedup: bool = True


def failures(src: Column, tgt: Column, c: FilterConfig, src_prob: Column | None = None, tgt_prob: Column | None = None, ratio: Column | None = None) -> dict[str, Column]:
    """Condition of each rule's failure, in the order they are tried, cheap ones first. A null text counts as empty; text
    without letters passes the language rules, as nothing can be told about it."""
    s, t = F.coalesce(src, F.lit("")), F.coalesce(tgt, F.lit(""))
    out = {
        "too_short": (F.length(s) < c.min_length) | (F.length(t) < c.min_length),
        "boilerplate": T.boilerplate(s) | T.boilerplate(t) | T.useless(s) | T.useless(t),
    }
    if c.use_langid:
        out[f"wrong_lang_{c.src_lang}"] = F.coalesce((src_prob if src_prob is not None else T.language_probability(s, c.src_lang)) < c.langid_threshold, F.lit(False))
        out[f"wrong_lang_{c.tgt_lang}"] = F.coalesce((tgt_prob if tgt_prob is not None else T.language_probability(t, c.tgt_lang)) < c.langid_threshold, F.lit(False))
    ratio = T.length_ratio(s, t) if ratio is None else ratio
    out["length_ratio"] = ~F.coalesce((ratio > 0) & ratio.between(c.length_ratio_min, c.length_ratio_max), F.lit(False))
    out["number_inconsistent"] = T.number_divergence(s, t) > c.max_number_diff
    out["punct_density"] = F.coalesce(F.greatest(T.punctuation_density(s), T.punctuation_density(t)) >= c.max_punctuation, F.lit(True))
    return out


def verdict(pairs: DataFrame, src: str = "src", tgt: str = "tgt", config: FilterConfig = FilterConfig(), src_prob: Column | None = None, tgt_prob: Column | None = None) -> DataFrame:
    """Adds `reason` by the row-wise rules; near duplicates are a second stage (see `dedup.near_duplicates`)."""
    reason = F.lit("passed")
    for name, failed in reversed(failures(F.col(src), F.col(tgt), config, src_prob, tgt_prob, F.col("_ratio")).items()):
        reason = F.when(failed, name).otherwise(reason)
    # the ratio is needed several times; a column of its own is computed once
    counted = pairs.withColumn("_ratio", T.length_ratio(F.coalesce(src, F.lit("")), F.coalesce(tgt, F.lit(""))))
    return counted.withColumn("reason", reason).drop("_ratio")


def flags(pairs: DataFrame, src: str = "src", tgt: str = "tgt", config: FilterConfig = FilterConfig()) -> DataFrame:
    """Adds every rule's failure as a column of its own, without the first one hiding the rest."""
    return pairs.withColumns(failures(F.col(src), F.col(tgt), config))


def full_verdict(pairs: DataFrame, config: FilterConfig = FilterConfig(), key: str = "pair_id") -> DataFrame:
    """(key, keep, reason) by all rules, near duplicates among the pairs that passed the others included."""
    from pairmill.plans.runtime import cut

    from .dedup import near_duplicates

    first = verdict(pairs, config=config).select(key, "src", "reason")
    if not config.use_near_dedup:
        return first.select(key, (F.col("reason") == "passed").alias("keep"), "reason")
    # the rules run once: their verdicts are read several times from here on, with the text only where it goes on
    first = cut(first.withColumn("src", F.when(F.col("reason") == "passed", F.col("src"))))
    dropped = near_duplicates(first.where("reason = 'passed'").select(key, F.col("src").alias("text")), key).where("not kept").select(key, F.lit(True).alias("near"))
    reason = F.when(F.col("near"), "near_duplicate").otherwise(F.col("reason"))
    return first.join(dropped, key, "left").select(key, (reason == "passed").alias("keep"), reason.alias("reason"))
