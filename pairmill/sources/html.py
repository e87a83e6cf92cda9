"""Review pages: cards of pairs are rendered as a column, the page is put together from a bounded sample."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.operators.review import pair_view

STYLE = "body{font:16px sans-serif;max-width:70em;margin:auto}article{border:1px solid #bbb;margin:1em 0;padding:.8em}[lang=ko]{border-left:4px solid #27c}[lang=vi]{border-left:4px solid #2a5}small{color:#555}"


def escaped(t: Column) -> Column:
    t = F.coalesce(t, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def cards(pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    """(key, card): a pair with its word counts, ratio and numbers, and three marks to choose from."""
    v = pair_view(pairs, key)
    numbers = F.when(F.size("src_numbers") + F.size("tgt_numbers") > 0, F.concat(F.lit(" · numbers "), F.array_join("src_numbers", " "), F.lit(" / "), F.array_join("tgt_numbers", " "))).otherwise("")
    marks = [F.concat(F.lit('<label><input type="radio" name="q'), F.col(key).cast("string"), F.lit(f'" value="{m}"> {m}</label> ')) for m in ("good", "style", "wrong")]
    card = F.concat(
        F.lit("<article><b>"), F.col(key).cast("string"), F.lit('</b><p lang="ko">'), escaped(F.col("src")), F.lit('</p><p lang="vi">'), escaped(F.col("tgt")),
        F.lit("</p><small>words "), F.format_string("%d / %d, ratio %.2f", "src_words", "tgt_words", F.round("ratio", 2)), numbers, F.lit("</small><div>"), *marks, F.lit("</div></article>"),
    )
    return v.select(key, card.alias("card"))


def write_page(sections: dict[str, list[str]], path: str, title: str) -> None:
    parts = [f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title><style>{STYLE}</style></head><body><h1>{title}</h1>']
    for name, fragments in sections.items():
        parts += [f"<h2>{name} ({len(fragments)})</h2>", *fragments]
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text("\n".join([*parts, "</body></html>"]), encoding="utf-8")


def review_page(sample: DataFrame, path: str, title: str = "Sample review", key: str = "pair_id") -> int:
    """A page of a sample, which the caller has bounded; returns the number of cards."""
    fragments = [r.card for r in cards(sample, key).orderBy(key).collect()]
    write_page({"Pairs": fragments}, path, title)
    return len(fragments)


def threshold_page(sample: DataFrame, path: str = "threshold_comparison.html", shown: int = 10, key: str = "pair_id") -> int:
    """Thresholds ascending, the first `shown` pairs of each; sample has threshold, rank and the pair."""
    rows = cards(sample.where(F.col("rank") <= shown), key).join(sample.select(key, "threshold", "rank"), key).orderBy("threshold", "rank").collect()
    sections: dict[str, list[str]] = {}
    for r in rows:
        sections.setdefault(f"Threshold {r.threshold:.2f}", []).append(r.card)
    write_page(sections, path, "Threshold comparison")
    return len(rows)
