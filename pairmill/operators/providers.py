"""Models as providers of columns. The engine runs them over Arrow batches; what they compute is theirs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def provide(rows: DataFrame, columns: str, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]) -> DataFrame:
    """Adds columns that a model computes. `load` makes the model once per task; it takes and returns data frames of equal length.

    `columns` is their schema, such as "src_vec array<float>, tgt_vec array<float>".
    """
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for b in batches:
            yield pd.concat([b.reset_index(drop=True), model(b).reset_index(drop=True)], axis=1)

    return rows.mapInPandas(run, f"{base}, {columns}")


def echo() -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Translator for tests: the prediction is the source."""
    return lambda b: pd.DataFrame({"prediction": b["source"]})


def echo_loader() -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """Loader of `echo`, by which a command names it."""
    return echo


def hashed_vectors(dimensions: int = 64) -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """Encoder for tests: character trigrams hashed into a vector, the same for equal texts."""
    import zlib

    import numpy as np

    def vector(t: str | None) -> list[float]:
        v = np.zeros(dimensions, np.float32)
        t = f"  {t or ''} "
        for i in range(len(t) - 2):
            v[zlib.crc32(t[i : i + 3].encode()) % dimensions] += 1
        return v.tolist()

    return lambda: lambda b: pd.DataFrame({"src_vec": b["src"].map(vector), "tgt_vec": b["tgt"].map(vector)})
