"""Evaluation and inference results, summaries and run configurations."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVALUATION = (
    "model STRING, test_file STRING, test_size BIGINT, translation_time DOUBLE, sentences_per_second DOUBLE, "
    "metrics STRUCT<bleu: STRUCT<score: DOUBLE, precisions: ARRAY<DOUBLE>>, chrf: DOUBLE, ter: DOUBLE, comet: DOUBLE>, "
    "samples ARRAY<STRUCT<source: STRING, reference: STRING, prediction: STRING>>"
)
INFERENCE = (
    "model STRING, device STRING, test_size BIGINT, batch_size BIGINT, num_beams BIGINT, "
    "performance STRUCT<load_time_s: DOUBLE, translation_time_s: DOUBLE, sentences_per_sec: DOUBLE, tokens_per_sec: DOUBLE, gpu_memory_gb: STRUCT<before: DOUBLE, after: DOUBLE, peak: DOUBLE>>, "
    "quality STRUCT<bleu: DOUBLE, precisions: ARRAY<DOUBLE>>, samples ARRAY<STRUCT<source: STRING, reference: STRING, prediction: STRING>>"
)


def read_results(spark: SparkSession, path: str | list[str], schema: str = EVALUATION) -> DataFrame:
    """One JSON document per file; a metric that is missing is null."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def summary_line(*columns: str):
    """The columns as a JSON object, text unescaped, nulls left out."""
    return F.to_json(F.struct(*columns))


def write_summary(rows: DataFrame, path: str, key: str | None = None, ascii_only: bool = False) -> dict | list:
    """Write a small result, a row per threshold or metric, as one JSON document: by key if one is named. Returns it."""
    data = as_dicts(rows)
    out = {str(d.pop(key)): d for d in data} if key else data
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(out, ensure_ascii=ascii_only, indent=2), encoding="utf-8")
    return out


def as_dicts(rows: DataFrame) -> list[dict]:
    """Rows of a small result, nulls left out."""
    return [json.loads(r[0]) for r in rows.select(summary_line(*rows.columns)).collect()]


def write_document(document: dict, path: str) -> None:
    """One JSON document, text unescaped."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(document, ensure_ascii=False, indent=2), encoding="utf-8")


def default_name(model: str) -> str:
    """File of a model's inference result: the last part of its path."""
    return f"inference_{model.rstrip('/').rpartition('/')[2]}.json"


def load_config(path: str) -> dict:
    """A run's YAML configuration: nested sections of scalars."""
    try:
        import yaml

        return yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except ImportError:
        return _plain_yaml(Path(path).read_text(encoding="utf-8"))


def _plain_yaml(text: str) -> dict:
    """Sections of `key: value` lines, two levels deep, which is all a run's configuration has."""
    out: dict = {}
    section = out
    for line in text.splitlines():
        body = line.split(" #")[0].rstrip()
        if not body.strip() or body.lstrip().startswith("#"):
            continue
        key, _, value = body.strip().partition(":")
        if not value.strip():
            section = out.setdefault(key, {})
        elif line[0].isspace():
            section[key] = _scalar(value.strip())
        else:
            section = out
            out[key] = _scalar(value.strip())
    return out


def _scalar(v: str):
    low = v.lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("null", "~"):
        return None
    for kind in (int, float):
        try:
            return kind(v)
        except ValueError:
            pass
    return v.strip("'\"")


# Settings of a sweep's training runs.
LENGTHS = {"max_length": 256, "max_source_length": 256, "max_target_length": 256}
TRAINING = {
    "per_device_train_batch_size": 32, "per_device_eval_batch_size": 32, "learning_rate": 5e-05, "warmup_steps": 500, "logging_steps": 100, "eval_steps": 500, "save_total_limit": 1,
    "gradient_accumulation_steps": 1, "bf16": True, "dataloader_num_workers": 4, "remove_unused_columns": False, "load_best_model_at_end": True, "metric_for_best_model": "bleu", "greater_is_better": True,
}
GENERATION = {"num_beams": 5, "max_length": 256, "early_stopping": True}
OPTIMIZATION = {"gradient_checkpointing": True, "optim": "adamw_torch_fused"}


def run_config(threshold: float, base: str = ".", max_steps: int = 5000, model: str = "facebook/nllb-200-distilled-600M") -> dict:
    """Settings of a training run on the pairs above a threshold, as data for whatever trains."""
    label = int(threshold * 100)
    data = f"{base}/data/sweep/semantic_{label}"
    return {
        "model": {"name": model, "src_lang": "kor_Hang", "tgt_lang": "vie_Latn"},
        "data": {f"{s}_file": f"{data}/nllb_{s}.jsonl" for s in ("train", "dev", "test")} | LENGTHS,
        "training": {"output_dir": f"{base}/outputs/sweep/semantic_{label}", "num_train_epochs": 1, "max_steps": max_steps, "save_steps": max_steps, "log_dir": f"{base}/logs/sweep"} | TRAINING,
        "generation": GENERATION,
        "optimization": OPTIMIZATION,
    }


def write_config(config: dict, path: str) -> None:
    lines = []
    for section, values in config.items():
        lines.append(f"{section}:")
        lines += [f"  {k}: {str(v).lower() if isinstance(v, bool) else v}" for k, v in values.items()]
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text("\n".join(lines) + "\n", encoding="utf-8")
