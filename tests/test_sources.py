import json
import time

import pytest
from pyspark.sql import functions as F

from pairmill import cli
from pairmill.operators import semantic
from pairmill.sources import html, jsonl, results
from pairmill.streaming import filters

LINES = [
    {"translation": {"kor_Hang": "안녕하세요 여러분", "vie_Latn": "Xin chào các bạn"}, "extra": [1, 2]},
    {"translation": {"vie_Latn": "Cảm ơn rất nhiều", "kor_Hang": "정말 고맙습니다"}},
    {"other": 1},
    {"translation": {"kor_Hang": "한쪽만"}},
]


@pytest.fixture
def lines(tmp_path):
    p = tmp_path / "in.jsonl"
    p.write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in LINES) + "\n\n{broken\n", encoding="utf-8")
    return str(p)


def test_order_and_problems(spark, lines):
    rows = jsonl.read_lines(spark, lines).orderBy("ordinal").collect()
    assert [r.ordinal for r in rows] == list(range(5)) and rows[4].raw == "{broken"
    assert {(r.ordinal, r.problem) for r in jsonl.problems(jsonl.read_lines(spark, lines)).collect()} == {(2, "no_translation"), (3, "no_vie_Latn"), (4, "malformed")}
    assert jsonl.problems(jsonl.read_lines(spark, lines), first=2).isEmpty()
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.read_strict(spark, lines).collect()


def test_many_files_keep_their_order(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"part-{i}.txt").write_text("".join(f"line {i} {k}\n" for k in range(20 + i)))
    rows = jsonl.read_lines(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [r.raw for r in rows] == [f"line {i} {k}" for i in range(5) for k in range(20 + i)]


def test_key_and_position(spark, lines):
    rows = jsonl.read_lines(spark, lines)
    by_key = {r.pair_id: (r.src, r.tgt) for r in jsonl.pairs(rows).collect()}
    by_place = {r.pair_id: (r.src, r.tgt) for r in jsonl.pairs(rows, by_position=True).collect()}
    assert by_key[1] == ("정말 고맙습니다", "Cảm ơn rất nhiều") and by_place[1] == by_key[1][::-1] and by_key[4] == (None, None) == by_place[4]


def test_parallel_text_stops_at_the_shorter(spark, tmp_path):
    (tmp_path / "a.txt").write_text(" 하나 \n둘\n\n넷\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("một\nhai \nba\n", encoding="utf-8")
    rows = jsonl.read_parallel(spark, str(tmp_path / "a.txt"), str(tmp_path / "b.txt")).orderBy("ordinal").collect()
    assert [(r.src, r.tgt) for r in rows] == [("하나", "một"), ("둘", "hai"), ("", "ba")]


def test_writing_keeps_fields(spark, lines, tmp_path):
    rows = jsonl.pairs(jsonl.read_lines(spark, lines)).where("tgt is not null")
    jsonl.write_lines(rows, str(tmp_path / "out"), order="pair_id", one_file=True)
    again = jsonl.read_lines(spark, str(tmp_path / "out")).orderBy("ordinal").collect()
    assert [json.loads(r.raw) for r in again] == LINES[:2]
    line = rows.select(jsonl.as_line(F.col("src"), F.col("tgt"))).first()[0]
    assert "안녕" in line or "정말" in line


def test_results_and_summary(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text(json.dumps({"model": "m", "test_size": 3, "metrics": {"bleu": {"score": 20.5, "precisions": [50.0]}, "ter": 60.1}, "samples": [{"source": "가", "reference": "a", "prediction": "b"}]}, indent=1))
    r = results.read_results(spark, str(p)).first()
    assert r.metrics.bleu.score == 20.5 and r.metrics.comet is None and r.samples[0].source == "가"
    stats = semantic.sweep_stats(spark.createDataFrame([(0.7,), (0.9,)], "similarity double"))
    out = results.write_summary(stats, str(tmp_path / "s" / "sweep.json"), key="threshold")
    assert out["0.65"]["output"] == 2 and json.loads((tmp_path / "s" / "sweep.json").read_text()) == out


def test_config_round_trip(tmp_path):
    c = results.run_config(0.57, "/base")
    assert c["data"]["train_file"].endswith("semantic_56/nllb_train.jsonl")
    results.write_config(c, str(tmp_path / "c.yaml"))
    assert results._plain_yaml((tmp_path / "c.yaml").read_text()) == c


def test_html_is_escaped(spark, tmp_path):
    rows = spark.createDataFrame([(1, "<b>가</b> 1", "x & y"), (2, None, "")], "pair_id int, src string, tgt string")
    assert html.review_page(rows, str(tmp_path / "r.html")) == 2
    page = (tmp_path / "r.html").read_text()
    assert "&lt;b&gt;가" in page and "x &amp; y" in page and "words 2 / 3, ratio 1.50" in page
    ranked = rows.withColumn("threshold", F.lit(0.7)).withColumn("rank", F.col("pair_id"))
    assert html.threshold_page(ranked, str(tmp_path / "t.html"), shown=1) == 1


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text(json.dumps(LINES[0], ensure_ascii=False) + "\n" + json.dumps({"translation": {"kor_Hang": "a", "vie_Latn": "b"}}) + "\n")
    q = filters.write_passed(filters.read_pairs(spark, str(src)), str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()] == LINES[:1]


def test_window_counts(spark, tmp_path):
    src = tmp_path / "ev"
    spark.createDataFrame([("2025-01-01 00:00:01", "abcd", "abcd"), ("2025-01-01 00:01:00", "a", "b")], "ts string, src string, tgt string").select(F.col("ts").cast("timestamp"), "src", "tgt").write.parquet(str(src))
    stream = spark.readStream.schema("ts timestamp, src string, tgt string").parquet(str(src))
    q = filters.reasons_by_window(stream, "ts").writeStream.format("memory").queryName("reasons").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    time.sleep(0.1)
    assert sum(r["count"] for r in spark.table("reasons").collect()) == 2


def test_command_line(spark, lines, tmp_path, capsys):
    cli.main(["filter", "--input", lines, "--output", str(tmp_path / "kept")])
    assert spark.read.text(str(tmp_path / "kept")).count() == 2 and "passed" in capsys.readouterr().out
    cli.main(["filter", "--input", lines, "--mode", "sweep", "--output-dir", str(tmp_path / "sweep"), "--thresholds", "0.0", "0.99"])
    assert json.loads((tmp_path / "sweep" / "sweep_summary.json").read_text())["0.99"]["input"] == 5
    cli.main(["split", "--input", lines, "--output", str(tmp_path / "split")])
    assert spark.read.text(str(tmp_path / "split")).count() == 5
    cli.main(["review", "--input", lines, "--output", str(tmp_path / "r.html")])
    cli.main(["dedup", "--input", lines, "--output", str(tmp_path / "dd")])
    assert (tmp_path / "r.html").exists() and spark.read.text(str(tmp_path / "dd")).count() == 3


def test_semantic_filter_needs_similarities(spark, tmp_path):
    lines = tmp_path / "pairs.jsonl"
    lines.write_text("\n".join('{"translation": {"kor_Hang": "가 %d", "vie_Latn": "a %d"}, "sim": %s}' % (i, i, s) for i, s in enumerate((0.9, 0.5, 0.7, "null"))))
    out = str(tmp_path / "out")
    with pytest.raises(SystemExit):
        cli.main(["filter", "--input", str(lines), "--mode", "semantic", "--output", out])
    cli.main(["filter", "--input", str(lines), "--mode", "semantic", "--similarity", "sim", "--threshold", "0.7", "--output", out])
    assert [r.value[-5:] for r in spark.read.text(out).orderBy("value").collect()] == [" 0.9}", " 0.7}"]
    cli.main(["filter", "--input", str(lines), "--mode", "semantic", "--provider", "pairmill.operators.providers:hashed_vectors", "--threshold", "0", "--output", out])
    assert spark.read.text(out).count() == 4


def test_check_config_and_best(spark, tmp_path, capsys):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text('{"translation": {"kor_Hang": "가", "vie_Latn": "a"}}\n')
    bad.write_text('{"translation": {"kor_Hang": "가"}}\n{broken\n{}\n')
    cli.main(["check", "--input", str(good)])
    with pytest.raises(SystemExit):
        cli.main(["check", "--input", str(bad)])
    out = capsys.readouterr().out
    assert "every line holds a pair" in out and "malformed: 1 lines, the first is 1" in out and "no_vie_Latn: 1 lines, the first is 0" in out and "no_translation: 1" in out
    cli.main(["config", "--output-dir", str(tmp_path / "c"), "--thresholds", "0.65", "0.8", "--max-steps", "7"])
    c = results.load_config(str(tmp_path / "c" / "sweep_config_80.yaml"))
    assert c["training"]["save_steps"] == c["training"]["max_steps"] == 7 and c["optimization"]["gradient_checkpointing"] is True and sum(map(len, c.values())) == 33
    for t, bleu in ((65, 20.0), (80, 24.5)):
        (tmp_path / f"r{t}.json").write_text(json.dumps({"model": "m", "test_file": f"data/semantic_{t}/test.jsonl", "test_size": 3, "metrics": {"bleu": {"score": bleu, "precisions": []}}}))
    cli.main(["best", "--results", str(tmp_path / "r*.json"), "--output", str(tmp_path / "best.json")])
    found = json.loads((tmp_path / "best.json").read_text())
    assert found["best_threshold"] == 0.8 and found["best_bleu"] == 24.5 and set(found["results"]) == {"0.65", "0.8"}


def test_review_of_thresholds_and_inference(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for t, n in ((65, 6), (80, 2)):
        (tmp_path / "f" / f"semantic_{t}.jsonl").write_text("\n".join(json.dumps({"translation": {"kor_Hang": f"가 {i}", "vie_Latn": f"câu {t} {i}"}}) for i in range(n)))
    cli.main(["review", "--compare", "--filtered-dir", str(tmp_path / "f"), "--thresholds", "0.65", "0.7", "0.8", "--shown", "4", "--output", str(tmp_path / "t.html")])
    page = (tmp_path / "t.html").read_text()
    assert "Threshold 0.65 (4)" in page and "Threshold 0.80 (2)" in page and "0.70" not in page
    with pytest.raises(SystemExit):
        cli.main(["review", "--compare", "--filtered-dir", str(tmp_path / "none"), "--output", str(tmp_path / "t.html")])
    cli.main(["infer", "--input", str(tmp_path / "f" / "semantic_65.jsonl"), "--provider", "pairmill.operators.providers:echo_loader", "--model", "a/b/", "--num-examples", "2", "--output", str(tmp_path / "i.json")])
    r = results.read_results(spark, str(tmp_path / "i.json")).first()
    assert r.model == "a/b/" and r.test_size == 6 and len(r.samples) == 2 and r.samples[0].prediction == r.samples[0].source and r.metrics.bleu.score is not None
    assert results.default_name("a/b/") == "inference_b.json"
