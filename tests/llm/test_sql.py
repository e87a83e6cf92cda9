"""Queries of the subpackage that have SQL, on the smallest test data and on a table of edge cases."""

import os

import pytest

from pairmill.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, name, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    spark.createDataFrame([(i, t) for i, t in enumerate([None, "", "{", "[]", "3", '{"translation": 3}', '{"translation": {"kor_Hang": "A b", "vie_Latn": "x."}}', '{"translation": {"vie_Latn": "«X»", "kor_Hang": "a\\u3000B!"}, "z": 1}', '{"translation": {"kor_Hang": 1, "vie_Latn": "x"}}', '{"translation": {"kor_Hang": "!", "vie_Latn": "x"}}'])], "line_id bigint, line string").coalesce(1).write.parquet(f"{tmp_path}/raw_lines.parquet")
    spark.createDataFrame([(1, "a b c d e " * 3, "vi"), (2, "a b c d e f", "vi"), (3, "", "vi"), (4, None, "ko"), (5, "东 西 南 北 中 " * 3, "zh"), (6, "A, b! c d e x y A B C D E", None)], "doc_id bigint, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for sf in [str(tmp_path)] + [SF] * os.path.isdir(SF):
        c = duckdb.connect()
        for t in ("raw_lines", "documents"):
            path = f"{sf}/{t}.parquet"
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
        r = c.execute(catalog.ORACLES[name])
        columns = [d[0] for d in r.description]
        want = sorted(map(repr, r.fetchall()))
        df = catalog.QUERIES[name](spark, sf)
        assert sorted(df.columns) == sorted(columns)
        assert sorted(repr(tuple(row[x] for x in columns)) for row in df.collect()) == want and want
