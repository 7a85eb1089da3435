import json

import pytest
from pyspark.sql import functions as F

from tamiz.sources import files
from tamiz.streaming.incremental import resumable, upsert_by_source, windowed_counts


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "a.jsonl")
    with open(path, "w") as f:
        f.write('{"chunk_id": "a", "n": 1}\n\n{"chunk_id": "b", "n"\n{"chunk_id": " "}\n{"chunk_id": "a"}\n')
    assert files.read_jsonl(spark, path, "chunk_id string, n int", tolerant=True).count() == 3
    assert [r[0] for r in files.processed_ids(spark, path).collect()] == ["a"]
    with pytest.raises(Exception):
        files.read_jsonl(spark, path, "chunk_id string, n int").collect()
    assert files.read_jsonl(spark, str(tmp_path / "none"), "a int", optional=True).count() == 0
    assert files.write_jsonl(spark.range(5), str(tmp_path / "out")) == 5
    assert files.write_jsonl(spark.range(5, 7), str(tmp_path / "out"), "append") == 2 and spark.read.json(str(tmp_path / "out")).count() == 7


def test_documents_and_reports(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"a": 1}, indent=2))
    assert files.read_json(spark, str(tmp_path / "r.json"), "a int").head()["a"] == 1 and files.read_json(spark, str(tmp_path / "x.json"), "a int").count() == 0
    (tmp_path / "d").mkdir()
    (tmp_path / "d/x.pdf").write_bytes(b"123")
    (tmp_path / "d/x.txt").write_bytes(b"1")
    (tmp_path / "d/p.html").write_text("<p>hola</p>")
    row = files.discover(spark, str(tmp_path / "d")).collect()
    assert [(r["source_pdf"], r["file_size"]) for r in row] == [("x.pdf", 3)]
    assert files.read_html(spark, str(tmp_path / "d")).head()["text"] == "hola" and files.read_binary(spark, str(tmp_path / "d")).count() == 1
    assert files.markdown([{"a": 1.5, "b": None}], ["a", "b"]) == "| a | b |\n| --- | --- |\n| 1.5000 |  |\n"


def test_stream_replaces_sources_and_resumes(spark, tmp_path):
    src, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "i long, s string"
    put = lambda rows, name: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/{name}")
    run = lambda: upsert_by_source(spark, src, schema, target, state, "s").awaitTermination()
    put([(1, "a"), (2, "b"), (3, None)], "x1")
    run()
    put([(9, "a")], "x2")
    run()
    run()
    assert sorted((r["i"], r["s"]) for r in spark.read.schema(schema).parquet(target).collect() if r["s"]) == [(2, "b"), (9, "a")]

    done, seen = str(tmp_path / "done"), str(tmp_path / "seen")
    again = lambda: resumable(spark, src, schema, done, seen, "i", lambda df: df.select("i", F.lit("ok").alias("status"))).awaitTermination()
    again()
    put([(9, "a"), (10, "c")], "x3")
    again()
    assert sorted(r["i"] for r in spark.read.parquet(done).collect()) == [1, 2, 3, 9, 10]


def test_splits_and_windows(spark, tmp_path):
    path = str(tmp_path / "s")
    files.write_splits(spark.createDataFrame([(1, "train"), (2, "test")], "i int, split string"), path)
    files.write_splits(spark.createDataFrame([(3, "test")], "i int, split string"), path)
    assert sorted((r["i"], r["split"]) for r in spark.read.parquet(path).collect()) == [(1, "train"), (3, "test")]
    events = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:10:00", "a", 4.0)], "ts string, k string, value double").withColumn("ts", F.to_timestamp("ts"))
    assert sorted((r["n"], r["total"]) for r in windowed_counts(events, "ts", "k").collect()) == [(1, 4.0), (2, 3.0)]
