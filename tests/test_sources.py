"""Readers, writers and streams on small files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from frameloom.operators import series
from frameloom.sources import readers, writers
from frameloom.streaming import sessions


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def test_parquet_files(spark, tmp_path):
    for i in range(3):
        spark.range(i + 1).coalesce(1).write.parquet(f"{tmp_path}/d/{i}")
    got = readers.parquet_files(spark, f"{tmp_path}/d").collect()
    assert [r.n_rows for r in got] == [1, 2, 3] and [r.path for r in got] == sorted(r.path for r in got)
    os.mkdir(tmp_path / "none")
    with pytest.raises(readers.SourceError):
        readers.parquet_files(spark, f"{tmp_path}/none")


def test_manifest(spark, tmp_path):
    p = put(tmp_path / "m.json", json.dumps([{"path": "a.mp4", "cap": ["x", "y"], "fps": 24, "resolution": {"width": 8, "height": 4}}, {"path": "b.mp4", "cap": "z", "action_path": "b.npy"}]))
    a, b = readers.manifest(spark, "/v/", p).orderBy("path").collect()
    assert (a.path, a.cap, a.resolution.width, a.action_path) == ("/v/a.mp4", ["x", "y"], 8, None)
    assert (b.cap, b.action_path) == (["z"], "/v/b.npy")
    assert readers.manifest_of_manifests(spark, put(tmp_path / "l.txt", "/v, m.json\n\n")) == ("/v", "m.json")
    with pytest.raises(readers.SourceError):
        readers.manifest_of_manifests(spark, put(tmp_path / "l2.txt", "a,b\nc,d\n"))
    put(tmp_path / "s/videos2caption.json", json.dumps([{"path": "a.mp4", "cap": ["x"]}]))
    r = readers.merged_captions(spark, f"{tmp_path}/s").first()
    assert (r["name"], r.video, r.caption) == ("a.mp4", f"{tmp_path}/s/videos/a.mp4", ["x"])


def test_text_and_prompts(spark, tmp_path):
    p = put(tmp_path / "t.txt", "  one \n\n two\r\n   \nthree")
    assert [tuple(r) for r in readers.text_lines(spark, p).orderBy("idx").collect()] == [(0, "text_0", "one"), (1, "text_1", "two"), (2, "text_2", "three")]
    j = put(tmp_path / "p.jsonl", '"a"\n{"prompt": "b"}\n{"text_prompt": "c"}\n')
    k = put(tmp_path / "p.json", '["a", {"prompt": "b"}]')
    assert [r.prompt for r in readers.prompts(spark, j).orderBy("idx").collect()] == ["a", "b", "c"]
    assert [r.prompt for r in readers.prompts(spark, k).orderBy("idx").collect()] == ["a", "b"]
    assert [r.prompt for r in readers.requests(readers.prompts(spark, k), 5).orderBy("idx").collect()] == ["a", "b", "a", "b", "a"]


def test_by_suffix(spark, tmp_path):
    import pyarrow as pa

    c = put(tmp_path / "x.csv", 'caption,n\n"a, ""b""",1\n')
    assert readers.by_suffix(spark, c).first().caption == 'a, "b"'
    assert readers.by_suffix(spark, put(tmp_path / "x.json", '{"data": [{"caption": "q"}]}')).first().caption == "q"
    t = pa.table({"caption": ["z"]})
    with pa.OSFile(f"{tmp_path}/x.arrow", "wb") as f, pa.ipc.new_file(f, t.schema) as w:
        w.write_table(t)
    assert readers.by_suffix(spark, f"{tmp_path}/x.arrow").first().caption == "z"
    with pytest.raises(readers.SourceError):
        readers.by_suffix(spark, "x.txt")


def test_tensor_directories(spark, tmp_path):
    a = put(tmp_path / "a.json", '[{"file": "1.bin", "length": 3}, {"file": "2.bin"}]')
    put(tmp_path / "t/1.bin", "xx")
    got = {r.file: (r.length, r.content and bytes(r.content)) for r in readers.annotated_tensors(spark, a, f"{tmp_path}/t").collect()}
    assert got == {"1.bin": (3, b"xx"), "2.bin": (1, None)}
    for f in ("l/latent_1.pt", "l/latent_2.pt", "c/condition_1.pt"):
        put(tmp_path / f, "x")
    assert [r.key for r in readers.parallel_directories(spark, {"latents": f"{tmp_path}/l", "conditions": f"{tmp_path}/c"}).collect()] == ["1.pt"]


def test_run_records_and_results(spark, tmp_path):
    put(tmp_path / "r/m/a.json", '{"model_id": "a", "timestamp": "2025-01-02T00:00:00", "latency": 2}')
    put(tmp_path / "r/m/b.json", '{"model_id": "b", "timestamp": "nope"}')
    put(tmp_path / "r/n/c.json", "{broken")
    got = readers.run_records(spark, f"{tmp_path}/r").collect()
    assert [r.model_id for r in got] == ["b", "a"] and got[0].ts is None and not got[0].has_success
    put(tmp_path / "r/perf_2.json", "{}")
    put(tmp_path / "r/perf_1.json", "{}")
    assert [r.path[-6:] for r in readers.current_results(spark, f"{tmp_path}/r").collect()] == ["1.json", "2.json"]


def test_corpus_paths_and_captions(spark, tmp_path):
    p = put(tmp_path / "b.json", json.dumps([{"prompt_en": "a", "dimension": ["color", "scene"], "auxiliary_info": {"x": {"k": "1"}, "y": {"k": "2", "j": "3"}}}, {"prompt_en": "b", "dimension": ["style"]}]))
    r = readers.corpus(spark, p, ["scene"]).collect()
    assert len(r) == 1 and r[0].info == {"k": "2", "j": "3"}
    for f in ("v/b.mp4", "v/a.mp4", "v/c.txt"):
        put(tmp_path / f, "x")
    got = readers.expand_paths(spark, [f"{tmp_path}/v/b.mp4", f"{tmp_path}/v", f"{tmp_path}/v/*.mp4"], ["mp4"])
    assert [x.rsplit("/", 1)[-1] for x in got] == ["b.mp4", "a.mp4"]
    assert readers.captions_json(spark, put(tmp_path / "c.json", '{"a.mp4": "x"}')).first().caption == "x"
    assert readers.captions_json(spark, put(tmp_path / "d.json", '[{"file_name": "a.mp4", "caption": "y"}]')).first().caption == "y"
    known = spark.createDataFrame([("a",)], "file_name string")
    with pytest.raises(readers.SourceError):
        readers.caption_import(spark.createDataFrame([("b", "c")], "file_name string, caption string"), known)
    t = readers.takes(spark.createDataFrame([("0001_perspective-left_take-2_trimmed-ball.mp4",), ("x",)], "scenario string")).collect()
    assert (t[0].view, t[0].take, t[0].subject) == ("left", 2, "ball") and t[1].take is None


def test_fixed_row_files(spark, tmp_path):
    rest = writers.fixed_rows(spark.range(25), f"{tmp_path}/w", ["id"], 10, workers=2, remainder=False)
    assert rest.count() == 5
    counts = spark.read.parquet(f"{tmp_path}/w").groupBy("chunk").count().collect()
    assert sorted((r.chunk, r["count"]) for r in counts) == [(0, 10), (1, 10)]
    writers.fixed_rows(rest, f"{tmp_path}/w", ["id"], 10, workers=2, first=2)
    assert spark.read.parquet(f"{tmp_path}/w").select("id").distinct().count() == 25


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([("m/x", "a" * 20, 1.0), ("m/x", "b" * 20, None)], "model_id string, commit_sha string, latency double").withColumn("ts", F.lit("2025-01-01").cast("timestamp"))
    doc = writers.run_records(df, f"{tmp_path}/runs")
    assert sorted(r.path for r in doc.collect())[0] == "m_x/20250101T000000_aaaaaaaaaaaa.json"
    assert writers.seed_checks(doc, "path", "value").first().asDict() == {"n": 2, "n_keys": 2, "n_contents": 2}
    assert writers.validation_list(df, 1, 3, "commit_sha", ["model_id", "latency"]).count() == 1
    writers.by_split(df.withColumn("split", F.lit("train")), f"{tmp_path}/s")
    writers.payload_tables(df, f"{tmp_path}/p", "commit_sha", ["latency"])
    writers.fan_out(df, [lambda x: writers.json_lines(x, f"{tmp_path}/j"), lambda x: writers.json_lines(x, f"{tmp_path}/j")])
    assert spark.read.json(f"{tmp_path}/j").count() == 4 and spark.read.parquet(f"{tmp_path}/p/latency").count() == 1


def _drain(q):
    q.processAllAvailable()
    q.stop()


def test_stream_of_buckets_equals_the_batch(spark, tmp_path):
    lines = "\n".join(json.dumps({"session_id": f"s{i % 3}", "event": "chunk", "ts": 1700000000 + i / 4, "payload": {"bytes": str(i)}}) for i in range(40))
    put(tmp_path / "log/a.jsonl", lines)
    stream = readers.events(spark, f"{tmp_path}/log", streaming=True).withColumn("size", F.col("payload")["bytes"].cast("bigint"))
    _drain(sessions.throughput(stream, "at", "size").writeStream.outputMode("complete").format("memory").queryName("buckets").trigger(availableNow=True).start())
    batch = series.buckets(readers.events(spark, f"{tmp_path}/log").withColumn("size", F.col("payload")["bytes"].cast("bigint")), "at", "size")
    assert sorted(spark.table("buckets").collect()) == sorted(batch.collect()) and batch.count() == 10


def test_stream_of_health_equals_the_batch(spark, tmp_path):
    ok = [1, 0, 0, 0, 1, 0, 1, 1, 0, 0, 1, 0, 0, 0, 0]
    put(tmp_path / "h/a.json", "\n".join(json.dumps({"replica": "r", "seq": i, "ok": bool(o)}) for i, o in enumerate(ok)))
    s = spark.readStream.schema("replica string, seq bigint, ok boolean").json(f"{tmp_path}/h")
    _drain(sessions.health(s).writeStream.outputMode("update").format("memory").queryName("health").trigger(availableNow=True).start())
    rows = series.health(spark.read.schema("replica string, seq bigint, ok boolean").json(f"{tmp_path}/h"), ["replica"], ["seq"], F.col("ok")).orderBy("seq").collect()
    assert [r.state[:2] for r in rows] == ["he", "he", "he", "un", "un", "un", "un", "he", "he", "he", "he", "he", "he", "un", "un"]
    last = spark.table("health").first()
    assert (last.state, last.run, last.seen) == (rows[-1].state, rows[-1].run, 15)


def test_repeated_batch_is_stored_once(spark, tmp_path):
    for _ in range(2):
        sessions.append_once(spark.range(3), 7, f"{tmp_path}/o")
    assert spark.read.parquet(f"{tmp_path}/o").count() == 3
