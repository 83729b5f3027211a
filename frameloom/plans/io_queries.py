"""Queries of readers, writers and streams: what is written is read again, streams run to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom import schemas
from frameloom.functions import canonical
from frameloom.operators import series
from frameloom.plans.tables import table
from frameloom.session import scratch_dir
from frameloom.sources import readers, writers
from frameloom.streaming import sessions

TABLES = "region nation customer supplier part orders lineitem events".split()


def source_row_counts(spark: SparkSession, d: str) -> DataFrame:
    f = readers.parquet_files(spark, d).withColumn("name", F.regexp_extract("path", r"/(\w+)\.parquet", 1))
    return f.where(F.col("name").isin(TABLES)).groupBy("name").agg(F.sum("n_rows").alias("n"))


def source_fixed_schema(spark: SparkSession, d: str) -> DataFrame:
    s = readers.samples(spark, f"{d}/t2v_samples.parquet")
    return s.where("num_frames > 100").select("id", "file_name", "num_frames").withColumn("tensors", F.lit(",".join(schemas.tensor_names(s.schema))))


def source_json_manifest(spark: SparkSession, d: str) -> DataFrame:
    """A manifest written from samples and read back with its folder put before each path."""
    out = scratch_dir(spark, "manifest")
    t = table(spark, d, "t2v_samples").where("file_name IS NOT NULL").select(F.col("file_name").alias("path"), F.when(F.col("sample_no") % 2 == 0, F.to_json(F.array("caption"))).otherwise(F.col("caption")).alias("cap"), F.struct("width", "height").alias("resolution"), "num_frames")
    t.where("caption IS NOT NULL AND NOT startswith(caption, '[')").write.json(out)
    return readers.manifest(spark, "/videos", out, lines=True).select("path", F.size("cap").alias("n_caps"), F.col("resolution.width").alias("width"), "num_frames")


def source_prompt_lines(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_dir(spark, "lines")
    table(spark, d, "story_presets").select(F.col("label").alias("value")).coalesce(1).write.text(out)
    return readers.text_lines(spark, out).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def source_csv(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_dir(spark, "csv") + ".csv"
    table(spark, d, "customer").write.option("header", True).option("escape", '"').csv(out)
    return readers.by_suffix(spark, out).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name")


def source_requests(spark: SparkSession, d: str) -> DataFrame:
    """Five hundred requests from sixty names: the list repeated in order."""
    from frameloom.operators.shards import positions

    return readers.requests(positions(table(spark, d, "datasets").select("id"), ["id"]), 500)


def caption_import_check(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "t2v_samples").select("file_name")
    c = table(spark, d, "dataset_captions").select("caption_id", "file_name").join(t.distinct(), "file_name", "left_semi")
    return readers.caption_import(c, t).select("caption_id")


def scenario_parts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.format_string("%04d_perspective-%s_take-%d_trimmed-ball%d.mp4", "p_partkey", F.when(F.col("p_partkey") % 2 == 0, "left").otherwise("center"), F.col("p_partkey") % 2 + 1, "p_size").alias("scenario"))
    return readers.takes(p).select("p_partkey", "view", "take", "subject")


def sink_fixed_rows(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_dir(spark, "chunks")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    writers.fixed_rows(rows, out, ["l_orderkey", "l_linenumber", "l_quantity"], 1000, workers=3)
    return spark.read.parquet(out).groupBy("worker", "chunk").agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first_key"))


def sink_by_split(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_dir(spark, "splits")
    writers.by_split(table(spark, d, "prompt_splits").select("row_id", "split"), out)
    return spark.read.parquet(out).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def sink_payloads(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_dir(spark, "payloads")
    writers.payload_tables(table(spark, d, "t2v_samples"), out, "sample_no", ["vae_latent_bytes", "text_embedding_bytes"])
    return spark.read.parquet(f"{out}/vae_latent_bytes").join(spark.read.parquet(f"{out}/text_embedding_bytes").withColumnRenamed("content", "t"), "sample_no").select("sample_no", F.octet_length("content").alias("a"), F.octet_length("t").alias("b"))


def sink_json_results(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_dir(spark, "results")
    writers.json_lines(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), out)
    return spark.read.schema("o_orderkey bigint, o_totalprice double").json(out)


def sink_validation_list(spark: SparkSession, d: str) -> DataFrame:
    return writers.validation_list(table(spark, d, "prompt_splits"), 64, 1, "row_id", ["row_id", "caption", "num_frames"])


def seed_manifest_checks(spark: SparkSession, d: str) -> DataFrame:
    return writers.seed_checks(table(spark, d, "dataset_captions"), "file_name", "caption")


def text_digests(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prompt_splits").select("row_id", F.sha2("caption", 256).alias("sha256"), F.sha1("caption").alias("sha1"))


def document_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Events' properties by canonical JSON: equal documents share a fingerprint."""
    e = table(spark, d, "events")
    return e.groupBy(canonical.fingerprint(F.col("props"), (), 16).alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("props").alias("n_texts"))


def sanitize_names(spark: SparkSession, d: str) -> DataFrame:
    from frameloom.operators.runs import safe_name

    p = table(spark, d, "part")
    return p.select("p_partkey", safe_name(F.col("p_type")).alias("name"), canonical.major_minor(F.concat("p_size", F.lit("."), F.col("p_partkey").cast("string"), F.lit(".7+x"))).alias("version"), canonical.folded_path(F.concat("p_name", F.lit("/a//b/"))).alias("folded"), canonical.short_display(F.col("p_type")).alias("short"))


def _stream(spark, d):
    e = table(spark, d, "events")
    return spark.readStream.schema(e.schema).option("pathGlobFilter", "events*.parquet").parquet(d).withColumn("at", F.col("ts").cast("timestamp"))


def _finish(spark: SparkSession, df: DataFrame, mode: str, name: str) -> DataFrame:
    """The stream's last result table: a stream over what is there, its batches stored by number."""
    out, at = scratch_dir(spark, name), scratch_dir(spark, f"{name}-checkpoint")
    last = {}

    def store(batch: DataFrame, n: int) -> None:
        sessions.append_once(batch, n, out)
        last["n"] = n

    q = df.writeStream.outputMode(mode).option("checkpointLocation", at).trigger(availableNow=True).foreachBatch(store).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/batch={last.get('n', 0)}")


def stream_bucket_throughput(spark: SparkSession, d: str) -> DataFrame:
    return _finish(spark, sessions.throughput(_stream(spark, d), "at", "value"), "complete", "buckets").select(F.col("start").cast("timestamp_ntz").alias("start"), "bytes", "mbps")


def stream_event_counts(spark: SparkSession, d: str) -> DataFrame:
    c = sessions.event_counts(_stream(spark, d), "at", ["event_type"], "1 hour")
    return _finish(spark, c, "complete", "counts").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def stream_replica_health(spark: SparkSession, d: str) -> DataFrame:
    """Health per user after the whole log: the stateful stream gives what the batch windows give."""
    checks = _stream(spark, d).select(F.col("user_id").cast("string").alias("replica"), (F.unix_micros("at") * 16 + F.pmod("event_id", F.lit(16))).alias("seq"), F.col("event_type").isin("click", "view").alias("ok"))
    return _finish(spark, sessions.health(checks), "update", "health").select("replica", "state", "run", "seen")


QUERIES = {f.__name__: f for f in (
    source_row_counts, source_fixed_schema, source_json_manifest, source_prompt_lines, source_csv, source_requests, caption_import_check, scenario_parts, sink_fixed_rows, sink_by_split, sink_payloads,
    sink_json_results, sink_validation_list, seed_manifest_checks, text_digests, document_fingerprints, sanitize_names, stream_bucket_throughput, stream_event_counts, stream_replica_health,
)}
_SAFE = "regexp_replace(p_type, '[^A-Za-z0-9._-]', '_', 'g')"
ORACLES = {
    "source_row_counts": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES),
    "source_fixed_schema": "SELECT id, file_name, num_frames, 'vae_latent,text_embedding' AS tensors FROM t2v_samples WHERE num_frames > 100",
    "source_json_manifest": "SELECT '/videos/' || file_name AS path, 1 AS n_caps, width, num_frames FROM t2v_samples WHERE file_name IS NOT NULL AND caption IS NOT NULL AND NOT starts_with(caption, '[')",
    "source_prompt_lines": "SELECT trim(label) AS text, count(*) AS n FROM story_presets WHERE trim(label) <> '' GROUP BY 1",
    "source_csv": "SELECT c_custkey, c_name FROM customer",
    "source_requests": "SELECT id, i + 60 * k AS idx FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS i FROM datasets), unnest(range(9)) AS u(k) WHERE i + 60 * k < 500",
    "caption_import_check": "SELECT caption_id FROM dataset_captions c WHERE EXISTS (SELECT 1 FROM t2v_samples t WHERE t.file_name = c.file_name)",
    "scenario_parts": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'left' ELSE 'center' END AS view, CAST(p_partkey % 2 + 1 AS INTEGER) AS take, 'ball' || p_size AS subject FROM part",
    "sink_fixed_rows": "SELECT chunk % 3 AS worker, chunk, count(*) AS n, min(l_orderkey) AS first_key FROM (SELECT l_orderkey, (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_quantity) - 1) // 1000 AS chunk FROM lineitem) GROUP BY 1, 2",
    "sink_by_split": "SELECT split, count(*) AS n FROM prompt_splits GROUP BY 1",
    "sink_payloads": "SELECT sample_no, octet_length(vae_latent_bytes) AS a, octet_length(text_embedding_bytes) AS b FROM t2v_samples WHERE vae_latent_bytes IS NOT NULL AND text_embedding_bytes IS NOT NULL",
    "sink_json_results": "SELECT o_orderkey, o_totalprice FROM orders",
    "seed_manifest_checks": "SELECT count(*) AS n, count(DISTINCT file_name) AS n_keys, count(DISTINCT caption) AS n_contents FROM dataset_captions",
    "text_digests": "SELECT row_id, sha256(caption) AS sha256, sha1(caption) AS sha1 FROM prompt_splits",
    "sanitize_names": f"SELECT p_partkey, {_SAFE} AS name, p_size || '.' || p_partkey AS version, p_name || '_a_b' AS folded, CASE WHEN length(p_type) > 14 THEN substr(p_type, 1, 12) || '..' ELSE p_type END AS short FROM part",
    "stream_bucket_throughput": "SELECT date_trunc('second', ts) AS start, sum(value) AS bytes, sum(value) * 8 / 1e6 AS mbps FROM events WHERE value > 0 GROUP BY 1",
    "stream_event_counts": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
