"""Queries of the run-metric analytics.

RUNS derives run records from the events table in SQL that both engines read,
so a query and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.operators import runs
from frameloom.plans.tables import table

COHORT = ["user_id", "event_type"]
ORDER = ["ts", "event_id"]

RUNS = """SELECT event_id, ts, 'model_' || CAST(user_id % 5 AS STRING) AS model_id,
  CASE user_id % 3 WHEN 0 THEN 'NVIDIA L40S' WHEN 1 THEN 'NVIDIA H100' ELSE 'B200' END AS gpu_type,
  CASE WHEN event_id % 11 = 0 THEN ' ' ELSE event_type END AS workload_id, 'v' || CAST(user_id % 2 AS STRING) AS variant_id, user_id % 2 AS benchmark_version,
  CASE WHEN user_id % 7 = 0 THEN 'r' || CAST(event_id % 3 AS STRING) ELSE 'r0' END AS recipe_fingerprint, 'hw' AS hardware_profile_id, 'sw' AS software_profile_id,
  CASE WHEN event_id % 4 = 0 THEN 'pr' WHEN event_id % 4 = 1 THEN ' Local ' WHEN event_id % 4 = 2 THEN 'scheduled_main' ELSE 'other' END AS run_source,
  event_type <> 'error' AS success, event_id % 5 <> 0 AS has_success, event_id % 3 = 0 AS has_baseline_eligible,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 2 = 1 END AS baseline_eligible, event_id % 3 = 1 AS has_run_source,
  value AS latency, CASE WHEN value > 0 THEN 1000 / value END AS throughput, value * 20 AS memory,
  CASE WHEN event_id % 9 <> 0 THEN value / 4 END AS text_encoder_time_s, value / 2 AS dit_time_s, CAST(NULL AS DOUBLE) AS vae_decode_time_s,
  lpad(CAST(event_id * 7919 AS STRING), 14, 'a') AS commit_sha FROM events"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("frameloom_events")
    df = spark.sql(RUNS.replace("FROM events", "FROM frameloom_events"))
    df = runs.cohort_key(df)
    return df.withColumns({"ok": runs.succeeded(), "base": runs.eligible()})


_COHORT = "CASE WHEN " + " AND ".join(f"trim(CAST({c} AS STRING)) <> ''" for c in runs.IDENTITY) + " THEN concat_ws('|', 'v2', " + ", ".join(runs.IDENTITY) + ") ELSE concat_ws('|', 'legacy', model_id, gpu_type, " + ", ".join(runs.IDENTITY) + ") END"
_SOURCE = "CASE WHEN lower(trim(run_source)) IN ('pr', 'local', 'scheduled_main') THEN lower(trim(run_source)) ELSE 'unknown' END"
_OK = "CASE WHEN NOT has_success THEN true ELSE coalesce(success, false) END"
_BASE = f"CASE WHEN NOT has_baseline_eligible AND NOT has_run_source THEN true WHEN has_baseline_eligible THEN coalesce(baseline_eligible, false) ELSE {_SOURCE} = 'scheduled_main' END"
_R = f"(SELECT *, {_COHORT} AS cohort, {_SOURCE} AS src, {_OK} AS ok, {_BASE} AS base FROM ({RUNS}))"


def runs_latest_vs_baseline(spark: SparkSession, d: str) -> DataFrame:
    return runs.latest_vs_baseline(table(spark, d, "events"), COHORT, ORDER, "value")


def runs_summary(spark: SparkSession, d: str) -> DataFrame:
    return runs.summary(_runs(spark, d), ORDER)


def runs_latest_by_source(spark: SparkSession, d: str) -> DataFrame:
    return runs.summary(_runs(spark, d), ORDER, source="pr").select("cohort", "latest_run", "latest_ok", "baseline_n", "latency", "latency_base", "status")


def runs_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return runs.status_counts(runs_summary(spark, d))


def runs_ordered_status(spark: SparkSession, d: str) -> DataFrame:
    return runs.summary_order(runs_summary(spark, d)).select("cohort", "status")


def runs_worst_regression(spark: SparkSession, d: str) -> DataFrame:
    return runs_summary(spark, d).select("cohort", "worst_pct", "exceeded")


def runs_cohort_counts(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).groupBy("cohort").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_ok"), F.count_if("base").alias("n_base"))


def runs_trend_points(spark: SparkSession, d: str) -> DataFrame:
    return runs.trend_points(_runs(spark, d), ORDER, "text_encoder_time_s")


def runs_last_n(spark: SparkSession, d: str) -> DataFrame:
    return runs.last_n(_runs(spark, d).where("ok"), ["cohort"], ORDER, 3).select("cohort", "event_id", "latency")


def runs_recipe_mismatch(spark: SparkSession, d: str) -> DataFrame:
    r = _runs(spark, d)
    return runs.recipe_mismatch(r.where("event_id % 10 = 0").withColumn("recipe_fingerprint", F.concat("recipe_fingerprint", F.lit("x"))).unionByName(r.where("event_id % 10 = 5")), r.where("event_id % 10 > 5"), ["workload_id", "variant_id", "gpu_type"], "recipe_fingerprint", "event_id")


def runs_recipe_mismatch_all(spark: SparkSession, d: str) -> DataFrame:
    """Every run not of the scheduled main against every run of it, those of pull requests with a changed recipe; runs_recipe_mismatch has a part of the runs."""
    r = _runs(spark, d).withColumn("src", runs.normalize_source(F.col("run_source")))
    now = r.where("src <> 'scheduled_main'").withColumn("recipe_fingerprint", F.concat("recipe_fingerprint", F.when(F.col("src") == "pr", "x").otherwise("")))
    return runs.recipe_mismatch(now, r.where("src = 'scheduled_main'"), ["workload_id", "variant_id", "gpu_type"], "recipe_fingerprint", "event_id")


def runs_metric_coverage(spark: SparkSession, d: str) -> DataFrame:
    return runs.metric_coverage(_runs(spark, d), ["model_id", "gpu_type", "workload_id"], ["latency", "text_encoder_time_s", "vae_decode_time_s"])


def runs_median_by_cohort(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).groupBy("cohort").agg(F.median("text_encoder_time_s").alias("median"))


def runs_display_filter(spark: SparkSession, d: str) -> DataFrame:
    return runs.display_filter(_runs(spark, d), model="model_2", source="local", ok=True).select("event_id", "model_id", "gpu_type")


def runs_recent_eligible(spark: SparkSession, d: str) -> DataFrame:
    return runs.recent(_runs(spark, d), F.lit("2024-01-20").cast("timestamp_ntz")).where("ok AND base").select("event_id", "cohort")


def runs_same_identity(spark: SparkSession, d: str) -> DataFrame:
    return runs.same_identity(_runs(spark, d).withColumn("maybe", F.when(F.col("event_id") % 2 == 0, F.col("benchmark_version"))), {"maybe": None, "benchmark_version": 1}).select("event_id")


def runs_static_failures(spark: SparkSession, d: str) -> DataFrame:
    df = _runs(spark, d).withColumns({"max_latency": runs.threshold_block(F.col("gpu_type"), {"l40s": 300.0, "h100": 200.0}, 100.0), "max_memory": F.lit(9000.0)})
    return runs.static_failures(df, {"latency": "max_latency", "memory": "max_memory"}, "event_id")


def runs_overrides(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).when(F.col("event_id") % 3 == 1, F.lit("bad"))
    return table(spark, d, "events").select("event_id", runs.override(raw, 8.0).alias("percent"))


def runs_gate_status(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, d, "events").select(
        "event_id", runs.gate_status(k % 13 != 0, k % 7 == 0, k % 5 == 0, k % 11 != 0, k % 3, k % 2 == 0, F.col("value") > 100).alias("status")
    ).withColumn("upload", runs.upload_allowed("pass", F.col("status")))


def runs_source_detection(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    pr = F.when(k % 3 == 0, F.lit("false")).when(k % 3 == 1, k.cast("string"))
    return table(spark, d, "events").select("event_id", runs.detect_source(pr, F.when(k % 2 == 0, "main").otherwise("dev"), k % 5 == 0, k % 7 != 0).alias("source"))


def runs_seed_problems(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).select("event_id", runs.seed_problems(["latency", "throughput"], ["text_encoder_time_s", "vae_decode_time_s"]).alias("problems")).where("problems <> ''")


def runs_batch_consistency(spark: SparkSession, d: str) -> DataFrame:
    return runs.batch_consistency(_runs(spark, d), ["cohort"], "text_encoder_time_s")


def runs_repeated_provenance(spark: SparkSession, d: str) -> DataFrame:
    r = _runs(spark, d)
    return runs.repeated(r, [F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("job-"), (F.col("event_id") % 97).cast("string"))), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("build-"), (F.col("event_id") % 89).cast("string"))), F.col("commit_sha")])


def run_summaries(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return runs.run_summary(li.select("l_orderkey", "l_quantity", "l_extendedprice", F.when(F.col("l_orderkey") % 2 == 0, F.lit(45)).alias("frames")), ["l_orderkey"], "l_quantity", "l_extendedprice", "frames").drop("frames")


def stage_component_sum(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.create_map(F.col("event_type"), F.col("value"), F.lit("decode"), F.lit(1.5)).alias("stages"))
    mapping = spark.createDataFrame([("view", "dit"), ("click", "dit"), ("purchase", "text"), ("decode", "vae")], "stage string, component string")
    return runs.component_times(e, mapping, ["event_id"])


def filter_option_lists(spark: SparkSession, d: str) -> DataFrame:
    r = _runs(spark, d)
    return runs.filter_options(r.select("model_id", "gpu_type"), r.where("ok").select("model_id", "workload_id"))


def record_names(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).select("event_id", runs.record_path(F.concat("workload_id", F.lit("/"), "gpu_type"), F.col("ts"), F.col("commit_sha")).alias("path"))


def markdown_report(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).select("event_id", runs.markdown_row(F.concat("model_id", F.lit("|"), "variant_id"), F.col("gpu_type"), F.substring("commit_sha", 1, 12), F.col("vae_decode_time_s")).alias("line"))


def records_parsed(spark: SparkSession, d: str) -> DataFrame:
    """Run records read back from JSON text, presence flags included."""
    e = table(spark, d, "events").select(F.when(F.col("event_id") % 10 == 0, F.lit("{broken")).otherwise(
        F.concat(F.lit('{"model_id": "m", "latency": '), F.col("value").cast("string"), F.when(F.col("event_id") % 2 == 0, F.lit(', "success": null')).otherwise(F.lit("")), F.lit("}"))).alias("value"))
    r = runs.parse_records(e)
    return r.select("model_id", "latency", "has_success", runs.succeeded().alias("ok"), runs.eligible().alias("base"))


QUERIES = {f.__name__: f for f in (
    runs_latest_vs_baseline, runs_summary, runs_latest_by_source, runs_status_counts, runs_ordered_status, runs_worst_regression, runs_cohort_counts,
    runs_trend_points, runs_last_n, runs_recipe_mismatch, runs_recipe_mismatch_all, runs_metric_coverage, runs_median_by_cohort, runs_display_filter, runs_recent_eligible,
    runs_same_identity, runs_static_failures, runs_overrides, runs_gate_status, runs_source_detection, runs_seed_problems, runs_batch_consistency,
    runs_repeated_provenance, run_summaries, stage_component_sum, filter_option_lists, record_names, markdown_report, records_parsed,
)}

_RANKED = "SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events"
_LATEST = f"""SELECT user_id, event_type, max(value) FILTER (WHERE rn = 1) AS latest,
  count(value) FILTER (WHERE rn > 1) AS baseline_n, median(value) FILTER (WHERE rn > 1) AS baseline
  FROM ({_RANKED}) WHERE rn <= 6 GROUP BY user_id, event_type"""


def _summary(pick: str) -> str:
    names = [m.name for m in runs.METRICS]
    inner = f"""WITH r AS {_R}, l AS (SELECT cohort, arg_max(event_id, (ts, event_id)) AS event_id FROM r WHERE {pick} GROUP BY cohort),
      lr AS (SELECT r.* FROM r JOIN l USING (cohort, event_id)),
      h AS (SELECT r.*, row_number() OVER (PARTITION BY r.cohort ORDER BY r.ts DESC, r.event_id DESC) AS k FROM r JOIN lr ON r.cohort = lr.cohort AND (r.ts, r.event_id) < (lr.ts, lr.event_id) WHERE r.ok AND r.base),
      b AS (SELECT cohort, count(*) AS baseline_n, {', '.join(f'median({n}) AS {n}_base' for n in names)} FROM h WHERE k <= 5 GROUP BY cohort),
      j AS (SELECT lr.cohort, lr.event_id AS latest_run, lr.ok AS latest_ok, coalesce(baseline_n, 0) AS baseline_n, {', '.join(f'lr.{n}, {n}_base' for n in names)} FROM lr LEFT JOIN b USING (cohort)),
      p AS (SELECT *, {', '.join(f"CASE WHEN {m.name}_base > 0 THEN ({f'{m.name}_base - {m.name}' if m.higher_is_better else f'{m.name} - {m.name}_base'}) / {m.name}_base * 100 END AS {m.name}_pct" for m in runs.METRICS)} FROM j),
      x AS (SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {m.name}_pct > {m.percent} AND {m.name}_pct / 100 * {m.name}_base > {m.absolute} THEN '{m.name}' END" for m in runs.METRICS)}) AS exceeded,
        greatest({', '.join(f'{n}_pct' for n in names)}) AS worst_pct FROM p)
      SELECT *, CASE WHEN NOT latest_ok OR exceeded <> '' THEN 'fail' ELSE 'pass' END AS status FROM x"""
    return inner


_S = _summary("true")
_K = "event_id"
ORACLES = {
    "runs_latest_vs_baseline": f"""SELECT *, CASE WHEN baseline > 0 THEN latest - baseline END AS delta_abs,
      CASE WHEN baseline > 0 THEN (latest - baseline) / baseline * 100 END AS delta_pct,
      coalesce(baseline > 0 AND (latest - baseline) / baseline * 100 > 8 AND latest - baseline > 0.5, false) AS regressed FROM ({_LATEST})""",
    "runs_summary": _S,
    "runs_latest_by_source": f"SELECT cohort, latest_run, latest_ok, baseline_n, latency, latency_base, status FROM ({_summary(chr(115) + 'rc = ' + repr('pr'))})",
    "runs_status_counts": f"SELECT count(*) AS total, count(*) FILTER (WHERE status = 'pass') AS passed, count(*) FILTER (WHERE status = 'fail') AS failed FROM ({_S})",
    "runs_ordered_status": f"SELECT cohort, status FROM ({_S})",
    "runs_worst_regression": f"SELECT cohort, worst_pct, exceeded FROM ({_S})",
    "runs_cohort_counts": f"SELECT cohort, count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE base) AS n_base FROM {_R} GROUP BY cohort",
    "runs_trend_points": f"SELECT cohort, ts, event_id, text_encoder_time_s AS value, row_number() OVER (PARTITION BY cohort ORDER BY ts, event_id) AS seq FROM {_R}",
    "runs_last_n": f"SELECT cohort, event_id, latency FROM {_R} WHERE ok QUALIFY row_number() OVER (PARTITION BY cohort ORDER BY ts DESC, event_id DESC) <= 3",
    "runs_recipe_mismatch": f"""WITH r AS {_R}, h AS (SELECT * FROM r WHERE event_id % 10 > 5),
      c AS (SELECT event_id, workload_id, variant_id, gpu_type, recipe_fingerprint || 'x' AS recipe_fingerprint FROM r WHERE event_id % 10 = 0 UNION ALL SELECT event_id, workload_id, variant_id, gpu_type, recipe_fingerprint FROM r WHERE event_id % 10 = 5)
      SELECT * FROM c WHERE EXISTS (SELECT 1 FROM h WHERE h.workload_id = c.workload_id AND h.variant_id = c.variant_id AND h.gpu_type = c.gpu_type AND h.recipe_fingerprint <> c.recipe_fingerprint)
        AND NOT EXISTS (SELECT 1 FROM h WHERE h.workload_id = c.workload_id AND h.variant_id = c.variant_id AND h.gpu_type = c.gpu_type AND h.recipe_fingerprint = c.recipe_fingerprint)""",
    "runs_recipe_mismatch_all": f"""WITH r AS {_R}, h AS (SELECT * FROM r WHERE src = 'scheduled_main'),
      c AS (SELECT event_id, workload_id, variant_id, gpu_type, recipe_fingerprint || CASE WHEN src = 'pr' THEN 'x' ELSE '' END AS recipe_fingerprint FROM r WHERE src <> 'scheduled_main')
      SELECT * FROM c WHERE EXISTS (SELECT 1 FROM h WHERE h.workload_id = c.workload_id AND h.variant_id = c.variant_id AND h.gpu_type = c.gpu_type AND h.recipe_fingerprint <> c.recipe_fingerprint)
        AND NOT EXISTS (SELECT 1 FROM h WHERE h.workload_id = c.workload_id AND h.variant_id = c.variant_id AND h.gpu_type = c.gpu_type AND h.recipe_fingerprint = c.recipe_fingerprint)""",
    "runs_metric_coverage": "SELECT model_id, gpu_type, workload_id, count(*) AS n_runs, " + ", ".join(f"count({m}) AS n_{m}, CASE WHEN count({m}) = 0 THEN 'no values' WHEN count({m}) < 2 THEN 'one value' END AS skip_{m}" for m in ("latency", "text_encoder_time_s", "vae_decode_time_s")) + f" FROM {_R} GROUP BY ALL",
    "runs_median_by_cohort": f"SELECT cohort, median(text_encoder_time_s) AS median FROM {_R} GROUP BY cohort",
    "runs_display_filter": f"SELECT event_id, model_id, gpu_type FROM {_R} WHERE model_id = 'model_2' AND src = 'local' AND success",
    "runs_recent_eligible": f"SELECT event_id, cohort FROM {_R} WHERE (ts IS NULL OR ts >= TIMESTAMP '2024-01-20') AND ok AND base",
    "runs_same_identity": f"SELECT event_id FROM {_R} WHERE event_id % 2 <> 0 AND benchmark_version = 1",
    "runs_static_failures": f"""WITH r AS (SELECT *, CASE WHEN gpu_type LIKE '%L40S%' THEN 300.0 WHEN gpu_type LIKE '%H100%' THEN 200.0 ELSE 100.0 END AS cap FROM {_R})
      SELECT event_id, 'latency' AS metric, latency AS current, CAST(cap AS DOUBLE) AS ceiling FROM r WHERE latency > cap UNION ALL SELECT event_id, 'memory', memory, 9000.0 FROM r WHERE memory > 9000""",
    "runs_overrides": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS DOUBLE) ELSE CAST(8 AS DOUBLE) END AS percent FROM events",
    "runs_gate_status": """SELECT event_id, status, status IN ('PASS', 'CALIBRATION_NEEDED') AS upload FROM (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'INFRA_ERROR' WHEN event_id % 7 = 0 THEN 'RECIPE_MISMATCH' WHEN event_id % 5 = 0 THEN 'REGRESSION' WHEN event_id % 11 = 0 THEN 'INFRA_ERROR'
      WHEN event_id % 3 = 0 AND event_id % 2 = 0 THEN 'PASS' WHEN event_id % 3 = 0 THEN 'CALIBRATION_NEEDED' WHEN value > 100 THEN 'REGRESSION' ELSE 'PASS' END AS status FROM events)""",
    "runs_source_detection": "SELECT event_id, CASE WHEN event_id % 3 = 1 THEN 'pr' WHEN event_id % 5 = 0 AND event_id % 2 = 0 THEN 'scheduled_main' WHEN event_id % 7 <> 0 THEN 'unknown' ELSE 'local' END AS source FROM events",
    "runs_seed_problems": f"SELECT event_id, concat_ws(',', CASE WHEN latency IS NULL OR latency <= 0 THEN 'latency' END, CASE WHEN throughput IS NULL OR throughput <= 0 THEN 'throughput' END, CASE WHEN text_encoder_time_s IS NULL THEN 'text_encoder_time_s' END, 'vae_decode_time_s') AS problems FROM {_R}",
    "runs_batch_consistency": f"""WITH m AS (SELECT cohort, median(text_encoder_time_s) AS median, count(text_encoder_time_s) AS n FROM {_R} GROUP BY cohort HAVING count(text_encoder_time_s) >= 2)
      SELECT cohort, any_value(median) AS median, any_value(n) AS n, max(CASE WHEN median > 0 THEN abs(text_encoder_time_s - median) / median END) AS worst, any_value(median) <= 0 AS error FROM {_R} JOIN m USING (cohort) WHERE text_encoder_time_s IS NOT NULL GROUP BY cohort""",
    "runs_repeated_provenance": f"""SELECT identity, count(*) AS n FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'job-' || CAST(event_id % 97 AS STRING) WHEN event_id % 3 = 0 THEN 'build-' || CAST(event_id % 89 AS STRING) ELSE commit_sha END AS identity FROM {_R}) GROUP BY identity HAVING count(*) > 1""",
    "run_summaries": "SELECT l_orderkey, avg(l_quantity) AS mean_s, max(l_extendedprice) AS max_mb, CASE WHEN avg(l_quantity) > 0 THEN (CASE WHEN l_orderkey % 2 = 0 THEN 45 ELSE 1 END) / avg(l_quantity) END AS fps FROM lineitem GROUP BY l_orderkey",
    "stage_component_sum": """SELECT event_id, component, sum(seconds) AS seconds FROM (SELECT event_id, CASE event_type WHEN 'view' THEN 'dit' WHEN 'click' THEN 'dit' WHEN 'purchase' THEN 'text' END AS component, value AS seconds FROM events
      UNION ALL SELECT event_id, 'vae', 1.5 FROM events) WHERE component IS NOT NULL GROUP BY ALL""",
    "filter_option_lists": f"WITH r AS {_R} SELECT 'model_id' AS option, model_id AS value FROM r UNION SELECT 'gpu_type', gpu_type FROM r UNION SELECT 'workload_id', workload_id FROM r WHERE ok",
    "record_names": f"SELECT event_id, regexp_replace(workload_id || '/' || gpu_type, '[^A-Za-z0-9._-]', '_', 'g') || '/' || strftime(ts, '%Y%m%dT%H%M%S') || '_' || substr(commit_sha, 1, 12) || '.json' AS path FROM {_R}",
    "markdown_report": f"SELECT event_id, '| ' || replace(model_id || '|' || variant_id, '|', '\\|') || ' | ' || gpu_type || ' | ' || substr(commit_sha, 1, 12) || ' | - |' AS line FROM {_R}",
    "records_parsed": "SELECT 'm' AS model_id, value AS latency, event_id % 2 = 0 AS has_success, event_id % 2 <> 0 AS ok, true AS base FROM events WHERE event_id % 10 <> 0",
}
