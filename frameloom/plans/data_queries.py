"""Queries of the core data-preparation operators: compaction and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.operators import compaction, profile
from frameloom.plans.tables import table
from frameloom.session import scratch_dir

WATCHED = ["num_frames", "fps", "duration_sec", "width"]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return compaction.found(spark, [f"{d}/t2v_samples.parquet"])


def p2_files(spark: SparkSession, d: str) -> DataFrame:
    """The files after consolidation: number of records and of distinct sample numbers in each."""
    done = compaction.consolidate(spark, [f"{d}/t2v_samples.parquet"], scratch_dir(spark, "compacted"))
    return (
        spark.read.parquet(done.path).groupBy(F.input_file_name().alias("f"))
        .agg(F.count(F.lit(1)).alias("n_records"), F.countDistinct("sample_no").alias("n_numbers"))
        .agg(F.sum("n_records").alias("n_records"), F.sum("n_numbers").alias("n_numbers"))
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    store = profile.CountStore(spark, scratch_dir(spark, "counts"))
    return profile.shifted(store.apply(profile.delta(table(spark, d, "t2v_samples"), "load_id", WATCHED)))


def p3_profile(spark: SparkSession, d: str) -> DataFrame:
    store = profile.CountStore(spark, scratch_dir(spark, "counts"))
    state = store.apply(profile.delta(table(spark, d, "t2v_samples"), "load_id"))
    return profile.profile(state).withColumn("entropy", F.round("entropy", 6))


QUERIES = {"p2_found": p2_found, "p2_files": p2_files, "p3_found": p3_found, "p3_profile": p3_profile}

_UNLIKE = " UNION ALL ".join(
    f"""SELECT load_id, '{c}' AS column_name FROM (
    SELECT a.load_id, a.n, a.nn, a.bad, a.top, a.med, count(*) AS on_, count(*) FILTER (WHERE t.{c} IS NULL) AS onn,
      quantile_cont(CASE WHEN isfinite(CAST(t.{c} AS DOUBLE)) THEN CAST(t.{c} AS DOUBLE) END, 0.5) AS omed
    FROM (SELECT s.load_id, count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS nn,
        count(*) FILTER (WHERE {c} IS NOT NULL AND (NOT isfinite(CAST({c} AS DOUBLE)) OR {c} <= 0)) AS bad,
        coalesce((SELECT max(k) FROM (SELECT count(*) AS k FROM t2v_samples x WHERE x.load_id = s.load_id AND x.{c} IS NOT NULL AND NOT isnan(CAST(x.{c} AS DOUBLE)) GROUP BY x.{c})), 0) AS top,
        quantile_cont(CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END, 0.5) AS med
      FROM t2v_samples s GROUP BY s.load_id) a JOIN t2v_samples t ON t.load_id <> a.load_id
    GROUP BY ALL)
  WHERE abs(nn / n - onn / on_) > 0.2 OR med > 1.5 * omed OR med < omed / 1.5 OR (n > nn AND bad / (n - nn) > 0.2) OR (n > nn AND top / (n - nn) > 0.8)"""
    for c in WATCHED
)

ORACLES = {
    "p2_found": """SELECT keep_no, sample_no AS copy_no FROM (
        SELECT sample_no, min(sample_no) OVER (PARTITION BY id, vae_latent_bytes) AS keep_no FROM t2v_samples
        WHERE id IS NOT NULL AND vae_latent_bytes IS NOT NULL) WHERE sample_no <> keep_no""",
    "p2_files": """SELECT count(*) AS n_records, count(DISTINCT sample_no) AS n_numbers FROM (
        SELECT sample_no, CASE WHEN id IS NULL OR vae_latent_bytes IS NULL THEN sample_no ELSE min(sample_no) OVER (PARTITION BY id, vae_latent_bytes) END AS k FROM t2v_samples)
        WHERE sample_no = k""",
    "p3_found": _UNLIKE,
}
