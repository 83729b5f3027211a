"""Sinks: chunked sample files, partitioned tables, run records, reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameloom.operators.runs import record_path
from frameloom.operators.shards import chunk_ids


def fixed_rows(rows: DataFrame, out: str, order: Sequence[Column | str], size: int, workers: int = 1, remainder: bool = True, first: int = 0) -> DataFrame:
    """Files of exactly ``size`` rows at worker=<w>/chunk=<n>, the last shorter one only with ``remainder``. Returns the rows left over.

    The file committer makes a chunk appear whole or not at all; numbering
    continues from ``first``.
    """
    done = chunk_ids(rows, order, size, remainder, first).withColumn("worker", F.pmod(F.col("chunk"), F.lit(workers)))
    done.drop("idx").repartition("chunk").write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", size).partitionBy("worker", "chunk").parquet(out)
    if remainder:
        return rows.limit(0)
    full = rows.count() // size * size
    return chunk_ids(rows, order, size, True, first).where(F.col("idx") >= full).select(*rows.columns)


def by_split(rows: DataFrame, out: str, columns: Sequence[str] = ("split",)) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*columns).parquet(out)


def payload_tables(rows: DataFrame, out: str, key: str, payloads: Sequence[str]) -> None:
    """One table per payload column under its name, keyed by the sample's relative path."""
    for p in payloads:
        rows.where(F.col(p).isNotNull()).select(key, F.col(p).alias("content")).write.mode("overwrite").parquet(f"{out}/{p}")


def run_records(rows: DataFrame, out: str, model: str = "model_id", ts: str = "ts", sha: str = "commit_sha") -> DataFrame:
    """Run records as JSON text by model; returns path, value as a store of single files would hold them."""
    doc = rows.select(record_path(F.col(model), F.col(ts), F.col(sha)).alias("path"), F.to_json(F.struct(*rows.columns)).alias("value"))
    doc.withColumn("folder", F.substring_index("path", "/", 1)).write.mode("overwrite").partitionBy("folder").parquet(out)
    return doc


def seed_checks(rows: DataFrame, key: str, document: str) -> DataFrame:
    """One row: documents, distinct keys and distinct contents (by digest) of a batch to be published."""
    return rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("n_keys"), F.countDistinct(F.sha2(F.col(document), 256)).alias("n_contents"))


def validation_list(rows: DataFrame, n: int, seed: int, key: str, columns: Sequence[str]) -> DataFrame:
    """``n`` rows by seeded hash, as JSON objects without null fields. A top-k: no full sort, no window."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n).select(F.to_json(F.struct(*columns)).alias("value"))


def fan_out(rows: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """The same rows to several sinks, computed once."""
    kept = rows.persist()
    try:
        for s in sinks:
            s(kept)
    finally:
        kept.unpersist()


def json_lines(rows: DataFrame, out: str) -> None:
    """Appends rows as JSON lines: results (numbers, arrays and nested values keep their form) and event logs."""
    rows.write.mode("append").json(out)
