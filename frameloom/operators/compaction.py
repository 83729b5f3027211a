"""Consolidation of very many tiny files into few well-sized ones.

Method: engine split packing. The scan's own bin packing is tuned (maximum
bytes of a read split, cost of opening a file), so that one task reads many
files; the partitions are then coalesced without a shuffle and written to a
staging folder, which is verified against what was read. Records that resumed
writers stored again are found in the staged files and left out of the final
ones; the final folder appears by one rename.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from frameloom.operators.copies import label_copies
from frameloom.session import hadoop_path, remove_tree, scratch_dir

TARGET_BYTES = 128 << 20
#: Below this size a broadcast of the copies' row numbers (8 bytes each) replaces the shuffled anti join.
BROADCAST_COPIES = 1_000_000


class VerificationError(RuntimeError):
    """What was written isn't what was read."""


@dataclass(frozen=True)
class SplitPlan:
    """How the scan packs files: sizes in bytes."""

    files: int
    total_bytes: int
    max_partition_bytes: int
    open_cost: int
    out_files: int


def plan_splits(spark: SparkSession, paths: Sequence[str], target_bytes: int = TARGET_BYTES) -> SplitPlan:
    """Split sizes for files of this number and size.

    A file's opening is charged at a quarter of the mean file size at most, and
    at 4 MB at most: with the engine's default charge of 4 MB, a split of
    128 MB would end after 32 tiny files.
    """
    files = total = 0
    for path in paths:
        fs, p = hadoop_path(spark, path)
        for status in fs.globStatus(p) or []:
            s = fs.getContentSummary(status.getPath())
            files += s.getFileCount()
            total += s.getLength()
    mean = total // max(files, 1)
    out = max(1, math.ceil(total / target_bytes))
    return SplitPlan(files, total, target_bytes, max(1, min(4 << 20, mean // 4)), out)


@contextmanager
def packed_scan(spark: SparkSession, plan: SplitPlan) -> Iterator[None]:
    """Split packing by ``plan`` for the jobs started inside; the settings are put back after."""
    new = {"spark.sql.files.maxPartitionBytes": plan.max_partition_bytes, "spark.sql.files.openCostInBytes": plan.open_cost}
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _sums(df: DataFrame) -> list:
    """Number of rows and two commutative sums of row hashes; order and layout don't matter."""
    wide = "decimal(20,0)"
    cols = [F.col(f"`{c}`") for c in df.columns]
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64(*cols).cast(wide)), F.lit(0)).cast("decimal(38,0)").alias("a"),
        F.coalesce(F.sum(F.xxhash64(F.lit(1), *cols).cast(wide)), F.lit(0)).cast("decimal(38,0)").alias("b"),
    ]


def _written(spark: SparkSession, df: DataFrame, out: str, files: int) -> dict:
    """Writes ``df`` without a shuffle; the sums of what went by are observed in the same job."""
    seen = Observation()
    df.observe(seen, *_sums(df)).coalesce(files).write.option("compression", "zstd").parquet(out)
    got = seen.get
    back = spark.read.schema(df.schema).parquet(out)
    kept = back.agg(*_sums(back)).first().asDict()
    if any(got[k] != kept[k] for k in "nab"):
        remove_tree(spark, out)
        raise VerificationError(f"read {got}, wrote {kept}")
    return kept


@dataclass(frozen=True)
class Staged:
    plan: SplitPlan
    path: str
    rows: int
    data: DataFrame
    copies: DataFrame


def stage(
    spark: SparkSession,
    paths: Sequence[str],
    out: str,
    row_no: str = "sample_no",
    record: Sequence[str] = ("id", "vae_latent_bytes"),
    target_bytes: int = TARGET_BYTES,
) -> Staged:
    """The files of ``paths`` in few staged files, verified, with the copies found in them.

    copies: keep_key, copy_key, one row per row that is the same record as a
    row with a smaller ``row_no``. A record with a null in ``record`` is never a
    copy; empty bytes are a value. All columns are kept, whatever their names.
    """
    plan = plan_splits(spark, paths, target_bytes)
    with packed_scan(spark, plan):
        src = spark.read.parquet(*paths)
        kept = _written(spark, src, out, plan.out_files)
    data = spark.read.schema(src.schema).parquet(out)
    part = [f"r{i}" for i in range(len(record))]
    rows = data.select(F.col(row_no).alias("k"), *[F.col(c).alias(p) for c, p in zip(record, part)]).dropna(subset=part)
    rows = rows.withColumns({"f1": F.xxhash64(*part), "f2": F.xxhash64(F.lit("second"), *reversed(part))})
    copies = label_copies(
        spark, rows, [], ["f1", "f2"], "k", part,
        equal=lambda a, b: _all_equal(a, b, part),
        exact_key=lambda a: [a[p] for p in part],
    )
    return Staged(plan, out, kept["n"], data, copies)


def _all_equal(a: dict, b: dict, names: Sequence[str]):
    c = a[names[0]] == b[names[0]]
    for n in names[1:]:
        c = c & (a[n] == b[n])
    return c


@dataclass(frozen=True)
class Compacted:
    plan: SplitPlan
    path: str
    rows_in: int
    rows_out: int
    copies: DataFrame


def consolidate(
    spark: SparkSession,
    paths: Sequence[str],
    out: str,
    row_no: str = "sample_no",
    record: Sequence[str] = ("id", "vae_latent_bytes"),
    target_bytes: int = TARGET_BYTES,
) -> Compacted:
    """Few files in ``out`` that hold every record of ``paths`` exactly once.

    ``out`` must not exist. Rows with a null in ``record`` all stay. A failed
    verification raises VerificationError and leaves ``out`` absent.
    """
    staged = stage(spark, paths, f"{out}.staging", row_no, record, target_bytes)
    drop = staged.copies.select(F.col("copy_key").alias(row_no))
    n = drop.count()
    fresh = staged.data.join(F.broadcast(drop) if n <= BROADCAST_COPIES else drop, row_no, "left_anti").select(*staged.data.columns)
    with packed_scan(spark, staged.plan):
        kept = _written(spark, fresh, f"{out}.final", staged.plan.out_files)
    if kept["n"] != staged.rows - n:
        raise VerificationError(f"{staged.rows} rows, {n} copies, {kept['n']} written")
    fs, p = hadoop_path(spark, f"{out}.final")
    if not fs.rename(p, hadoop_path(spark, out)[1]):
        raise VerificationError(f"{out} could not be put in place")
    remove_tree(spark, staged.path)
    return Compacted(staged.plan, out, staged.rows, kept["n"], staged.copies)


def found(spark: SparkSession, paths: Sequence[str], target_bytes: int = TARGET_BYTES) -> DataFrame:
    """keep_no, copy_no of the samples in ``paths`` that are stored more than once."""
    staged = stage(spark, paths, scratch_dir(spark, "staged"), target_bytes=target_bytes)
    return staged.copies.select(F.col("keep_key").alias("keep_no"), F.col("copy_key").alias("copy_no"))
