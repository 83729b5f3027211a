"""Ordered series: neighbours, windows, onsets, runs of states, latency summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _w(keys: Sequence[str], order: Sequence[str]):
    return W.partitionBy(*keys).orderBy(*order)


def adjacent_difference(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Adds diff: the absolute change from the row before, null for the first."""
    return rows.withColumn("diff", F.abs(F.col(value) - F.lag(value).over(_w(keys, order))))


def gaps(rows: DataFrame, keys: Sequence[str], order: Sequence[str], seconds: Column) -> DataFrame:
    """Adds gap_ms since the row before of the same session."""
    return rows.withColumn("_s", seconds).withColumn("gap_ms", (F.col("_s") - F.lag("_s").over(_w(keys, order))) * 1000).drop("_s")


def summary(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Per series: n, mean, std (of the population), max, and the trapezoid area over n-1."""
    x = rows.withColumn("_p", F.lag(value).over(_w(keys, order)))
    g = x.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.max(value).alias("max"), F.sum((F.col(value) + F.col("_p")) / 2).alias("_a"))
    return g.withColumn("auc", F.coalesce(F.col("_a"), F.lit(0.0)) / F.greatest(F.col("n") - 1, F.lit(1))).drop("_a")


def divergence_onset(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, window: int = 5, factor: float = 2.0, least: float = 1.0) -> DataFrame:
    """Per series: the threshold and the first position whose moving average exceeds it, null if none does.

    The window shrinks to the length of a shorter series; the threshold is
    ``factor`` times the median of the first window, ``least`` at least.
    """
    w = _w(keys, order)
    x = rows.withColumns({"_i": F.row_number().over(w) - 1, "_n": F.count(F.lit(1)).over(W.partitionBy(*keys))})
    x = x.withColumn("_k", F.least(F.lit(window), F.col("_n")))
    base = x.where("_i < _k").groupBy(*keys).agg(F.greatest(F.median(value) * factor, F.lit(least)).alias("threshold"))
    ahead = w.rowsBetween(0, window - 1)
    smooth = x.withColumns({"_avg": F.avg(value).over(ahead)}).where(F.col("_i") + F.col("_k") <= F.col("_n"))
    return smooth.join(base, list(keys)).groupBy(*keys).agg(F.max("threshold").alias("threshold"), F.min(F.when(F.col("_avg") > F.col("threshold"), F.col("_i"))).alias("onset"))


def consistency(rows: DataFrame, keys: Sequence[str], order: Sequence[str], vector: str) -> DataFrame:
    """Per clip: the mean over frames after the first of the cosines to the frame before and to the first, each held at zero."""
    w = _w(keys, order)
    x = rows.withColumns({"_p": F.lag(vector).over(w), "_f": F.first(vector).over(w)}).where("_p IS NOT NULL")
    return x.groupBy(*keys).agg(F.avg((F.greatest(cosine(F.col("_p"), F.col(vector)), F.lit(0.0)) + F.greatest(cosine(F.col("_f"), F.col(vector)), F.lit(0.0))) / 2).alias("score"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Null for a vector without length."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def running_average(values: Column, weight: float) -> Column:
    """Exponentially weighted average of an array, the last value."""
    return F.aggregate(values, F.lit(None).cast("double"), lambda s, v: F.when(s.isNull(), v.cast("double")).otherwise(s * (1 - weight) + v.cast("double") * weight))


def health(rows: DataFrame, keys: Sequence[str], order: Sequence[str], ok: Column, fails: int = 3, successes: int = 2) -> DataFrame:
    """Adds run (length so far of equal outcomes) and state.

    Unknown turns healthy at the first success; after ``fails`` failures in a
    row it is unhealthy, after ``successes`` in a row healthy again. The state
    after a row follows from the last decisive row, so gaps and islands replace
    a state machine.
    """
    w = _w(keys, order)
    x = rows.withColumn("_ok", F.coalesce(ok, F.lit(False)).cast("int"))
    x = x.withColumns({"_i": F.row_number().over(w), "_j": F.row_number().over(W.partitionBy(*keys, "_ok").orderBy(*order))})
    x = x.withColumn("run", F.row_number().over(W.partitionBy(*keys, "_ok", F.col("_i") - F.col("_j")).orderBy(*order)))
    first_ok = F.min(F.when(F.col("_ok") == 1, F.col("_i"))).over(W.partitionBy(*keys))
    down = F.min(F.when((F.col("_ok") == 0) & (F.col("run") >= fails), F.col("_i"))).over(W.partitionBy(*keys))
    x = x.withColumns({"_first": first_ok, "_down": down})
    decisive = (
        F.when((F.col("_ok") == 0) & (F.col("run") >= fails), "unhealthy")
        .when((F.col("_ok") == 1) & (F.col("run") >= successes), "healthy")
        .when((F.col("_ok") == 1) & (F.col("_i") == F.col("_first")) & (F.col("_down").isNull() | (F.col("_i") < F.col("_down"))), "healthy")
    )
    x = x.withColumn("state", F.coalesce(F.last(decisive, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit("unknown")))
    return x.drop("_ok", "_i", "_j", "_first", "_down")


def percentiles(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """count, min, p50, p95, p99, max, avg with linear interpolation; nulls don't count."""
    p = F.percentile(value, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    g = rows.groupBy(*keys).agg(F.count(value).alias("count"), F.min(value).alias("min"), p.alias("_p"), F.max(value).alias("max"), F.avg(value).alias("avg"))
    return g.select(*keys, "count", "min", *[F.get("_p", i).alias(n) for i, n in enumerate(("p50", "p95", "p99"))], "max", "avg")


def serving(rows: DataFrame, ok: Column, latency: str, memory: str, seconds: float) -> DataFrame:
    """Requests done and failed, rate, latency of the successes, memory of the positive readings; zeros where there are none."""
    lat, mem = F.when(ok, F.col(latency)), F.when(F.col(memory) > 0, F.col(memory))
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return rows.agg(
        F.count_if(ok).alias("completed"), F.count_if(~ok).alias("failed"), (F.count_if(ok) / F.lit(seconds)).alias("qps"), z(F.avg(lat)).alias("latency_mean"), z(F.median(lat)).alias("latency_median"),
        z(F.percentile(lat, F.lit(0.99))).alias("latency_p99"), z(F.percentile(lat, F.lit(0.5))).alias("latency_p50"), z(F.max(mem)).alias("memory_max"), z(F.avg(mem)).alias("memory_mean"), z(F.median(mem)).alias("memory_median"),
    )


def goodput(rows: DataFrame, keys: Sequence[str], seconds: Column, size: str) -> DataFrame:
    """Megabits a second between a session's first and last chunk; null without a duration."""
    g = rows.where(F.col(size) > 0).groupBy(*keys).agg((F.max(seconds) - F.min(seconds)).alias("_d"), F.sum(size).alias("bytes"))
    return g.select(*keys, "bytes", F.when(F.col("_d") > 0, F.col("bytes") * 8 / F.col("_d") / 1e6).alias("mbps"))


def buckets(rows: DataFrame, ts: str, size: str, width: str = "1 second") -> DataFrame:
    """Bytes per tumbling window: start, bytes, mbps."""
    g = rows.where(F.col(size) > 0).groupBy(F.window(ts, width).alias("w")).agg(F.sum(size).alias("bytes"))
    return g.select(F.col("w.start").alias("start"), "bytes", (F.col("bytes") * 8 / 1e6).alias("mbps"))


def session_summary(rows: DataFrame, status: str, wait: str, early: str, limit: float) -> DataFrame:
    """Sessions by outcome, waits at or over the limit, share of eligible sessions that were early (null without any)."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(status) == "success").alias("success"), F.count_if(F.col(status) == "failed").alias("failed"),
        F.count_if(~F.coalesce(F.col(status), F.lit("unknown")).isin("success", "failed")).alias("other"), F.count_if(F.col(wait) >= limit).alias("breaches"),
        F.avg(F.col(early).cast("double")).alias("early_ratio"),
    )


def median_by_group(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Median per group of two values or more, most values first."""
    return rows.groupBy(group).agg(F.count(value).alias("n"), F.median(value).alias("median")).where("n > 1").orderBy(F.desc("n"), group)


def top_mean(rows: DataFrame, keys: Sequence[str], value: str, share: float) -> DataFrame:
    """Mean of the greatest values: the share of them, one at least."""
    w = W.partitionBy(*keys)
    x = rows.withColumns({"_r": F.row_number().over(w.orderBy(F.col(value).desc_nulls_last())), "_n": F.count(value).over(w)})
    return x.where(F.col("_r") <= F.greatest(F.lit(1), F.floor(F.col("_n") * share))).groupBy(*keys).agg(F.avg(value).alias("top_mean"))
