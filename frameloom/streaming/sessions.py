"""Structured Streaming over session events: buckets, health, exactly-once sinks.

The event log has no rule for late data; ours is the watermark of each
function, beyond which an event is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def throughput(events: DataFrame, ts: str, size: str, width: str = "1 second", late: str = "10 seconds") -> DataFrame:
    """start, bytes, mbps per tumbling window."""
    g = events.where(F.col(size) > 0).withWatermark(ts, late).groupBy(F.window(ts, width).alias("w")).agg(F.sum(size).alias("bytes"))
    return g.select(F.col("w.start").alias("start"), "bytes", (F.col("bytes") * 8 / 1e6).alias("mbps"))


def event_counts(events: DataFrame, ts: str, keys: list[str], width: str = "1 minute", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.withWatermark(ts, late).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def sessions(events: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions by inactivity: an extension, built on the engine's session windows."""
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


HEALTH = "replica string, state string, run bigint, seen bigint"


def health(checks: DataFrame, fails: int = 3, successes: int = 2) -> DataFrame:
    """replica, state, run, seen after each batch: the state machine of operators.series.health, kept per replica.

    checks: replica, seq, ok. Within a batch rows are applied in order of seq.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, last, run, seen = state.get if state.exists else ("unknown", -1, 0, 0)
        rows = pd.concat(list(frames)).sort_values("seq")
        for ok in rows["ok"].tolist():
            ok = bool(ok) if ok is not None and ok == ok else False
            run = run + 1 if int(ok) == last else 1
            last, seen = int(ok), seen + 1
            if ok and (now == "unknown" or run >= successes):
                now = "healthy"
            elif not ok and run >= fails:
                now = "unhealthy"
        state.update((now, last, run, seen))
        yield pd.DataFrame({"replica": [key[0]], "state": [now], "run": [run], "seen": [seen]})

    return checks.groupBy("replica").applyInPandasWithState(step, HEALTH, "now string, last bigint, run bigint, seen bigint", "update", GroupStateTimeout.NoTimeout)


def append_once(df: DataFrame, batch: int, out: str) -> None:
    """For foreachBatch: a batch's files stand under its number, so a repeated batch overwrites itself."""
    df.write.mode("overwrite").parquet(f"{out}/batch={batch}")
