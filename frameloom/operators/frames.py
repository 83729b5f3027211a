"""Frame selection, padding and collation as array expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _indices(n: Column) -> Column:
    """0 .. n-1; empty for n <= 0, where sequence would count down."""
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array().cast("array<bigint>"))


def resample(n: Column, fps: Column, train_fps: float, num_frames: int, speed: float = 1.0) -> Column:
    """Indices of the frames that bring a clip to the training rate, at most ``num_frames``; an image (one frame) is [0]."""
    interval = fps / train_fps * speed
    count = F.when((fps > 0) & (n > 0), F.least(F.ceil(n / interval), F.lit(num_frames))).otherwise(0).cast("bigint")
    return F.when(n == 1, F.array(F.lit(0).cast("bigint"))).otherwise(F.transform(_indices(count), lambda i: F.floor(i * interval)))


def uniform(n: Column, wanted: int) -> Column:
    """All frames if there are no more than ``wanted``; else evenly spaced ones from first to last."""
    step = (n - 1) / F.lit(max(wanted - 1, 1))
    return F.when(n <= wanted, _indices(n)).otherwise(F.transform(_indices(F.lit(wanted).cast("bigint")), lambda i: F.floor(i * step)))


def random_crop(n: Column, size: int, seed: int, key: Column) -> Column:
    """start, a seeded hash of the key: the same after a resume, about even over the possible starts."""
    room = F.greatest(n - size, F.lit(0)) + 1
    return F.pmod(F.xxhash64(F.lit(seed), key), room)


def segments(n: Column, size: int, step: int, least_tail: float | None = None) -> Column:
    """array<struct<start,length>>: overlapping segments; a last short one is kept if it exceeds the share ``least_tail`` of a segment."""
    full = F.when(n >= size, F.floor((n - size) / step) + 1).otherwise(0).cast("bigint")
    out = F.transform(_indices(full), lambda i: F.struct((i * step).alias("start"), F.lit(size).cast("bigint").alias("length")))
    if least_tail is None:
        return out
    rest = n - full * step
    tail = F.when((rest > size * least_tail) & (n > F.when(full > 0, (full - 1) * step + size).otherwise(0)), F.array(F.struct((full * step).alias("start"), rest.alias("length"))))
    return F.concat(out, F.coalesce(tail, F.array().cast("array<struct<start:bigint,length:bigint>>")))


def segment_sizes(n: Column, size: int, step: int, least_tail: float | None = None) -> list[Column]:
    """n_segments and last_length (0 of none) of :func:`segments`, by arithmetic, so that no count of frames makes an array."""
    full = F.when(n >= size, F.floor((n - size) / step) + 1).otherwise(0).cast("bigint")
    rest = n - full * step
    tail = F.lit(False) if least_tail is None else F.coalesce((rest > size * least_tail) & (n > F.when(full > 0, (full - 1) * step + size).otherwise(0)), F.lit(False))
    return [(full + tail.cast("bigint")).alias("n_segments"), F.when(tail, rest).when(full > 0, size).otherwise(0).cast("bigint").alias("last_length")]


def pad_or_crop(values: Column, length: int, fill: Column) -> list[Column]:
    """values at exactly ``length``, and the mask of what is no padding."""
    n = F.least(F.size(values), F.lit(length))
    pad = F.array_repeat(fill, F.lit(length) - n)
    return [F.concat(F.slice(values, 1, length), pad).alias("values"), F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(length) - n)).alias("mask")]


def unpad(values: Column, mask: Column) -> Column:
    return F.slice(values, F.lit(1), F.aggregate(mask, F.lit(0), lambda a, x: a + x))


def dropout(rate: float, seed: int, index: Column) -> Column:
    """Whether a row's conditioning is dropped: a hash of seed and index, so that a resumed run drops the same rows. Exact at 0 and 1."""
    return F.pmod(F.xxhash64(F.lit(seed), index), F.lit(1 << 30)) / (1 << 30) < rate


def ragged(rows: DataFrame, batch: str, shape: str) -> DataFrame:
    """batch, n_shapes of the batches whose tensors can't be stacked."""
    return rows.groupBy(batch).agg(F.countDistinct(shape).alias("n_shapes")).where("n_shapes > 1")


def pad_to_longest(rows: DataFrame, batch: Sequence[str], values: str, fill: Column) -> DataFrame:
    """Adds padded and mask: every row of a batch at the length of its longest."""
    longest = F.max(F.size(values)).over(W.partitionBy(*batch))
    df = rows.withColumn("_m", longest)
    n = F.size(values)
    return df.withColumns({"padded": F.concat(F.col(values), F.array_repeat(fill, F.col("_m") - n)), "mask": F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.col("_m") - n))}).drop("_m")


def tensor_stats(values: Column) -> dict[str, Column]:
    """abs_mean, sum, min, max, mean, std (of a sample) of an array of numbers; null for an empty one."""
    n = F.size(values)
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    mean = F.when(n > 0, total / n)
    square = F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x)
    return {
        "abs_mean": F.when(n > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + F.abs(x)) / n), "sum": total, "min": F.array_min(values), "max": F.array_max(values),
        "mean": mean, "std": F.when(n > 1, F.sqrt(F.greatest(square - n * mean * mean, F.lit(0.0)) / (n - 1))), "size": n,
    }
