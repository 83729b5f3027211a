"""Deterministic order, shards, batches and chunks.

An order is a bijection by seeded hash with the key as the last sort column, so
every worker and every re-run sees the same one. Positions over a whole table
come from a range-partitioned sort and per-partition offsets, never from one
window over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from frameloom.session import cut


def positions(rows: DataFrame, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """Adds the 0-based position in the given total order.

    Range partitioning sorts the table in parallel; each partition then numbers
    its own rows, and the sizes of the partitions before it are added. The
    numbered rows are written once: partition boundaries are sampled, so a
    recomputed partition need not be the same one. The size list has one row
    per partition.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = rows.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(cols)])
    keys = [f"_o{i}" for i in range(len(cols))]
    part = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).drop(*keys)
    # The number's upper bits are the partition, the lower 33 the place in it.
    part = part.withColumns({"_p": F.shiftright("_at", 33), "_r": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_at")
    part = cut(rows.sparkSession, part, "positions")
    sizes = part.groupBy("_p").agg((F.max("_r") + 1).alias("_n"))
    before = sizes.withColumn("_b", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_p", "_b")
    return part.join(F.broadcast(before), "_p").withColumn(name, (F.col("_r") + F.col("_b")).cast("bigint")).drop("_p", "_r", "_b")


def hash_order(seed: int, key: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), key), key]


def contiguous(idx: Column, total: int, shards: int) -> Column:
    """Shard of a position if the first shards take ceil(total / shards) each."""
    return F.floor(idx / max(1, -(-total // shards))).cast("bigint")


def strided(idx: Column, shards: int) -> Column:
    return F.pmod(idx, F.lit(shards)).cast("bigint")


def kept_total(total: int, batch: int, groups: int, drop_last: bool) -> int:
    """Positions a sampler serves: whole batches of all groups, or rounded up by wrapping around."""
    unit = batch * groups
    return total // unit * unit if drop_last else -(-total // unit) * unit


def sampler(rows: DataFrame, order: Sequence[Column | str], total: int, batch: int, groups: int, drop_last: bool = True, skip_first: bool = False) -> DataFrame:
    """idx, group, batch of each served row: a permutation cut or padded by wrapping, dealt to groups by stride, batched in each.

    skip_first leaves out position 0 before all else.
    """
    df = positions(rows, order)
    if skip_first:
        df, total = df.where("idx > 0").withColumn("idx", F.col("idx") - 1), total - 1
    keep = kept_total(total, batch, groups, drop_last)
    if keep <= total:
        df = df.where(F.col("idx") < keep)
    elif total:
        laps = F.floor((F.lit(keep - 1) - F.col("idx")) / total)
        df = df.withColumn("idx", F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), laps), lambda k: F.col("idx") + k * total)))
    return df.withColumns({"group": strided(F.col("idx"), groups), "batch": F.floor(F.floor(F.col("idx") / groups) / batch)})


def cyclic_pad(rows: DataFrame, order: Sequence[Column | str], total: int, groups: int) -> DataFrame:
    """Rows duplicated cyclically up to a multiple of ``groups``, split contiguously: idx, group."""
    df = sampler(rows, order, total, 1, groups, drop_last=False).drop("batch")
    return df.withColumn("group", contiguous(F.col("idx"), kept_total(total, 1, groups, False), groups))


def validation_shard(rows: DataFrame, order: Sequence[Column | str], total: int, world: int) -> DataFrame:
    """Stride shards of equal size, padded by wrapping; real tells the first visit of a row."""
    df = sampler(rows, order, total, 1, world, drop_last=False).drop("batch")
    return df.withColumn("real", F.col("idx") < total)


def repeat_sampler(rows: DataFrame, seed: int, key: str, world: int, batch: int, repeat: int) -> DataFrame:
    """Each step's world*batch slots: world*batch/repeat distinct prompts, each ``repeat`` times, dealt again by hash."""
    if world * batch % repeat:
        raise ValueError("repeat must divide the slots of a step")
    unique = world * batch // repeat
    picked = positions(rows.select(key), hash_order(seed, F.col(key))).where(F.col("idx") < unique)
    slots = picked.select(key, F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))).alias("copy"))
    # slots of one step: world x batch rows, a parameter and no part of the data.
    w = W.orderBy(F.xxhash64(F.lit(seed + 1), F.col(key), F.col("copy")), key, "copy")
    return slots.withColumn("slot", F.row_number().over(w) - 1).withColumn("rank", F.floor(F.col("slot") / batch))


def mix(roots: DataFrame, files: DataFrame) -> DataFrame:
    """Files of each root as often as it says, in order of their names; roots with no positive number drop out.

    roots: root, repeats; files: root, path. Raises if nothing is left.
    """
    live = roots.where("repeats > 0")
    if live.isEmpty():
        raise ValueError("no root is left")
    return files.join(live, "root").select("root", "path", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("copy")).orderBy("path", "copy")


def parse_mix(text: str) -> dict[str, int]:
    """'a:2,b:1' to numbers by root; a part without a number counts once; what is no whole number is an error."""
    out: dict[str, int] = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        root, _, n = part.rpartition(":") if ":" in part else (part, "", "1")
        if not n.strip().lstrip("-").isdigit():
            raise ValueError(f"not a number of repeats: {part}")
        if int(n) > 0:
            out[root] = out.get(root, 0) + int(n)
    if not out:
        raise ValueError("no root is left")
    return out


def locate(files: DataFrame, order: Sequence[str], length: str, wanted: DataFrame, index: str) -> DataFrame:
    """Of each global index the file and the row in it; an index outside the table has none.

    Files are few against rows: their running offsets are sorted once, and
    indexes meet them through blocks of the index range, an equi join. A block
    is about as long as a file on average, so the files' parts are about twice
    as many as the files, and a block meets few of them.
    """
    run = files.withColumn("_end", F.sum(length).over(W.orderBy(*order))).withColumn("_start", F.col("_end") - F.col(length)).where(F.col(length) > 0)
    size = run.agg(F.avg(length)).first()[0] or 1
    block = 1 << max(0, round(math.log2(size)))
    spans = run.withColumn("_block", F.explode(F.sequence(F.floor(F.col("_start") / block), F.floor((F.col("_end") - 1) / block))))
    w = wanted.withColumn("_block", F.floor(F.col(index) / block))
    return w.join(spans, "_block").where((F.col(index) >= F.col("_start")) & (F.col(index) < F.col("_end"))).withColumn("row_in_file", F.col(index) - F.col("_start")).drop("_block", "_start", "_end")


def pack(files: DataFrame, shards: int, seed: int, batch: int, name: str = "path", length: str = "rows") -> DataFrame:
    """shard, path, rows, serve: greedy packing, longest file first into the least full shard, and the rows each shard serves.

    Runs on file metadata: one row per file of one dataset in one group.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([length, name], ascending=[False, True])
        full, where = [0] * shards, []
        for n in pdf[length]:
            k = full.index(min(full))
            where.append(k)
            full[k] += int(n)
        return pdf.assign(shard=where, serve=min(full) // batch * batch)[["shard", name, length, "serve"]]

    packed = files.select(name, length).groupBy().applyInPandas(run, f"shard bigint, `{name}` string, `{length}` bigint, serve bigint")
    return packed.withColumn("turn", F.row_number().over(W.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), F.col(name)), name)))


def chunk_ids(rows: DataFrame, order: Sequence[Column | str], size: int, remainder: bool = False, first: int = 0) -> DataFrame:
    """Adds chunk: full chunks of ``size`` rows in order, numbered from ``first``; the rest only with ``remainder``."""
    df = positions(rows, order)
    df = df.withColumn("chunk", F.floor(F.col("idx") / size) + first)
    return df if remainder else df.where(F.col("idx") < F.lit(rows.count() // size * size))
