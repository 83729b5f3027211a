"""The operational store: upserts, pages, listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The table after the changes: of each key the newest change, else the row it had. One aggregation, no join.

    Columns that aren't keys come from the winning row as a whole. Of changes
    equal in ``order`` the greater row wins, so the result is defined.
    """
    value = [c for c in base.columns if c not in keys]
    rank = lambda df, n, o: df.select(*keys, F.struct(F.lit(n).alias("_s"), o.alias("_o"), *value).alias("_v"))
    kind = changes.schema[order].dataType
    both = rank(base, 0, F.lit(None).cast(kind)).unionByName(rank(changes, 1, F.col(order)))
    return both.groupBy(*keys).agg(F.max("_v").alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in value])


def patch(base: DataFrame, changes: DataFrame, key: str, allowed: Sequence[str]) -> DataFrame:
    """Partial updates: allowed columns that a change gives replace the old ones; others are refused."""
    extra = [c for c in changes.columns if c not in (key, *allowed)]
    if extra:
        raise ValueError(f"columns that can't be changed: {', '.join(extra)}")
    given = [c for c in allowed if c in changes.columns]
    c = changes.select(key, *[F.col(g).alias(f"_{g}") for g in given])
    return base.join(c, key, "left").select(*[F.coalesce(f"_{x}", x).alias(x) if x in given else F.col(x) for x in base.columns])


def delete(base: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return base.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def page(rows: DataFrame, order: str, key: str, after: object | None, limit: int, descending: bool = False) -> DataFrame:
    """The next rows after a key in (order, key) order; an unknown key gives none. The limit is held to 1..100.

    A seek: the cursor's row is looked up, and what stands beyond it is read
    with a top-k, without numbering the table.
    """
    limit = max(1, min(100, limit))
    if after is not None:
        at = rows.where(F.col(key) == F.lit(after)).select(F.col(order).alias("_o"), F.col(key).alias("_k")).limit(1)
        o, k = F.col(order), F.col(key)
        beyond = ((o < F.col("_o")) if descending else (o > F.col("_o"))) | ((o == F.col("_o")) & ((k < F.col("_k")) if descending else (k > F.col("_k"))))
        rows = rows.join(F.broadcast(at), beyond).drop("_o", "_k")
    cols = [F.col(order).desc(), F.col(key).desc()] if descending else [F.col(order), F.col(key)]
    return rows.orderBy(*cols).limit(limit)


def newest_first(rows: DataFrame, created: str, key: str, kind: Column | None = None) -> DataFrame:
    return (rows if kind is None else rows.where(kind)).orderBy(F.col(created).desc_nulls_last(), F.col(key))


def merged(lists: Sequence[DataFrame], created: str) -> DataFrame:
    out = lists[0]
    for x in lists[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out.orderBy(F.col(created).desc_nulls_last())


def with_captions(files: DataFrame, captions: DataFrame, keys: Sequence[str]) -> DataFrame:
    return files.join(captions, list(keys), "left")


def first_healthy(replicas: DataFrame, group: str, healthy: str, primary: str, order: str) -> DataFrame:
    """The replica each group uses: the first healthy primary, else the first healthy one; a group without any has null."""
    rank = F.when(F.col(healthy), F.struct((~F.col(primary)).alias("p"), F.col(order).alias("o")))
    return replicas.groupBy(group).agg(F.min(rank).alias("r")).select(group, F.col("r.o").alias("chosen"))
