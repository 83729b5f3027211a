"""Joins by position, by derived key and by absence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameloom.operators.shards import positions


class CountMismatch(ValueError):
    """Two sides that must be equally long aren't."""


def zip_positions(left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str], strict: bool = False) -> DataFrame:
    """Row n of one side with row n of the other, as pos; strict refuses sides of unequal length."""
    if strict and (a := left.count()) != (b := right.count()):
        raise CountMismatch(f"{a} and {b} rows")
    return positions(left, left_order, "pos").join(positions(right, right_order, "pos"), "pos")


def zip_with_rest(generated: DataFrame, g_order: Sequence[str], reference: DataFrame, r_order: Sequence[str], key: str) -> DataFrame:
    """Pairs by position; references beyond the last generated row stand alone with role reference."""
    g, r = positions(generated, g_order, "pos"), positions(reference, r_order, "pos")
    return g.join(r, "pos", "full_outer").withColumn("role", F.when(F.col(key).isNull(), "reference").otherwise("sample"))


def unknown_references(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(known.select(*keys).distinct(), list(keys), "left_anti")


def paired_takes(rows: DataFrame, key: Sequence[str], take: str, order: Column, payload: str) -> DataFrame:
    """First and second take of each key; of several, the last by ``order`` counts. A key with one take only is left to unpaired()."""
    last = rows.where(F.col(take).isin(1, 2)).groupBy(*key).agg(
        F.max_by(F.when(F.col(take) == 1, F.col(payload)), F.when(F.col(take) == 1, order)).alias("take_1"),
        F.max_by(F.when(F.col(take) == 2, F.col(payload)), F.when(F.col(take) == 2, order)).alias("take_2"),
    )
    return last.where("take_1 IS NOT NULL AND take_2 IS NOT NULL")


def unpaired(rows: DataFrame, key: Sequence[str], take: str) -> DataFrame:
    return rows.where(F.col(take).isin(1, 2)).groupBy(*key).agg(F.countDistinct(take).alias("n_takes")).where("n_takes < 2").drop("n_takes")


def present_in_all(listings: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys that stand in every listing, once each."""
    out = listings[0].select(key).distinct()
    for x in listings[1:]:
        out = out.join(x.select(key).distinct(), key)
    return out


def renamed(key: Column, prefix: str, to: str) -> Column:
    return F.when(key.startswith(prefix), F.concat(F.lit(to), F.substring(key, F.lit(len(prefix) + 1), F.length(key)))).otherwise(key)
