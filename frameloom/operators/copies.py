"""Labelling of equal records without sorting and without collecting a group.

One narrow aggregation finds the fingerprints that occur more than once; only
then the payload of those rows meets the payload of the kept row, and equality
is verified field by field. A group may hold any share of all rows: the
aggregation combines on the map side, and the verification join is salted by
the size of the group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.session import cut

#: Rows of one group that one task verifies; larger groups are spread over more tasks.
ROWS_PER_SALT = 100_000


def salted_join(rows: DataFrame, groups: DataFrame, by: Sequence[str], key: str, size: str, per: int = ROWS_PER_SALT) -> DataFrame:
    """``rows`` with their group's columns and ``_salt``: a group of more than ``per`` rows is joined in as many parts as it needs.

    groups has one row per key of ``by`` and the number of its rows in
    ``size``. At most total/per groups are that large, so the list of them,
    which is broadcast, stays tiny whatever the input; no part of a group sees
    more than about ``per`` rows.
    """
    parts = F.ceil(F.col(size) / per).cast("int")
    hot = groups.where(F.col(size) > per).select(*by, parts.alias("_salts"))
    salt = F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(key), F.col("_salts")).cast("int"))
    left = rows.join(F.broadcast(hot), list(by), "left").withColumn("_salt", salt).drop("_salts")
    return left.join(groups.withColumn("_salt", F.explode(_salts(size, per))), [*by, "_salt"])


def _salts(size: str, per: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.ceil(F.col(size) / per).cast("int") - 1, F.lit(0)))


def label_copies(
    spark: SparkSession,
    rows: DataFrame,
    scope: Sequence[str],
    fingerprint: Sequence[str],
    key: str,
    payload: Sequence[str],
    equal: Callable[[dict[str, Column], dict[str, Column]], Column],
    exact_key: Callable[[dict[str, Column]], Sequence[Column]],
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """One row per record that equals a record with a smaller key.

    rows        scope..., fingerprint..., key, payload...; the key is unique within the scope
    equal       whether two payloads are the same record
    exact_key   columns that are equal exactly for equal payloads; used only for
                rows whose fingerprint collided with a different record
    result      scope..., keep_key, copy_key

    Rows with equal fingerprints and unequal payloads are grouped again by the
    payload itself, so a collision neither joins nor loses records. An empty
    input gives an empty result.
    """
    by = [*scope, *fingerprint]
    groups = rows.groupBy(*by).agg(F.min(key).alias("_keep"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    members = salted_join(rows, groups, by, key, "_n", rows_per_salt)
    heads = members.where(F.col(key) == F.col("_keep")).select(*by, F.explode(_salts("_n", rows_per_salt)).alias("_salt"), *[F.col(p).alias(f"_k_{p}") for p in payload])
    same = equal({p: F.col(p) for p in payload}, {p: F.col(f"_k_{p}") for p in payload})
    verdict = members.join(heads, [*by, "_salt"]).where(F.col(key) != F.col("_keep")).select(
        *by, F.col("_keep").alias("keep_key"), F.col(key).alias("copy_key"), F.coalesce(same, F.lit(False)).alias("_same")
    )
    verdict = cut(spark, verdict, "copies")
    found = verdict.where("_same").select(*scope, "keep_key", "copy_key")
    if verdict.where("NOT _same").isEmpty():
        return found
    odd = verdict.where("NOT _same").select(*by, F.col("copy_key").alias(key)).join(rows, [*by, key])
    odd = odd.select(*scope, key, *[c.alias(f"_e{i}") for i, c in enumerate(exact_key({p: F.col(p) for p in payload}))])
    exact = [c for c in odd.columns if c.startswith("_e")]
    first = odd.groupBy(*scope, *exact).agg(F.min(key).alias("keep_key"))
    again = odd.join(first, [*scope, *exact]).where(F.col(key) != F.col("keep_key"))
    return found.unionByName(again.select(*scope, "keep_key", F.col(key).alias("copy_key")))
