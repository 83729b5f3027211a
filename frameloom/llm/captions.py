"""Collapse of captions that differ only in how they are written.

Method: each caption becomes a multiset of normalized (field name, value)
pairs; the pairs are hashed and combined by addition modulo a prime, which is
commutative, so the order of fields needs no sort; captions are grouped by the
fingerprint, and equality of the fields is then verified pair by pair, again
without sorting. Everything but the verdict stays in JVM expressions.

Defined results: null captions and captions without a letter or digit are in
no group. A caption is labelled if all of it is labelled fields (a JSON object
whose keys are all labels, or label, ``:`` or ``=``, value, parted by ``;``,
``|`` or line breaks before a label); any other caption is its sequence of
letters and digits. A label that stands twice counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions.text import letters
from frameloom.operators.copies import label_copies
from frameloom.session import cut

#: The labels of labelled captions.
LABELS = ("subject", "action", "setting", "camera", "lighting", "style")
#: Fingerprints are sums modulo this prime: two lanes of 61 bits.
PRIME = (1 << 61) - 1
#: Multisets up to this size are compared by counting; longer ones by sorting, which counting would square.
COUNTED = 64


def with_fields(rows: DataFrame, caption: str, labels: Sequence[str] = LABELS) -> DataFrame:
    """``rows`` with ``pairs``: array<struct<label,value>> of a labelled caption, null for any other.

    Three projections, so that each expression is evaluated once; what a
    caption begins with decides whether any parsing is done at all.
    """
    any_label = "|".join(labels)
    c = F.col(caption)
    kind = F.when(c.rlike(r"^[\s\p{Z}]*\{"), F.when(c.rlike(r"\}[\s\p{Z}]*$"), 2)).when(c.rlike(rf"^[^\p{{L}}\p{{N}}]*(?i:{any_label})[^\p{{L}}\p{{N}};|\r\n:=]*[:=]"), 1)
    flat = F.lower(F.regexp_replace(c, r"[^\p{L}\p{N};|\r\n:=]+", " "))
    flat = F.regexp_replace(flat, r" ?[;|\r\n][ ;|\r\n]*", ";")
    flat = F.regexp_replace(flat, r"^[ ;]+|[ ;]+$", "")
    pieces = F.transform(
        F.split(flat, rf";(?=(?:{any_label}) ?[:=])"),
        lambda p: F.struct(F.regexp_extract(p, rf"^({any_label}) ?[:=]", 1).alias("key"), F.regexp_replace(p, r"^[^:=]*[:=]", "").alias("value")),
    )
    rows = rows.withColumn("_kind", kind)
    rows = rows.withColumn("_raw", F.when(F.col("_kind") == 2, F.map_entries(F.from_json(c, "map<string,string>"))).when(F.col("_kind") == 1, pieces))
    rows = rows.withColumn("_pairs", F.transform("_raw", lambda e: F.struct(letters(e["key"]).alias("label"), F.coalesce(letters(e["value"]), F.lit("")).alias("value"))))
    whole = (F.size("_pairs") > 0) & F.forall("_pairs", lambda e: e["label"].isin(*labels))
    return rows.withColumn("pairs", F.when(whole, F.col("_pairs"))).drop("_kind", "_raw", "_pairs")


def _lane(pairs: Column, seed: str) -> Column:
    term = lambda e: F.pmod(F.xxhash64(F.lit(seed), e["label"], e["value"]), F.lit(PRIME))
    return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda acc, e: (acc + term(e)) % F.lit(PRIME))


def normalized(rows: DataFrame, key: str, caption: str) -> DataFrame:
    """k, f1, f2, text, pairs of every caption that has a letter or digit."""
    base = rows.select(F.col(f"`{key}`").alias("k"), F.col(f"`{caption}`").alias("c")).where(F.col("c").rlike(r"[\p{L}\p{N}]"))
    base = with_fields(base, "c").withColumn("seq", F.when(F.col("pairs").isNull(), letters(F.col("c")))).drop("c")
    plain = F.col("pairs").isNull()
    return base.select(
        "k",
        F.when(plain, F.xxhash64(F.lit("text"), "seq")).otherwise(_lane(F.col("pairs"), "a")).alias("f1"),
        F.when(plain, F.xxhash64("seq", F.lit("again"))).otherwise(_lane(F.col("pairs"), "b")).alias("f2"),
        F.col("seq").alias("text"),
        "pairs",
    )


def _same(a: dict[str, Column], b: dict[str, Column]) -> Column:
    pa, pb = a["pairs"], b["pairs"]
    count = lambda xs, e: F.size(F.filter(xs, lambda y: y == e))
    counted = F.forall(pa, lambda e: count(pa, e) == count(pb, e))
    listed = F.when(F.size(pa) <= COUNTED, counted).otherwise(F.array_sort(pa) == F.array_sort(pb))
    return F.when(pa.isNull() | pb.isNull(), a["text"].eqNullSafe(b["text"]) & pa.isNull() & pb.isNull()).otherwise((F.size(pa) == F.size(pb)) & listed)


def found(spark: SparkSession, tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """table_name, keep_key, copy_key over tables given as name -> (rows, key, caption)."""
    parts = [normalized(df, key, cap).withColumn("table_name", F.lit(name)) for name, (df, key, cap) in tables.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = cut(spark, rows, "normalized")  # read twice below, parsed once
    return label_copies(
        spark, rows, ["table_name"], ["f1", "f2"], "k", ["text", "pairs"], _same,
        exact_key=lambda a: [F.coalesce(a["text"], F.to_json(F.array_sort(a["pairs"])))],
    )


def collapsed(spark: SparkSession, rows: DataFrame, key: str, caption: str, name: str = "rows") -> DataFrame:
    """One record per caption: its smallest key, the caption as written there, and n_copies with itself."""
    out = collapsed_tables(spark, {name: (rows, key, caption)})
    return out.select(F.col("keep_key").alias(key), F.col("caption").alias(caption), "n_copies")


def collapsed_tables(spark: SparkSession, tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """table_name, keep_key, caption, n_copies: :func:`collapsed` over tables given as in :func:`found`, each kept apart."""
    pairs = found(spark, tables)
    n = pairs.groupBy("table_name", "keep_key").agg(F.count(F.lit(1)).alias("_more"))
    lone = None
    for name, (df, key, cap) in tables.items():
        c = F.col(f"`{cap}`")
        part = df.where(c.rlike(r"[\p{L}\p{N}]")).select(F.lit(name).alias("table_name"), F.col(f"`{key}`").alias("keep_key"), c.alias("caption"))
        lone = part if lone is None else lone.unionByName(part)
    on = ["table_name", "keep_key"]
    return (
        lone.join(pairs.select("table_name", F.col("copy_key").alias("keep_key")), on, "left_anti").join(n, on, "left")
        .select(*on, "caption", (F.coalesce("_more", F.lit(0)) + 1).alias("n_copies"))
    )
