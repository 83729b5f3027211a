"""Column profiles from persistent value-count tables with signed deltas.

The state is one table (load, column, value, number): each load adds its
counts, a withdrawn load adds them negated, and counts that reach zero vanish.
Every metric - null rate, distinct count, range, violations, entropy, median -
is exact and derived from the counts, never from the data again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from frameloom.session import hadoop_path

STATE = "load_id bigint, column_name string, is_null boolean, value string, num double, n bigint"
KEYS = ["load_id", "column_name", "is_null", "value", "num"]
#: Boundaries per column that cut the values into buckets for the medians.
CUTS = 63


def _entry(f: T.StructField) -> Column:
    """is_null, value, num of one column. Numbers count as doubles; longer values by hash and length."""
    c = F.col(f"`{f.name}`")
    t = f.dataType
    if isinstance(t, T.NumericType):
        value, num = F.lit(None).cast("string"), c.cast("double") + F.lit(0.0)
    elif isinstance(t, T.StringType):
        value, num = F.when(F.length(c) <= 64, c).otherwise(F.concat(F.lit("sha256:"), F.sha2(c, 256))), F.length(c).cast("double")
    elif isinstance(t, T.BinaryType):
        value, num = F.sha2(c, 256), F.length(c).cast("double")
    elif isinstance(t, T.ArrayType):
        s = F.to_json(c)
        value, num = F.when(F.length(s) <= 64, s).otherwise(F.sha2(s, 256)), F.size(c).cast("double")
    else:
        value, num = c.cast("string"), F.lit(None).cast("double")
    return F.struct(F.lit(f.name).alias("column_name"), c.isNull().alias("is_null"), value.alias("value"), num.alias("num"))


def delta(df: DataFrame, load: str, columns: Sequence[str] | None = None, sign: int = 1) -> DataFrame:
    """Signed value counts of ``df``: what its loads add to (or, at sign -1, take from) the state.

    Counted per row group on the map side, so a value that fills a third of a
    column is one row per task. A null load is a load of its own. NaN is one
    value, and negative zero is zero. An empty frame gives an empty delta.
    """
    fields = [f for f in df.schema.fields if (f.name in columns if columns is not None else f.name != load)]
    long = df.select(F.col(f"`{load}`").cast("bigint").alias("load_id"), F.explode(F.array(*[_entry(f) for f in fields])).alias("e"))
    return long.select("load_id", "e.*").groupBy(*KEYS).agg((F.count(F.lit(1)) * sign).alias("n"))


def apply_delta(state: DataFrame, change: DataFrame) -> DataFrame:
    """The state after a signed change; values whose count is zero are gone."""
    return state.unionByName(change).groupBy(*KEYS).agg(F.sum("n").alias("n")).where("n <> 0")


class CountStore:
    """The persistent state: numbered versions in a folder; the newest complete one holds.

    A version is written beside the old ones and counts only once its success
    marker stands, so a lost job leaves the state as it was.
    """

    def __init__(self, spark: SparkSession, path: str, partitions: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self) -> list[int]:
        fs, p = hadoop_path(self.spark, self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        made = [int(n[2:]) for n in names if n.startswith("v=")]
        return sorted(v for v in made if fs.exists(hadoop_path(self.spark, f"{self.path}/v={v}/_SUCCESS")[1]))

    def read(self) -> DataFrame:
        v = self._versions()
        if not v:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.path}/v={v[-1]}")

    def apply(self, change: DataFrame) -> DataFrame:
        v = self._versions()
        new = apply_delta(self.read(), change) if v else change
        new.write.mode("overwrite").parquet(f"{self.path}/v={(v[-1] if v else 0) + 1}")
        return self.read()


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def profile(state: DataFrame) -> DataFrame:
    """Per load and column: rows, nulls, distinct, least, greatest, entropy (bits), violations.

    least and greatest are of the finite numbers (of the lengths for strings,
    bytes and lists). A violation is a number that is zero, negative, NaN or
    infinite, or an empty string, byte string or list.
    """
    v = ~F.col("is_null")
    num = F.col("num")
    n = F.col("n")
    bad = v & (F.isnan(num) | ~_finite(num) | (num <= 0)) & num.isNotNull()
    total = F.sum(F.when(v, n).otherwise(0))
    return (
        state.groupBy("load_id", "column_name")
        .agg(
            F.sum(n).alias("n_rows"),
            F.sum(F.when(v, 0).otherwise(n)).alias("n_null"),
            F.count(F.when(v, 1)).alias("n_distinct"),
            F.min(F.when(v & _finite(num), num)).alias("least"),
            F.max(F.when(v & _finite(num), num)).alias("greatest"),
            F.sum(F.when(bad, n).otherwise(0)).alias("n_violations"),
            F.when(total > 0, F.log2(total) - F.sum(F.when(v, n * F.log2(n)).otherwise(0.0)) / total).alias("entropy"),
        )
    )


def medians(state: DataFrame) -> DataFrame:
    """Exact medians of the finite numbers of each load and of all other loads together.

    load_id, column_name, own, others (null where there is no finite number).
    The values of a column are cut into buckets of about equal numbers of
    values; the bucket that holds the middle follows from the buckets' counts
    (others = all - own), and only that bucket's values are then looked at. No
    task sees a whole column.
    """
    fin = state.where(_finite(F.col("num"))).groupBy("load_id", "column_name", "num").agg(F.sum("n").alias("n"))
    cuts = (
        fin.groupBy("column_name", "num").agg(F.lit(1).alias("one")).groupBy("column_name")
        .agg(F.percentile_approx("num", F.array(*[F.lit((i + 1) / (CUTS + 1)) for i in range(CUTS)]), F.lit(2000)).alias("cuts"))
    )
    # One row of CUTS numbers per column: bounded by the width of the table.
    fin = fin.join(F.broadcast(cuts), "column_name").withColumn("b", F.size(F.filter("cuts", lambda x: x < F.col("num")))).drop("cuts")
    all_ = fin.groupBy("column_name", "b", "num").agg(F.sum("n").alias("n_all"))
    own_b = fin.groupBy("load_id", "column_name", "b").agg(F.sum("n").alias("n"))
    all_b = own_b.groupBy("column_name", "b").agg(F.sum("n").alias("n_all"))
    loads = state.select("load_id", "column_name").distinct()
    # loads x columns x buckets: counts only, whatever the number of values.
    grid = loads.alias("l").join(all_b, "column_name").join(
        own_b.withColumnsRenamed({"load_id": "o_load", "column_name": "o_col", "b": "o_b"}),
        F.col("load_id").eqNullSafe(F.col("o_load")) & (F.col("column_name") == F.col("o_col")) & (F.col("b") == F.col("o_b")), "left",
    ).select("load_id", "column_name", "b", F.coalesce("n", F.lit(0)).alias("n_own"), (F.col("n_all") - F.coalesce("n", F.lit(0))).alias("n_others"))
    sides = grid.select(
        "load_id", "column_name", "b",
        F.explode(F.array(F.struct(F.lit("own").alias("side"), F.col("n_own").alias("n")), F.struct(F.lit("others").alias("side"), F.col("n_others").alias("n")))).alias("s"),
    ).select("load_id", "column_name", "b", "s.*")
    w = W.partitionBy("load_id", "column_name", "side")
    ranked = sides.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("b").rowsBetween(W.unboundedPreceding, 0)))
    ranks = ranked.select("*", F.explode(F.array(F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1)).alias("r"))
    wanted = ranks.where("total > 0 AND r <= upto AND r > upto - n").select("load_id", "column_name", "side", "r", "b", (F.col("upto") - F.col("n")).alias("before")).distinct()
    # Values grow with the data: both joins on them sort and merge at every size, no side is ever broadcast.
    inside = wanted.join(all_.hint("merge"), ["column_name", "b"]).alias("x").join(
        fin.select(F.col("load_id").alias("o_load"), F.col("column_name").alias("o_col"), F.col("num").alias("o_num"), F.col("n").alias("o_n")).hint("merge"),
        F.col("load_id").eqNullSafe(F.col("o_load")) & (F.col("column_name") == F.col("o_col")) & (F.col("num") == F.col("o_num")), "left",
    )
    here = F.coalesce("o_n", F.lit(0))
    inside = inside.withColumn("m", F.when(F.col("side") == "own", here).otherwise(F.col("n_all") - here)).where("m > 0")
    run = inside.withColumn("cum", F.col("before") + F.sum("m").over(W.partitionBy("load_id", "column_name", "side", "r").orderBy("num").rowsBetween(W.unboundedPreceding, 0)))
    mid = run.where("cum >= r").groupBy("load_id", "column_name", "side", "r").agg(F.min("num").alias("v"))
    return mid.groupBy("load_id", "column_name").agg(
        F.avg(F.when(F.col("side") == "own", F.col("v"))).alias("own"), F.avg(F.when(F.col("side") == "others", F.col("v"))).alias("others")
    )


def shifted(state: DataFrame, null_gap: float = 0.2, ratio: float = 1.5, bad_share: float = 0.2, one_share: float = 0.8) -> DataFrame:
    """load_id, column_name of the loads in which a numeric column behaves unlike in the others.

    The state must hold numeric columns only. A load without other loads is
    judged by its own values only. A share of nothing is no share.
    """
    num, n, v = F.col("num"), F.col("n"), ~F.col("is_null")
    own = state.groupBy("load_id", "column_name").agg(
        F.sum(n).alias("rows"),
        F.sum(F.when(v, 0).otherwise(n)).alias("nulls"),
        F.sum(F.when(v & (~_finite(num) | (num <= 0)), n).otherwise(0)).alias("bad"),
        F.coalesce(F.max(F.when(v & ~F.isnan(num), n)), F.lit(0)).alias("top"),
    )
    total = own.groupBy("column_name").agg(F.sum("rows").alias("t_rows"), F.sum("nulls").alias("t_nulls"))
    m = medians(state).withColumnsRenamed({"load_id": "m_load", "column_name": "m_col"})
    j = own.join(total, "column_name").join(m, F.col("load_id").eqNullSafe(F.col("m_load")) & (F.col("column_name") == F.col("m_col")), "left")
    values = F.col("rows") - F.col("nulls")
    o_rows = F.col("t_rows") - F.col("rows")
    gap = F.when(o_rows > 0, F.abs(F.col("nulls") / F.col("rows") - (F.col("t_nulls") - F.col("nulls")) / o_rows) > null_gap)
    far = (F.col("own") > ratio * F.col("others")) | (F.col("own") < F.col("others") / ratio)
    case = [gap, far, F.when(values > 0, F.col("bad") / values > bad_share), F.when(values > 0, F.col("top") / values > one_share)]
    hit = F.lit(False)
    for c in case:
        hit = hit | F.coalesce(c, F.lit(False))
    return j.where(hit).select("load_id", "column_name")
