"""Group-normalized rewards and win counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def advantage(rows: DataFrame, group: str, reward: str, epsilon: float = 1e-4) -> DataFrame:
    """Adds advantage: the reward's distance from its group's mean over its population deviation."""
    w = W.partitionBy(group)
    return rows.withColumn("advantage", (F.col(reward) - F.avg(reward).over(w)) / (F.stddev_pop(reward).over(w) + epsilon))


def clipped(advantage: Column, most: float, mode: str = "all") -> Column:
    """Advantage held to +-most, by mode, then mapped to 0..1."""
    a = F.greatest(F.least(advantage, F.lit(most)), F.lit(-most))
    a = {
        "all": a, "positive_only": F.greatest(a, F.lit(0.0)), "negative_only": F.least(a, F.lit(0.0)),
        "one_only": F.when(a > 0, 1.0).otherwise(0.0), "binary": F.signum(a),
    }[mode]
    return F.greatest(F.least(a / most / 2 + 0.5, F.lit(1.0)), F.lit(0.0))


def diagnostics(rows: DataFrame, group: str, reward: str, tops: Sequence[int] = (100, 75, 50, 25, 10)) -> DataFrame:
    """Mean group size, share of groups without spread, mean deviation, and mean of the groups' means of their top percents.

    A top percent starts at the interpolated quantile. Two aggregations share
    the shuffle on the group; the second joins only one row per group.
    """
    g = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.stddev_pop(reward).alias("_s"), F.percentile(reward, F.array(*[F.lit((100 - p) / 100) for p in tops])).alias("_q"))
    tops_of = rows.join(g, group).groupBy(group).agg(F.max("_n").alias("_n"), F.max("_s").alias("_s"), *[F.avg(F.when(F.col(reward) >= F.get("_q", i), F.col(reward))).alias(f"_t{p}") for i, p in enumerate(tops)])
    return tops_of.agg(F.avg("_n").alias("group_size"), F.avg(F.when(F.col("_s") == 0, 1.0).otherwise(0.0)).alias("zero_std_ratio"), F.avg("_s").alias("std_mean"), *[F.avg(f"_t{p}").alias(f"mean_top_{p}") for p in tops])


def masked_mean(rows: DataFrame, valid: Column, rewards: Sequence[str]) -> DataFrame:
    return rows.agg(F.count_if(valid).alias("n_valid"), *[F.avg(F.when(valid, F.col(r))).alias(f"{r}_mean") for r in rewards])


def win_rate(rows: DataFrame, keys: Sequence[str], verdict: str) -> DataFrame:
    """wins, losses, ties and the rate without ties; null if nothing is decided."""
    v = F.col(verdict)
    g = rows.groupBy(*keys).agg(F.count_if(v == "win").alias("wins"), F.count_if(v == "loss").alias("losses"), F.count_if(v == "tie").alias("ties"))
    return g.withColumn("rate", F.when(F.col("wins") + F.col("losses") > 0, F.col("wins") / (F.col("wins") + F.col("losses"))))


def majority(rows: DataFrame, keys: Sequence[str], vote: str) -> DataFrame:
    """The verdict of several votes: more wins than losses wins, fewer loses, else a tie."""
    v = F.col(vote)
    d = F.count_if(v == "win") - F.count_if(v == "loss")
    return rows.groupBy(*keys).agg(F.when(d > 0, "win").when(d < 0, "loss").otherwise("tie").alias("verdict"))
