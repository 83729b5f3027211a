"""Queries of the evaluation metrics, series, latency summaries and rewards.

embeddings stand for frames (clip: label, frame: vec_id), events for series of
measurements, lineitem for rewards and boxes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.operators import metrics, rewards, series
from frameloom.plans.tables import table


def _e(spark, d):
    return table(spark, d, "embeddings")


def _pairs(spark, d):
    """vec_id, label, a, b: each vector with the one of the next number."""
    e = _e(spark, d)
    return e.select("vec_id", "label", F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id")


def _ev(spark, d):
    return table(spark, d, "events")


K = ["user_id", "event_type"]
O = ["ts", "event_id"]


def psnr_pairs(spark: SparkSession, d: str) -> DataFrame:
    return metrics.mean_score(_pairs(spark, d), ["label"], metrics.psnr(F.col("a"), F.col("b")))


def frame_mse_rounded(spark: SparkSession, d: str) -> DataFrame:
    return metrics.mean_score(_pairs(spark, d), ["label"], F.floor(metrics.mse(F.col("a"), F.col("b")) * 10000) / 10000)


def ssim_self(spark: SparkSession, d: str) -> DataFrame:
    return _e(spark, d).select("vec_id", F.round(metrics.ssim(8)(F.col("embedding"), F.col("embedding")), 9).alias("score"))


def ssim_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("vec_id", metrics.ssim(8)(F.col("a"), F.col("b")).alias("score"))


def kl_softmax(spark: SparkSession, d: str) -> DataFrame:
    return metrics.collect_windows(_pairs(spark, d), ["label"], metrics.kl_softmax(F.col("a"), F.col("b")), "max")


def kl_sigmoid(spark: SparkSession, d: str) -> DataFrame:
    return metrics.collect_windows(_pairs(spark, d), ["label"], metrics.kl_sigmoid(F.col("a"), F.col("b")))


def desync_grid(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("vec_id", metrics.desync(F.slice("a", 1, 21), F.slice("b", 1, 21), F.col("vec_id") % 30).alias("score"))


def embedding_cosine(spark: SparkSession, d: str) -> DataFrame:
    return metrics.mean_score(_pairs(spark, d), ["label"], series.cosine(F.col("a"), F.col("b")))


def unit_dot(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("vec_id", (series.dot(F.col("a"), F.col("b")) / (series.norm(F.col("a")) * series.norm(F.col("b")))).alias("score"))


def consistency_score(spark: SparkSession, d: str) -> DataFrame:
    return series.consistency(_e(spark, d), ["label"], ["vec_id"], "embedding")


def frechet_halves(spark: SparkSession, d: str) -> DataFrame:
    return metrics.frechet(_e(spark, d).withColumn("side", F.when(F.col("vec_id") % 2 == 0, "gen").otherwise("ref")), "side", "embedding", "gen", "ref")


def moment_sums(spark: SparkSession, d: str) -> DataFrame:
    return metrics.moments(_e(spark, d).withColumn("side", F.col("label").cast("string")), "side", "embedding").where("i < 64").select("side", "i", F.round("x", 6).alias("x"))


def moment_sums_all(spark: SparkSession, d: str) -> DataFrame:
    """Number of rows, sums and sums of products; moment_sums has no products."""
    return metrics.moments(_e(spark, d).withColumn("side", F.col("label").cast("string")), "side", "embedding")


def wer_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "prompt_splits")
    q = p.select((F.col("row_id") - 1).alias("row_id"), F.col("caption").alias("h"))
    return p.join(q, "row_id").select("row_id", metrics.wer(F.col("h"), F.col("caption")).alias("score"))


def mask_iou(spark: SparkSession, d: str) -> DataFrame:
    return metrics.mean_score(_pairs(spark, d), ["label"], metrics.frame_iou(F.col("a"), F.col("b")))


def mask_spatial(spark: SparkSession, d: str) -> DataFrame:
    pos = lambda c: F.transform(c, lambda x: F.greatest(x.cast("double"), F.lit(0.0)))
    return metrics.spatial_masks(_pairs(spark, d).select("label", pos("a").alias("a"), pos("b").alias("b")), ["label"], "a", "b")


def pooled_score(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    fr = li.select((F.col("l_discount")).alias("mse"), (F.col("l_tax") + 0.1).alias("st"), (F.col("l_discount") / 2).alias("pv_mse"), F.lit(0.5).alias("pv_st"))
    vi = li.groupBy("l_orderkey").agg(F.avg("l_tax").alias("s"), F.avg("l_discount").alias("ws")).select("s", "ws", F.lit(0.4).alias("pv_s"), F.lit(0.3).alias("pv_ws"))
    return metrics.pooled_score(fr, vi)


def box_relation(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    q, t = F.col("l_quantity"), F.col("l_tax") * 100
    box = lambda x, y: F.array(x, y, x + 10, y + 10)
    rel = F.when(F.col("l_linenumber") % 3 == 0, "on the left of").when(F.col("l_linenumber") % 3 == 1, "on the top of").otherwise("inside")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", metrics.position_score(rel, box(q, t), box(t, q)).alias("score"))


def color_share(spark: SparkSession, d: str) -> DataFrame:
    return metrics.share_of_frames(_ev(spark, d), ["user_id"], F.col("value") > 200, F.col("event_type") != "error")


def object_share(spark: SparkSession, d: str) -> DataFrame:
    return metrics.share_of_frames(_ev(spark, d), ["user_id"], F.col("event_type") == "click")


def both_objects(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "story_presets")
    return p.select("preset_no", metrics.both_objects(F.split("label", " "), F.when(F.col("preset_no") % 2 == 0, F.regexp_replace("label", " ", " and ")).otherwise(F.col("label"))).alias("both"))


def keyword_all_match(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prompt_splits").select("row_id", metrics.all_keywords(F.col("caption"), F.array(F.lit("light"), F.lit("The"))).alias("score"))


def action_in_top(spark: SparkSession, d: str) -> DataFrame:
    labels = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: i.cast("string"))
    return _e(spark, d).select("vec_id", metrics.in_top(labels, F.col("embedding"), (F.col("vec_id") % 64 + 1).cast("string")).alias("hit"))


def dynamic_clips(spark: SparkSession, d: str) -> DataFrame:
    return metrics.dynamic(_ev(spark, d), ["user_id"], "value", 480, 832)


def adjacent_mae(spark: SparkSession, d: str) -> DataFrame:
    x = series.adjacent_difference(_ev(spark, d), K, O, "value")
    return x.groupBy(*K).agg(F.coalesce(metrics.closeness(F.avg("diff")), F.lit(1.0)).alias("score"))


def aesthetic_mean(spark: SparkSession, d: str) -> DataFrame:
    return metrics.mean_score(_ev(spark, d), ["user_id"], F.when(F.col("event_type") != "error", F.col("value") / 10))


def flow_frames(spark: SparkSession, d: str) -> DataFrame:
    return metrics.flow_frames(_pairs(spark, d).select("vec_id", F.col("a").alias("u"), F.reverse("a").alias("v"), F.col("b").alias("gu"), F.reverse("b").alias("gv")), "vec_id", 8)


def flow_kl(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return metrics.flow_histogram_kl(li.select("l_returnflag", (F.col("l_quantity") - 25).alias("u"), (F.col("l_tax") * 300 - 10.3).alias("v"), (F.col("l_discount") * 300 - 12.7).alias("gu"), (F.col("l_quantity") - 30.5).alias("gv")), ["l_returnflag"])


def series_auc(spark: SparkSession, d: str) -> DataFrame:
    return series.summary(_ev(spark, d), K, O, "value")


def divergence_onset(spark: SparkSession, d: str) -> DataFrame:
    return series.divergence_onset(_ev(spark, d), K, O, "value")


def running_average(spark: SparkSession, d: str) -> DataFrame:
    return _e(spark, d).select("vec_id", series.running_average(F.slice("embedding", 1, 2), 0.25).alias("avg"))


def running_average_all(spark: SparkSession, d: str) -> DataFrame:
    """Over the whole array; running_average has its first two values."""
    return _e(spark, d).select("vec_id", series.running_average(F.col("embedding"), 0.25).alias("avg"))


def health_islands(spark: SparkSession, d: str) -> DataFrame:
    return series.health(_ev(spark, d), ["user_id"], O, F.col("event_type").isin("click", "view")).select("event_id", "run")


def health_states(spark: SparkSession, d: str) -> DataFrame:
    return series.health(_ev(spark, d), ["user_id"], O, F.col("event_type").isin("click", "view")).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def _sec():
    return F.unix_micros(F.col("ts").cast("timestamp")) / 1e6


def inter_arrival(spark: SparkSession, d: str) -> DataFrame:
    return series.gaps(_ev(spark, d), ["user_id"], O, _sec()).select("event_id", F.round("gap_ms", 3).alias("gap_ms"))


def serving_metrics(spark: SparkSession, d: str) -> DataFrame:
    return series.serving(_ev(spark, d).withColumn("mem", F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(F.col("value") * 2)), F.col("event_type") != "error", "value", "mem", 60.0)


def series_summary(spark: SparkSession, d: str) -> DataFrame:
    return series.percentiles(_ev(spark, d), ["event_type"], "value")


def session_goodput(spark: SparkSession, d: str) -> DataFrame:
    return series.goodput(_ev(spark, d), ["user_id"], _sec(), "value").select("user_id", F.round("bytes", 4).alias("bytes"), F.round("mbps", 12).alias("mbps"))


def bucket_throughput(spark: SparkSession, d: str) -> DataFrame:
    return series.buckets(_ev(spark, d), "ts", "value")


def session_summary(spark: SparkSession, d: str) -> DataFrame:
    e = _ev(spark, d).withColumns({"status": F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "success").when(F.col("event_type") == "view", "timeout"), "early": F.when(F.col("event_id") % 2 == 0, F.col("value") > 50)})
    return series.session_summary(e, "status", "value", "early", 300.0)


def median_by_batch(spark: SparkSession, d: str) -> DataFrame:
    return series.median_by_group(table(spark, d, "lineitem"), "l_partkey", "l_quantity")


def top_mean(spark: SparkSession, d: str) -> DataFrame:
    return series.top_mean(_ev(spark, d), ["event_type"], "value", 0.05)


def group_advantage(spark: SparkSession, d: str) -> DataFrame:
    x = rewards.advantage(table(spark, d, "lineitem"), "l_partkey", "l_quantity")
    a = F.col("advantage")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", *[F.round(rewards.clipped(a, 1.5, m), 7).alias(m) for m in ("all", "positive_only", "negative_only", "one_only")], F.round("advantage", 7).alias("advantage"))


def top_pct_means(spark: SparkSession, d: str) -> DataFrame:
    return rewards.diagnostics(table(spark, d, "lineitem"), "l_partkey", "l_quantity")


def masked_rewards(spark: SparkSession, d: str) -> DataFrame:
    return rewards.masked_mean(table(spark, d, "lineitem"), F.col("l_returnflag") != "R", ["l_quantity", "l_tax"])


def _verdict():
    return F.when(F.col("event_type") == "click", "win").when(F.col("event_type") == "error", "loss").otherwise("tie")


def win_rate(spark: SparkSession, d: str) -> DataFrame:
    return rewards.win_rate(_ev(spark, d).withColumn("v", _verdict()), ["user_id"], "v")


def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    return rewards.majority(_ev(spark, d).withColumn("v", _verdict()), ["user_id"], "v")


def metric_names(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(m.name, m.higher_is_better, m.needs_reference, m.corpus) for m in metrics.resolve(["vbench.scene", "physics_iq", "all"])], "name string, higher_is_better boolean, needs_reference boolean, corpus boolean")


QUERIES = {f.__name__: f for f in (
    psnr_pairs, frame_mse_rounded, ssim_self, ssim_pairs, kl_softmax, kl_sigmoid, desync_grid, embedding_cosine, unit_dot, consistency_score, frechet_halves, moment_sums, moment_sums_all,
    wer_pairs, mask_iou, mask_spatial, pooled_score, box_relation, color_share, object_share, both_objects, keyword_all_match, action_in_top, dynamic_clips, adjacent_mae,
    aesthetic_mean, flow_frames, flow_kl, series_auc, divergence_onset, running_average, running_average_all, health_islands, health_states, inter_arrival, serving_metrics, series_summary,
    session_goodput, bucket_throughput, session_summary, median_by_batch, top_mean, group_advantage, top_pct_means, masked_rewards, win_rate, majority_vote, metric_names,
)}

_P = "(SELECT x.vec_id, x.label, CAST(x.embedding AS DOUBLE[]) AS a, CAST(y.embedding AS DOUBLE[]) AS b FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1)"
_Z = "list_zip(a, b)"
_MSE = f"list_avg(list_transform({_Z}, lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
_LS = "list_transform({0}, lambda v: v - list_max({0}) - ln(list_sum(list_transform({0}, lambda w: exp(w - list_max({0}))))))"
_W = "PARTITION BY user_id, event_type ORDER BY ts, event_id"
_GRID = "(-2.0 + (list_position({0}[1:21], list_max({0}[1:21])) - 1) * 0.2)"
ORACLES = {
    "psnr_pairs": f"SELECT label, avg(10 * log10(1 / greatest({_MSE}, 1e-10))) AS score FROM {_P} GROUP BY label",
    "frame_mse_rounded": f"SELECT label, avg(floor({_MSE} * 10000) / 10000) AS score FROM {_P} GROUP BY label",
    "ssim_self": "SELECT vec_id, CAST(1 AS DOUBLE) AS score FROM embeddings",
    "kl_softmax": f"SELECT label, max(s) AS score FROM (SELECT label, list_sum(list_transform(list_zip(p, t), lambda z: exp(z[2]) * (z[2] - z[1]))) AS s FROM (SELECT label, {_LS.format('a')} AS p, {_LS.format('b')} AS t FROM {_P})) GROUP BY label",
    "kl_sigmoid": f"SELECT label, avg(list_sum(list_transform({_Z}, lambda z: 1 / (1 + exp(-z[2])) * (-ln(1 + exp(-z[2])) + ln(1 + exp(-z[1])))))) AS score FROM {_P} GROUP BY label",
    "desync_grid": f"SELECT vec_id, CASE WHEN vec_id % 30 >= 14 THEN (abs({_GRID.format('a')}) + abs({_GRID.format('b')})) / 2 END AS score FROM {_P}",
    "embedding_cosine": f"SELECT label, avg(list_cosine_similarity(a, b)) AS score FROM {_P} GROUP BY label",
    "unit_dot": f"SELECT vec_id, list_cosine_similarity(a, b) AS score FROM {_P}",
    "consistency_score": """SELECT label, avg((greatest(list_cosine_similarity(p, e), 0) + greatest(list_cosine_similarity(f, e), 0)) / 2) AS score FROM (SELECT label, CAST(embedding AS DOUBLE[]) AS e,
      lag(CAST(embedding AS DOUBLE[])) OVER w AS p, first_value(CAST(embedding AS DOUBLE[])) OVER w AS f FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id)) WHERE p IS NOT NULL GROUP BY label""",
    "moment_sums": """SELECT CAST(label AS STRING) AS side, i - 1 AS i, round(sum(x), 6) AS x FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY ALL
      UNION ALL SELECT CAST(label AS STRING), -1, CAST(count(*) AS DOUBLE) FROM embeddings GROUP BY label""",
    "moment_sums_all": """WITH v AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(64)) AS i FROM embeddings)
      SELECT CAST(label AS STRING) AS side, i, sum(x) AS x FROM v GROUP BY ALL UNION ALL SELECT CAST(label AS STRING), -1, CAST(count(*) AS DOUBLE) FROM embeddings GROUP BY label
      UNION ALL SELECT CAST(v.label AS STRING), 64 + v.i * 64 + w.i, sum(v.x * w.x) FROM v JOIN v w USING (vec_id) GROUP BY ALL""",
    "mask_iou": f"SELECT label, avg(CASE WHEN u > 0 THEN i / u ELSE 1 END) AS score FROM (SELECT label, len(list_filter({_Z}, lambda z: z[1] > 0 AND z[2] > 0)) AS i, len(list_filter({_Z}, lambda z: z[1] > 0 OR z[2] > 0)) AS u FROM {_P}) GROUP BY label",
    "mask_spatial": f"""SELECT label, CASE WHEN count(*) FILTER (WHERE ma OR mb) > 0 THEN count(*) FILTER (WHERE ma AND mb) / count(*) FILTER (WHERE ma OR mb) ELSE 1 END AS spatial_iou, CASE WHEN sum(greatest(wa, wb)) > 0 THEN sum(least(wa, wb)) / sum(greatest(wa, wb)) ELSE 1 END AS weighted_iou FROM (
      SELECT label, p, bool_or(x > 0) AS ma, bool_or(y > 0) AS mb, avg(greatest(x, 0)) AS wa, avg(greatest(y, 0)) AS wb FROM (SELECT label, unnest(a) AS x, unnest(b) AS y, unnest(range(64)) AS p FROM {_P}) GROUP BY label, p) GROUP BY label""",
    "pooled_score": """SELECT *, greatest(least(100 * ((st / pv_st + s / pv_s + ws / pv_ws) / 3 - (mse - pv_mse)), 100), 0) AS score FROM (SELECT avg(l_discount) AS mse, avg(l_tax + 0.1) AS st, avg(l_discount / 2) AS pv_mse, CAST(0.5 AS DOUBLE) AS pv_st FROM lineitem),
      (SELECT avg(t) AS s, avg(x) AS ws, CAST(0.4 AS DOUBLE) AS pv_s, CAST(0.3 AS DOUBLE) AS pv_ws FROM (SELECT avg(l_tax) AS t, avg(l_discount) AS x FROM lineitem GROUP BY l_orderkey))""",
    "box_relation": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN q = t OR l_linenumber % 3 = 2 THEN 0 WHEN l_linenumber % 3 IN (0, 1) AND abs(q - t) > abs(t - q) THEN 1 ELSE 0 END AS DOUBLE) AS score FROM (SELECT *, l_quantity AS q, l_tax * 100 AS t FROM lineitem)""",
    "color_share": "SELECT user_id, avg(CASE WHEN event_type <> 'error' THEN CASE WHEN value > 200 THEN 1.0 ELSE 0.0 END END) AS score FROM events GROUP BY 1",
    "object_share": "SELECT user_id, avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) AS score FROM events GROUP BY 1",
    "both_objects": "SELECT preset_no, CASE WHEN preset_no % 2 = 0 AND len(string_split(label, ' ')) = 2 THEN true END AS both FROM story_presets",
    "keyword_all_match": "SELECT row_id, CAST(CASE WHEN caption IS NULL THEN NULL WHEN contains(lower(caption), 'light') AND contains(lower(caption), 'the') THEN 1 ELSE 0 END AS DOUBLE) AS score FROM prompt_splits",
    "action_in_top": "SELECT vec_id, len(list_filter(embedding, lambda x: x > embedding[vec_id % 64 + 1])) < 5 AS hit FROM embeddings",
    "dynamic_clips": "SELECT user_id, count(*) FILTER (WHERE value > 11.25) >= round(4 * count(*) / 16) AS dynamic FROM events GROUP BY 1",
    "adjacent_mae": f"SELECT user_id, event_type, coalesce((255 - avg(diff)) / 255, 1) AS score FROM (SELECT *, abs(value - lag(value) OVER ({_W})) AS diff FROM events) GROUP BY 1, 2",
    "aesthetic_mean": "SELECT user_id, avg(value / 10) FILTER (WHERE event_type <> 'error') AS score FROM events GROUP BY 1",
    "series_auc": f"SELECT user_id, event_type, count(value) AS n, avg(value) AS mean, stddev_pop(value) AS std, max(value) AS max, coalesce(sum((value + p) / 2), 0) / greatest(count(value) - 1, 1) AS auc FROM (SELECT *, lag(value) OVER ({_W}) AS p FROM events) GROUP BY 1, 2",
    "divergence_onset": f"""WITH x AS (SELECT *, row_number() OVER ({_W}) - 1 AS i, count(*) OVER (PARTITION BY user_id, event_type) AS n, avg(value) OVER ({_W} ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS m FROM events),
      b AS (SELECT user_id, event_type, greatest(median(value) * 2, 1) AS threshold FROM x WHERE i < least(5, n) GROUP BY 1, 2)
      SELECT user_id, event_type, any_value(threshold) AS threshold, min(i) FILTER (WHERE m > threshold) AS onset FROM x JOIN b USING (user_id, event_type) WHERE i + least(5, n) <= n GROUP BY 1, 2""",
    "running_average": "SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 0.75 + CAST(embedding[2] AS DOUBLE) * 0.25 AS avg FROM embeddings",
    "running_average_all": "SELECT vec_id, list_reduce(CAST(embedding AS DOUBLE[]), lambda s, v: s * 0.75 + v * 0.25) AS avg FROM embeddings",
    "health_islands": """SELECT event_id, row_number() OVER (PARTITION BY user_id, ok, i - j ORDER BY ts, event_id) AS run FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i,
      row_number() OVER (PARTITION BY user_id, ok ORDER BY ts, event_id) AS j FROM (SELECT *, event_type IN ('click', 'view') AS ok FROM events))""",
    "inter_arrival": "SELECT event_id, round((epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts, event_id)) * 1000, 3) AS gap_ms FROM events",
    "serving_metrics": """SELECT count(l) AS completed, count(*) - count(l) AS failed, count(l) / 60.0 AS qps, avg(l) AS latency_mean, median(l) AS latency_median, quantile_cont(l, 0.99) AS latency_p99, quantile_cont(l, 0.5) AS latency_p50,
      max(m) AS memory_max, avg(m) AS memory_mean, median(m) AS memory_median FROM (SELECT CASE WHEN event_type <> 'error' THEN value END AS l, CASE WHEN event_id % 3 <> 0 AND value > 0 THEN value * 2 END AS m FROM events)""",
    "series_summary": "SELECT event_type, count(value) AS count, min(value) AS min, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99, max(value) AS max, avg(value) AS avg FROM events GROUP BY 1",
    "session_goodput": "SELECT user_id, round(b, 4) AS bytes, round(CASE WHEN d > 0 THEN b * 8 / d / 1e6 END, 12) AS mbps FROM (SELECT user_id, sum(value) AS b, max(epoch_us(ts) / 1e6) - min(epoch_us(ts) / 1e6) AS d FROM events WHERE value > 0 GROUP BY 1)",
    "bucket_throughput": "SELECT date_trunc('second', ts) AS start, sum(value) AS bytes, sum(value) * 8 / 1e6 AS mbps FROM events WHERE value > 0 GROUP BY 1",
    "session_summary": """SELECT count(*) AS total, count(*) FILTER (WHERE event_type = 'click') AS success, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type NOT IN ('click', 'error')) AS other,
      count(*) FILTER (WHERE value >= 300) AS breaches, avg(CASE WHEN event_id % 2 = 0 THEN CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END END) AS early_ratio FROM events""",
    "median_by_batch": "SELECT l_partkey, count(*) AS n, median(l_quantity) AS median FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "top_mean": "SELECT event_type, avg(value) AS top_mean FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE r <= greatest(1, floor(n * 0.05)) GROUP BY 1",
    "group_advantage": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, round((greatest(least(a, 1.5), -1.5)) / 1.5 / 2 + 0.5, 7) AS "all", round(greatest(least(a, 1.5), 0) / 1.5 / 2 + 0.5, 7) AS positive_only,
      round(greatest(least(a, 0), -1.5) / 1.5 / 2 + 0.5, 7) AS negative_only, round(least(CASE WHEN a > 0 THEN 1.0 ELSE 0.0 END / 1.5 / 2 + 0.5, 1), 7) AS one_only, round(a, 7) AS advantage FROM
      (SELECT *, (l_quantity - avg(l_quantity) OVER w) / (stddev_pop(l_quantity) OVER w + 1e-4) AS a FROM lineitem WINDOW w AS (PARTITION BY l_partkey))""",
    "top_pct_means": """WITH g AS (SELECT l_partkey, count(*) AS n, stddev_pop(l_quantity) AS s, quantile_cont(l_quantity, [0.0, 0.25, 0.5, 0.75, 0.9]) AS q FROM lineitem GROUP BY 1),
      t AS (SELECT l_partkey, any_value(n) AS n, any_value(s) AS s, avg(l_quantity) AS t1, avg(l_quantity) FILTER (WHERE l_quantity >= q[2]) AS t2, avg(l_quantity) FILTER (WHERE l_quantity >= q[3]) AS t3, avg(l_quantity) FILTER (WHERE l_quantity >= q[4]) AS t4, avg(l_quantity) FILTER (WHERE l_quantity >= q[5]) AS t5 FROM lineitem JOIN g USING (l_partkey) GROUP BY 1)
      SELECT avg(n) AS group_size, avg(CASE WHEN s = 0 THEN 1.0 ELSE 0.0 END) AS zero_std_ratio, avg(s) AS std_mean, avg(t1) AS mean_top_100, avg(t2) AS mean_top_75, avg(t3) AS mean_top_50, avg(t4) AS mean_top_25, avg(t5) AS mean_top_10 FROM t""",
    "masked_rewards": "SELECT count(*) AS n_valid, avg(l_quantity) AS l_quantity_mean, avg(l_tax) AS l_tax_mean FROM lineitem WHERE l_returnflag <> 'R'",
    "win_rate": "SELECT user_id, w AS wins, l AS losses, n - w - l AS ties, CASE WHEN w + l > 0 THEN w / (w + l) END AS rate FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS w, count(*) FILTER (WHERE event_type = 'error') AS l, count(*) AS n FROM events GROUP BY 1)",
    "majority_vote": "SELECT user_id, CASE WHEN w > l THEN 'win' WHEN w < l THEN 'loss' ELSE 'tie' END AS verdict FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS w, count(*) FILTER (WHERE event_type = 'error') AS l FROM events GROUP BY 1)",
}
