"""Run-metric analytics: cohorts, baselines, regression gates, trends.

A run is one row with its identity columns, a timestamp, a commit, metrics and
flags. Every function takes and returns DataFrames; a baseline needs one
shuffle on the cohort, whatever the number of metrics.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Identity of a run of the second generation; all six present make the cohort.
IDENTITY = ("workload_id", "variant_id", "benchmark_version", "recipe_fingerprint", "hardware_profile_id", "software_profile_id")


@dataclass(frozen=True)
class Metric:
    """A gated measurement: regressed if worse by more than both floors."""

    name: str
    higher_is_better: bool
    percent: float
    absolute: float


#: Directions and floors of the metrics, in the order in which failures are listed.
METRICS = (
    Metric("latency", False, 8.0, 0.5),
    Metric("throughput", True, 8.0, 0.05),
    Metric("memory", False, 5.0, 256.0),
    Metric("text_encoder_time_s", False, 5.0, 0.25),
    Metric("dit_time_s", False, 5.0, 0.25),
    Metric("vae_decode_time_s", False, 5.0, 0.25),
)


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def cohort_key(runs: DataFrame) -> DataFrame:
    """``cohort``: 'v2' and the six identity values if none is blank, else 'legacy', model, gpu and the six. Zero isn't blank."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    full = ~_blank(F.col(IDENTITY[0]))
    for c in IDENTITY[1:]:
        full = full & ~_blank(F.col(c))
    six = [text(c) for c in IDENTITY]
    return runs.withColumn("cohort", F.when(full, F.concat_ws("|", F.lit("v2"), *six)).otherwise(F.concat_ws("|", F.lit("legacy"), text("model_id"), text("gpu_type"), *six)))


def normalize_source(c: Column) -> Column:
    s = F.lower(F.trim(c))
    return F.when(s.isin("pr", "local", "scheduled_main"), s).otherwise(F.lit("unknown"))


def detect_source(pull_request: Column, branch: Column, scheduled: Column, in_ci: Column) -> Column:
    """Decision table: a pull request, then a scheduled build of main, then any other build, then a local run."""
    has_pr = ~_blank(pull_request) & (F.lower(pull_request) != "false")
    return F.when(has_pr, "pr").when(scheduled & (branch == "main"), "scheduled_main").when(in_ci, "unknown").otherwise("local")


def eligible() -> Column:
    """Eligible for a baseline: flagged true; or from main by schedule; or with neither key present (which null isn't)."""
    flag, source = F.col("baseline_eligible"), normalize_source(F.col("run_source"))
    return (
        F.when(~F.col("has_baseline_eligible") & ~F.col("has_run_source"), True)
        .when(F.col("has_baseline_eligible"), F.coalesce(flag, F.lit(False)))
        .otherwise(source == "scheduled_main")
    )


def succeeded() -> Column:
    """True where the key is absent; an explicit null is a failure."""
    return F.when(~F.col("has_success"), True).otherwise(F.coalesce(F.col("success"), F.lit(False)))


def recent(runs: DataFrame, since: Column, ts: str = "ts") -> DataFrame:
    """Rows not older than ``since``; a row without a time stays."""
    return runs.where(F.col(ts).isNull() | (F.col(ts) >= since))


def same_identity(runs: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """Rows whose values equal the wanted ones as text; null compares as 'None'."""
    for c, v in wanted.items():
        runs = runs.where(F.coalesce(F.col(c).cast("string"), F.lit("None")) == F.lit(str(v)))
    return runs


def display_filter(runs: DataFrame, model: str | None = None, gpu: str | None = None, source: str | None = None, ok: bool | None = None) -> DataFrame:
    for c, v in (("model_id", model), ("gpu_type", gpu)):
        if v is not None:
            runs = runs.where(F.col(c) == v)
    if source is not None:
        runs = runs.where(normalize_source(F.col("run_source")) == source)
    return runs if ok is None else runs.where(F.col("success") == ok)


def delta_columns(latest: Column, baseline: Column, higher_is_better: bool, percent_floor: float, absolute_floor: float) -> list[Column]:
    """delta_abs, delta_pct (positive is worse; null without a positive baseline) and regressed."""
    worse = (baseline - latest) if higher_is_better else (latest - baseline)
    ok = latest.isNotNull() & (baseline > 0)
    pct = F.when(ok, worse / baseline * 100)
    return [
        F.when(ok, worse).alias("delta_abs"), pct.alias("delta_pct"),
        F.coalesce(ok & (pct > percent_floor) & (worse > absolute_floor), F.lit(False)).alias("regressed"),
    ]


def latest_vs_baseline(
    runs: DataFrame, cohort: Sequence[str], order: Sequence[str], metric: str, last_n: int = 5,
    higher_is_better: bool = False, percent_floor: float = 8.0, absolute_floor: float = 0.5,
) -> DataFrame:
    """The latest run of each cohort against the median of the ``last_n`` runs before it.

    One shuffle on the cohort serves the ranking and the aggregation: a framed
    median isn't allowed in a window, so ranked rows are folded by group.
    """
    w = W.partitionBy(*cohort).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    ranked = runs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= last_n + 1)
    g = ranked.groupBy(*cohort).agg(
        F.max(F.when(F.col("_rn") == 1, F.col(metric))).alias("latest"),
        F.count(F.when((F.col("_rn") > 1) & F.col(metric).isNotNull(), 1)).alias("baseline_n"),
        F.median(F.when(F.col("_rn") > 1, F.col(metric))).alias("baseline"),
    )
    return g.select(*cohort, "latest", "baseline_n", "baseline", *delta_columns(F.col("latest"), F.col("baseline"), higher_is_better, percent_floor, absolute_floor))


def summary(runs: DataFrame, order: Sequence[str], source: str | None = None, last_n: int = 5, metrics: Sequence[Metric] = METRICS) -> DataFrame:
    """Per cohort: the latest run (of a source, if one is given), its baseline and all deltas.

    runs needs cohort, run_source, ok (succeeded) and base (eligible). The
    baseline is the median of the last ``last_n`` eligible successes before the
    latest run, from every source. ``status`` is pass unless the run failed or
    a metric regressed; exceeded lists the metrics beyond both floors.
    """
    if not metrics:
        raise ValueError("no metric")
    pick = F.lit(True) if source is None else normalize_source(F.col("run_source")) == source
    w = W.partitionBy("cohort").orderBy(*[F.col(o).desc_nulls_last() for o in order])
    marked = runs.withColumn("_p", pick).withColumn("_all", F.row_number().over(w))
    first = W.partitionBy("cohort")
    marked = marked.withColumn("_at", F.min(F.when(F.col("_p"), F.col("_all"))).over(first)).where("_at IS NOT NULL AND _all >= _at")
    marked = marked.withColumn("_use", (F.col("_all") > F.col("_at")) & F.col("ok") & F.col("base"))
    marked = marked.withColumn("_k", F.sum(F.col("_use").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    is_latest, in_base = F.col("_all") == F.col("_at"), F.col("_use") & (F.col("_k") <= last_n)
    aggs = [F.max(F.when(is_latest, F.col(order[-1]))).alias("latest_run"), F.max(F.when(is_latest, F.col("ok"))).alias("latest_ok"), F.count(F.when(in_base, 1)).alias("baseline_n")]
    for m in metrics:
        aggs += [F.max(F.when(is_latest, F.col(m.name))).alias(m.name), F.median(F.when(in_base, F.col(m.name))).alias(f"{m.name}_base")]
    g = marked.groupBy("cohort").agg(*aggs)
    pct, hit = [], []
    for m in metrics:
        _, p, r = delta_columns(F.col(m.name), F.col(f"{m.name}_base"), m.higher_is_better, m.percent, m.absolute)
        g = g.withColumns({f"{m.name}_pct": p, f"_hit_{m.name}": r})
        pct.append(F.col(f"{m.name}_pct"))
        hit.append(F.when(F.col(f"_hit_{m.name}"), F.lit(m.name)))
    g = g.withColumn("exceeded", F.array_join(F.filter(F.array(*hit), lambda x: x.isNotNull()), ","))
    g = g.withColumn("worst_pct", F.array_max(F.array(*pct)))
    g = g.withColumn("status", F.when(~F.col("latest_ok") | (F.col("exceeded") != ""), "fail").otherwise("pass"))
    return g.drop(*[f"_hit_{m.name}" for m in metrics])


def status_counts(summaries: DataFrame) -> DataFrame:
    return summaries.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "pass").alias("passed"), F.count_if(F.col("status") == "fail").alias("failed"))


def summary_order(summaries: DataFrame) -> DataFrame:
    """Failures first, then by cohort."""
    return summaries.orderBy(F.col("status") != "fail", "cohort")


def trend_points(runs: DataFrame, order: Sequence[str], metric: str) -> DataFrame:
    """The ordered points of each cohort in long form: cohort, seq, the order columns, value (nulls kept)."""
    w = W.partitionBy("cohort").orderBy(*[F.col(o).asc_nulls_first() for o in order])
    return runs.select("cohort", *order, F.col(metric).alias("value"), F.row_number().over(w).alias("seq"))


def last_n(runs: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    return runs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def recipe_mismatch(current: DataFrame, history: DataFrame, prefix: Sequence[str], fingerprint: str, key: str) -> DataFrame:
    """Current runs without a run of their own recipe in the history, but with one of another recipe on the same prefix.

    The inequality becomes an equi join: per prefix the history keeps its least
    and greatest recipe, one of which differs if any does.
    """
    h = history.where(F.col(fingerprint).isNotNull())
    any_ = h.groupBy(*prefix).agg(F.min(fingerprint).alias("_lo"), F.max(fingerprint).alias("_hi"))
    own = h.select(*prefix, fingerprint).distinct()
    rest = current.join(own, [*prefix, fingerprint], "left_anti")
    return rest.join(any_, list(prefix)).where((F.col("_lo") != F.col(fingerprint)) | (F.col("_hi") != F.col(fingerprint))).select(key, *prefix, fingerprint)


def metric_coverage(runs: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Per group: rows, and per metric the number of values, with the reason for which a plot is left out."""
    g = runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_runs"), *[F.count(m).alias(f"n_{m}") for m in metrics])
    for m in metrics:
        g = g.withColumn(f"skip_{m}", F.when(F.col(f"n_{m}") == 0, "no values").when(F.col(f"n_{m}") < 2, "one value"))
    return g


def static_failures(runs: DataFrame, limits: dict[str, str], key: str) -> DataFrame:
    """key, metric, current, ceiling for each metric above its limit column."""
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("current"), F.col(c).cast("double").alias("ceiling")) for m, c in limits.items()]
    return runs.select(key, F.explode(F.array(*rows)).alias("x")).select(key, "x.*").where(F.col("current") > F.col("ceiling"))


def override(raw: Column, default: float) -> Column:
    """A threshold given as text, or the default where it is absent or no number."""
    v = F.expr("CAST(NULL AS DOUBLE)") if raw is None else raw.try_cast("double")
    return F.coalesce(F.when(~F.isnan(v), v), F.lit(default))


def threshold_block(gpu: Column, blocks: dict[str, float], default: float) -> Column:
    """The value of the first block whose name stands in the GPU's name, else the default."""
    out = None
    for name, v in blocks.items():
        out = (F if out is None else out).when(F.contains(F.lower(gpu), F.lit(name.lower())), F.lit(v))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def gate_status(identity_ok: Column, mismatch: Column, static_fail: Column, attributed: Column, baseline_n: Column, legacy: Column, rolling_fail: Column) -> Column:
    """Status by precedence; the first condition that holds wins."""
    return (
        F.when(~identity_ok, "INFRA_ERROR").when(mismatch, "RECIPE_MISMATCH").when(static_fail, "REGRESSION").when(~attributed, "INFRA_ERROR")
        .when((baseline_n == 0) & legacy, "PASS").when(baseline_n == 0, "CALIBRATION_NEEDED").when(rolling_fail, "REGRESSION").otherwise("PASS")
    )


def seed_problems(positive: Sequence[str], non_negative: Sequence[str]) -> Column:
    """Comma-separated names of the measurements that a seed run must not have: missing, not finite, or out of range."""
    out = []
    for names, floor in ((positive, lambda c: c <= 0), (non_negative, lambda c: c < 0)):
        for n in names:
            c = F.col(n).cast("double")
            out.append(F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")) | floor(c), F.lit(n)))
    return F.array_join(F.filter(F.array(*out), lambda x: x.isNotNull()), ",")


def batch_consistency(runs: DataFrame, keys: Sequence[str], metric: str) -> DataFrame:
    """Per batch of two values or more: its median and the largest relative deviation from it; a median of zero or less is an error state."""
    v = runs.where(F.col(metric).isNotNull())
    med = v.groupBy(*keys).agg(F.median(metric).alias("median"), F.count(F.lit(1)).alias("n")).where("n >= 2")
    dev = F.when(F.col("median") > 0, F.abs(F.col(metric) - F.col("median")) / F.col("median"))
    return v.join(med, list(keys)).groupBy(*keys).agg(F.max("median").alias("median"), F.max("n").alias("n"), F.max(dev).alias("worst")).withColumn("error", F.col("median") <= 0)


def repeated(rows: DataFrame, identity: Sequence[Column]) -> DataFrame:
    """identity, n of the identities (the first that isn't null) that stand more than once."""
    return rows.groupBy(F.coalesce(*identity).alias("identity")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND identity IS NOT NULL")


def run_summary(steps: DataFrame, keys: Sequence[str], seconds: str, memory: str, frames: str) -> DataFrame:
    """Mean time, largest memory, frames a second (one over the mean where frames aren't known)."""
    g = steps.groupBy(*keys).agg(F.avg(seconds).alias("mean_s"), F.max(memory).alias("max_mb"), F.max(frames).alias("frames"))
    return g.withColumn("fps", F.when(F.col("mean_s") > 0, F.coalesce(F.col("frames"), F.lit(1)) / F.col("mean_s")))


def component_times(stages: DataFrame, mapping: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Seconds per component: stage maps exploded, classes mapped to components, unmapped stages left out."""
    flat = stages.select(*keys, F.explode("stages").alias("stage", "seconds"))
    return flat.join(F.broadcast(mapping), "stage").groupBy(*keys, "component").agg(F.sum("seconds").alias("seconds"))


def filter_options(*frames: DataFrame) -> DataFrame:
    """option, value: the sorted distinct values of the named columns over several frames."""
    out = None
    for df in frames:
        for c in df.columns:
            one = df.select(F.lit(c).alias("option"), F.col(c).cast("string").alias("value"))
            out = one if out is None else out.unionByName(one)
    return out.where("value IS NOT NULL").distinct().orderBy("option", "value")


def safe_name(c: Column) -> Column:
    """A name for files: other characters become underscores; a blank name or a leading dot gets one in front."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"[^A-Za-z0-9._-]", "_")
    return F.when((s == "") | s.startswith("."), F.concat(F.lit("_"), s)).otherwise(s)


def record_path(model: Column, ts: Column, sha: Column) -> Column:
    return F.concat(safe_name(model), F.lit("/"), safe_name(F.date_format(ts, "yyyyMMdd'T'HHmmss")), F.lit("_"), F.substring(safe_name(sha), 1, 12), F.lit(".json"))


def markdown_row(*cells: Column) -> Column:
    """A table row: pipes escaped, nulls as a dash."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.replace(c.cast("string"), F.lit("|"), F.lit("\\|")), F.lit("-")) for c in cells]), F.lit(" |"))


def upload_allowed(policy: str, status: Column) -> Column:
    """never, always, or pass: only of runs that passed or need calibration."""
    return {"never": F.lit(False), "always": F.lit(True), "pass": status.isin("PASS", "CALIBRATION_NEEDED")}[policy]


def boolish(c: Column) -> Column:
    """1/true/yes/on and 0/false/no/off in any case and with spaces; null for anything else."""
    s = F.lower(F.trim(c))
    return F.when(s.isin("1", "true", "yes", "on"), True).when(s.isin("0", "false", "no", "off"), False)


def parse_records(lines: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Typed run records from JSON text, undecodable ones left out.

    Presence differs from null: has_* says whether the key stands in the text.
    Times without a zone are UTC; one that can't be read is null and its row stays.
    """
    raw = F.col(column)
    keys = F.json_object_keys(raw)
    has = lambda k: F.coalesce(F.array_contains(keys, k), F.lit(False))
    text = lambda k: F.get_json_object(raw, f"$.{k}")
    cols = [text(k).alias(k) for k in ("model_id", "gpu_type", "commit_sha", "run_source", *IDENTITY)]
    cols += [text(m.name).try_cast("double").alias(m.name) for m in METRICS]
    return lines.where(keys.isNotNull()).select(
        *keep, *cols, F.try_to_timestamp(text("timestamp")).alias("ts"), boolish(text("success")).alias("success"), boolish(text("baseline_eligible")).alias("baseline_eligible"),
        *[has(k).alias(f"has_{k}") for k in ("success", "baseline_eligible", "run_source")],
    )
