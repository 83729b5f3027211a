"""Cohorts, baselines and gates on hand-built runs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from frameloom.operators import runs

SCHEMA = ("n bigint, ts timestamp, model_id string, gpu_type string, workload_id string, variant_id string, benchmark_version bigint, recipe_fingerprint string, hardware_profile_id string, software_profile_id string, "
          "run_source string, success boolean, baseline_eligible boolean, has_success boolean, has_baseline_eligible boolean, has_run_source boolean, latency double, throughput double, memory double, text_encoder_time_s double, dit_time_s double, vae_decode_time_s double")


def run(n, latency=10.0, **kw):
    d = dict(n=n, ts=dt.datetime(2025, 1, 1) + dt.timedelta(hours=n), model_id="m", gpu_type="g", workload_id="w", variant_id="v", benchmark_version=1, recipe_fingerprint="r", hardware_profile_id="h", software_profile_id="s",
             run_source="scheduled_main", success=True, baseline_eligible=None, has_success=True, has_baseline_eligible=False, has_run_source=True, latency=latency, throughput=None, memory=None, text_encoder_time_s=None, dit_time_s=None, vae_decode_time_s=None)
    d.update(kw)
    return tuple(d.values())


def summary(spark, rows, **kw):
    df = runs.cohort_key(spark.createDataFrame(rows, SCHEMA))
    df = df.withColumns({"ok": runs.succeeded(), "base": runs.eligible()})
    return runs.summary(df, ["ts", "n"], **kw).collect()


def test_failed_run_is_no_baseline(spark):
    (r,) = summary(spark, [run(1, 10.0), run(2, 12.0, success=False), run(3, 11.0)])
    assert (r.latency, r.baseline_n, r.latency_base) == (11.0, 1, 10.0)
    assert r.latency_pct == pytest.approx(10) and r.exceeded == "latency" and r.status == "fail"


def test_failed_latest(spark):
    (r,) = summary(spark, [run(1), run(2, success=False)])
    assert r.status == "fail" and r.exceeded == ""


def test_source_filter_keeps_all_sources_in_the_baseline(spark):
    rows = [run(1, 10.0), run(2, 10.5, run_source="pr"), run(3, 99.0)]
    (r,) = summary(spark, rows, source="pr")
    assert (r.latest_run, r.baseline_n, r.latency_base) == (2, 1, 10.0)


def test_both_floors(spark):
    (r,) = summary(spark, [run(1, 4.0), run(2, 4.4)])
    assert r.latency_pct == pytest.approx(10) and r.exceeded == ""


def test_higher_is_better(spark):
    (r,) = summary(spark, [run(1, throughput=2.0), run(2, throughput=1.5)])
    assert r.throughput_pct == pytest.approx(25) and "throughput" in r.exceeded


def test_median_of_last_five(spark):
    (r,) = summary(spark, [run(i, float(i)) for i in range(1, 9)])
    assert (r.baseline_n, r.latency_base) == (5, 5.0)


def test_cohorts(spark):
    rows = [run(1), run(2, variant_id="x"), run(3, benchmark_version=2), run(4, model_id="renamed"), run(5, workload_id=None, gpu_type="a"), run(6, workload_id=None, gpu_type="b"), run(7, benchmark_version=0)]
    got = runs.cohort_key(spark.createDataFrame(rows, SCHEMA)).select("n", "cohort").collect()
    c = {r.n: r.cohort for r in got}
    assert c[1] == c[4] and len({c[1], c[2], c[3], c[5], c[6], c[7]}) == 6
    assert c[7].startswith("v2") and c[5].startswith("legacy")


def test_absent_key_differs_from_null(spark):
    docs = [{"model_id": "m"}, {"model_id": "m", "success": None}, {"model_id": "m", "baseline_eligible": None}, {"model_id": "m", "run_source": "pr"}, {"model_id": "m", "success": True, "latency": "1e3", "timestamp": "bad"}]
    df = runs.parse_records(spark.createDataFrame([(json.dumps(d),) for d in docs] + [("{",)], "value string"))
    got = [tuple(r) for r in df.select(runs.succeeded(), runs.eligible()).collect()]
    assert got == [(True, True), (False, True), (True, False), (True, False), (True, True)]
    last = df.where("latency IS NOT NULL").first()
    assert last.latency == 1000.0 and last.ts is None


@pytest.mark.parametrize("flags,status", [
    ((False, True, True, True, 3, False, True), "INFRA_ERROR"), ((True, True, True, True, 3, False, True), "RECIPE_MISMATCH"), ((True, False, True, False, 3, False, False), "REGRESSION"),
    ((True, False, False, False, 3, False, False), "INFRA_ERROR"), ((True, False, False, True, 0, False, False), "CALIBRATION_NEEDED"), ((True, False, False, True, 0, True, True), "PASS"),
    ((True, False, False, True, 3, False, True), "REGRESSION"), ((True, False, False, True, 3, False, False), "PASS"),
])
def test_gate_precedence(spark, flags, status):
    assert spark.range(1).select(runs.gate_status(*map(F.lit, flags)).alias("s")).first().s == status


def test_recipe_mismatch_with_null_and_own_recipe(spark):
    h = spark.createDataFrame([("p", "a"), ("q", "b"), ("q", "c"), ("z", None)], "p string, f string")
    c = spark.createDataFrame([(1, "p", "a"), (2, "p", "x"), (3, "q", "b"), (4, "z", "a"), (5, "none", "a")], "k int, p string, f string")
    assert [r.k for r in runs.recipe_mismatch(c, h, ["p"], "f", "k").collect()] == [2]


def test_boolish_and_names(spark):
    df = spark.createDataFrame([(" YES ",), ("off",), ("2",), (None,)], "x string")
    assert [r[0] for r in df.select(runs.boolish(F.col("x"))).collect()] == [True, False, None, None]
    df = spark.createDataFrame([("a b/c",), (".x",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(runs.safe_name(F.col("x"))).collect()] == ["a_b_c", "_.x", "_", "_"]


def test_canonical_fingerprint(spark):
    from frameloom.functions.canonical import canonical, fingerprint

    assert canonical({"b": [2, 1], "a": {"é": None}}) == '{"a":{"\\u00e9":null},"b":[2,1]}'
    df = spark.createDataFrame([('{"a":1,"b":{"c":2,"d":3}}',), ('{"b":{"d":3,"c":9},"a":1}',), ("{",), (None,)], "x string")
    a, b, c, d = [r[0] for r in df.select(fingerprint(F.col("x"), ("b.c",), 16)).collect()]
    assert a == b and len(a) == 16 and c is None and d is None


def test_recipe_mismatch_of_all_runs(spark, sf):
    from frameloom.plans import run_queries

    got = {r.event_id % 10 for r in run_queries.QUERIES["runs_recipe_mismatch_all"](spark, sf).select("event_id").collect()}
    assert {2, 4} <= got
