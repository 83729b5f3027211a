"""Metrics: identities, skips and small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.operators import metrics, rewards


def arr(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def value(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_psnr_and_mse(spark):
    assert value(spark, metrics.psnr(arr(0, 1), arr(0, 1))) == pytest.approx(100)
    assert value(spark, metrics.mse(arr(0, 1, 9), arr(1, 1))) == pytest.approx(0.5)
    assert value(spark, metrics.mse(F.array().cast("array<double>"), arr(1))) is None


def test_ssim_self_and_noise():
    a = np.random.default_rng(1).random((20, 20))
    assert metrics.ssim_frame(a, a) == pytest.approx(1)
    assert metrics.ssim_frame(a, 1 - a) < 0.1


def test_kl_of_equal_logits_is_zero(spark):
    assert value(spark, metrics.kl_softmax(arr(1, 2, 3), arr(1, 2, 3))) == pytest.approx(0)
    assert value(spark, metrics.kl_softmax(arr(1000, 0), arr(0, 0))) > 100


def test_word_error_rate():
    assert metrics.transcript_words("Hello,  World!") == ["hello", "world"]
    assert metrics.transcript_words("你好。") == ["你", "好"]
    assert metrics.edit_distance("abc", "axcd") == 2 and metrics.edit_distance([], "ab") == 2


def test_desync(spark):
    logits = arr(*[0] * 10, 5, *[0] * 10)
    assert value(spark, metrics.desync(logits, logits, F.lit(14))) == pytest.approx(0)
    assert value(spark, metrics.desync(logits, logits, F.lit(13))) is None


def test_masks(spark):
    assert value(spark, metrics.frame_iou(arr(0, 0), arr(0, 0))) == 1.0
    assert value(spark, metrics.frame_iou(arr(1, 1, 0), arr(0, 1, 0))) == pytest.approx(0.5)


def test_boxes(spark):
    box = lambda *x: arr(*x)
    assert value(spark, metrics.position_score(F.lit("on the left of"), box(0, 0, 1, 1), box(5, 0, 6, 1))) == 1.0
    assert value(spark, metrics.position_score(F.lit("on the top of"), box(0, 0, 1, 1), box(5, 0, 6, 1))) == 0.0
    assert 0 < value(spark, metrics.position_score(F.lit("right"), box(0, 0, 10, 1), box(2, 0, 12, 1))) < 1


def test_frechet(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 4))
    rows = [("g", v.tolist()) for v in x] + [("r", v.tolist()) for v in x] + [("r", [float("nan")] * 4)]
    df = spark.createDataFrame(rows, "side string, v array<double>")
    r = metrics.frechet(df, "side", "v", "g", "r").first()
    assert (r.n_a, r.n_b) == (200, 200) and r.score == pytest.approx(0, abs=1e-6)
    moved = df.withColumn("v", F.when(F.col("side") == "g", F.transform("v", lambda y: y + 2)).otherwise(F.col("v")))
    assert metrics.frechet(moved, "side", "v", "g", "r").first().score == pytest.approx(16, rel=1e-6)
    assert metrics.frechet(df.where("side = 'g'").limit(1), "side", "v", "g", "r").first().score is None


def test_flow():
    u = np.ones(50)
    assert metrics.flow_stats(u, u, u, u) == (0.0, 0.0, pytest.approx(1.0), 0.0)
    x, y = (a.ravel().astype(float) for a in np.meshgrid(range(10), range(10)))
    assert metrics.expansion_focus(x, y, x - 3, y - 4) == pytest.approx((3, 4))
    assert metrics.expansion_focus(x, y, x * 0, y * 0) is None


def test_names():
    assert len(metrics.REGISTRY) == 36
    assert [m.name for m in metrics.resolve(["vbench.scene", "audio", "vbench.scene"])][:2] == ["vbench.scene", "audio.frechet_distance"]
    assert len(metrics.resolve(["all"])) == 36
    with pytest.raises(KeyError):
        metrics.resolve(["nothing"])


def test_corpus_needs_more_than_one(spark):
    with pytest.raises(ValueError):
        metrics.require_corpus(spark.range(1))
    df = spark.createDataFrame([("reference",), (None,)], "role string")
    assert metrics.per_sample(df).count() == 1


@pytest.mark.parametrize("mode,want", [("all", 0.0), ("positive_only", 0.5), ("negative_only", 0.0), ("one_only", 0.5), ("binary", 0.0)])
def test_clipped(spark, mode, want):
    assert value(spark, rewards.clipped(F.lit(-9.0), 1.0, mode)) == pytest.approx(want)


def test_win_rate_of_ties_only(spark):
    df = spark.createDataFrame([("a", "tie"), ("b", "win"), ("b", "loss"), ("b", "win")], "k string, v string")
    got = {r.k: r.rate for r in rewards.win_rate(df, ["k"], "v").collect()}
    assert got["a"] is None and got["b"] == pytest.approx(2 / 3)


def test_moments_and_running_average_of_whole_arrays(spark, sf):
    from frameloom.plans import metric_queries as q

    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    avg = {r.vec_id: r.avg for r in q.QUERIES["running_average_all"](spark, sf).collect()}
    label = e[0].label
    x = np.array([r.embedding for r in e if r.label == label], float)
    got = {r.i: r.x for r in q.QUERIES["moment_sums_all"](spark, sf).where(F.col("side") == str(label)).collect()}
    assert got == pytest.approx(dict(zip(range(-1, 64 + 4096), [len(x), *x.sum(0), *(x.T @ x).ravel()])), rel=1e-6, abs=1e-9)
    for r in e[:50]:
        want = r.embedding[0]
        for v in r.embedding[1:]:
            want = want * 0.75 + v * 0.25
        assert avg[r.vec_id] == pytest.approx(want, rel=1e-6)


def test_flow_comparison(spark):
    y, x = np.mgrid[0:64, 0:64].astype(float)
    gt, gen = np.stack([x - 20, y - 30], axis=-1), np.stack([x - 23, y - 34], axis=-1)
    got = metrics.flow_comparison(gen, gt)
    assert got["foe_dist"] == pytest.approx(5) and got["pixel_epe_mean"] == pytest.approx(5) and got["grid_epe_max"] == pytest.approx(5)
    big = np.full((16, 16, 2), 100.0)
    moved = metrics.flow_comparison(big + [4.0, 0.0], big)
    assert moved["fl_all"] == 0.0 and moved["mf_epe"] == pytest.approx(4)
    spike = np.ones((16, 16, 2))
    spike[:2, :2] = 50
    masked = metrics.flow_comparison(spike, np.ones((16, 16, 2)))
    assert masked["pixel_epe_max"] == 0 and masked["mf_cosine"] == pytest.approx(1) and masked["grid_epe_max"] == pytest.approx(49 * 2**0.5)
    still = metrics.flow_comparison(np.zeros((16, 16, 2)), np.ones((16, 16, 2)))
    assert (still["mf_angle_err"], still["mf_cosine"], still["mf_mag_ratio"], still["flow_kl_2d"]) == (90.0, 0.0, 0.0, 0.0)
    df = spark.createDataFrame([(1, [1.0] * 64, [0.0] * 64, [1.0] * 64, [1.0] * 64)], "k int, u array<double>, v array<double>, gu array<double>, gv array<double>")
    (r,) = metrics.flow_frames(df, "k", 8).collect()
    assert r.mf_angle_err == pytest.approx(45) and r.px_angle_rmse == pytest.approx(45, abs=1e-4)
