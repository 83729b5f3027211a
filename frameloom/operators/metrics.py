"""Evaluation metrics over columns that models have filled.

Per-sample metrics are column expressions or one grouped pass over frames;
corpus metrics are partial aggregates merged by Spark. A metric that lacks its
input gives null, not zero. REGISTRY names all of them with their direction.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from frameloom.operators import rewards, series
from frameloom.operators.series import cosine, dot, norm


def mse(a: Column, b: Column) -> Column:
    """Mean squared difference over the common length."""
    n = F.least(F.size(a), F.size(b))
    d = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.when(n > 0, F.aggregate(d, F.lit(0.0), lambda s, v: s + v) / n)


def psnr(a: Column, b: Column, peak: float = 1.0) -> Column:
    """Decibels of one frame; identical frames are held at the floor of the error."""
    return 10 * F.log10(F.lit(peak * peak) / F.greatest(mse(a, b), F.lit(1e-10)))


def mean_score(rows: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Mean over frames, nulls left out."""
    return rows.groupBy(*keys).agg(F.avg(value).alias("score"))


def _gauss(size: int = 11, sigma: float = 1.5) -> np.ndarray:
    x = np.arange(size) - size // 2
    g = np.exp(-(x**2) / (2 * sigma**2))
    return g / g.sum()


def _blur(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    v = np.lib.stride_tricks.sliding_window_view(x, len(k), axis=0) @ k
    return np.lib.stride_tricks.sliding_window_view(v, len(k), axis=1) @ k


def ssim_frame(a: np.ndarray, b: np.ndarray) -> float:
    """Structural similarity of two images in 0..1 with a Gaussian window."""
    k, c1, c2 = _gauss(min(11, *a.shape)), 0.01**2, 0.03**2
    ma, mb = _blur(a, k), _blur(b, k)
    va, vb, ab = _blur(a * a, k) - ma * ma, _blur(b * b, k) - mb * mb, _blur(a * b, k) - ma * mb
    return float((((2 * ma * mb + c1) * (2 * ab + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))).mean())


def ssim(width: int) -> Callable[[Column, Column], Column]:
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else ssim_frame(np.asarray(x, float).reshape(-1, width), np.asarray(y, float).reshape(-1, width)) for x, y in zip(a, b)], dtype=float)

    return run


def _log_softmax(x: Column) -> Column:
    top = F.array_max(x)
    total = F.log(F.aggregate(x, F.lit(0.0), lambda s, v: s + F.exp(v.cast("double") - top)))
    return F.transform(x, lambda v: v.cast("double") - top - total)


def kl_softmax(pred: Column, truth: Column) -> Column:
    """KL(truth | pred) of softmaxed logits."""
    return F.aggregate(F.zip_with(_log_softmax(pred), _log_softmax(truth), lambda p, t: F.exp(t) * (t - p)), F.lit(0.0), lambda s, v: s + v)


def kl_sigmoid(pred: Column, truth: Column) -> Column:
    """The positive terms of the Bernoulli divergences of single classes."""
    ls = lambda v: -F.log1p(F.exp(-v.cast("double")))
    return F.aggregate(F.zip_with(pred, truth, lambda p, t: F.exp(ls(t)) * (ls(t) - ls(p))), F.lit(0.0), lambda s, v: s + v)


def collect_windows(rows: DataFrame, keys: Sequence[str], value: Column, how: str = "mean") -> DataFrame:
    return rows.groupBy(*keys).agg({"mean": F.avg, "max": F.max}[how](value).alias("score"))


_PUNCT = str.maketrans("", "", string.punctuation)
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")


def transcript_words(text: str | None) -> list[str]:
    """Words in compatibility form, lower case, without punctuation; text in East Asian script by characters."""
    t = unicodedata.normalize("NFKC", text or "").lower().translate(_PUNCT)
    t = "".join(c for c in t if not unicodedata.category(c).startswith("P"))
    return list("".join(t.split())) if _CJK.search(t) else t.split()


def edit_distance(a: Sequence[str], b: Sequence[str]) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@F.pandas_udf(T.DoubleType())
def wer(hypothesis: pd.Series, reference: pd.Series) -> pd.Series:
    """Word error rate; null without a reference word."""
    out = []
    for h, r in zip(hypothesis, reference):
        w = transcript_words(r)
        out.append(edit_distance(w, transcript_words(h)) / len(w) if w else None)
    return pd.Series(out, dtype=float)


def grid_offset(logits: Column, low: float = -2.0, high: float = 2.0) -> Column:
    """The grid value of the first greatest logit."""
    return F.lit(low) + (F.array_position(logits, F.array_max(logits)) - 1) * ((F.lit(high) - low) / (F.size(logits) - 1))


def desync(front: Column, back: Column, n_segments: Column, least: int = 14) -> Column:
    """Mean absolute offset of two predictions; null for too short a clip."""
    return F.when(n_segments >= least, (F.abs(grid_offset(front)) + F.abs(grid_offset(back))) / 2)


def frame_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two masks; two empty ones agree."""
    z = F.zip_with(a, b, lambda x, y: F.struct(((x > 0) & (y > 0)).cast("int").alias("i"), ((x > 0) | (y > 0)).cast("int").alias("u")))
    i, u = F.aggregate(z, F.lit(0), lambda s, v: s + v["i"]), F.aggregate(z, F.lit(0), lambda s, v: s + v["u"])
    return F.when(u > 0, i / u).otherwise(1.0)


def spatial_masks(rows: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Per clip: spatial IoU of the masks' maxima over time, and the weighted IoU of their means (sum of minima over sum of maxima)."""
    pix = rows.select(*keys, F.posexplode(F.arrays_zip(F.col(a).alias("x"), F.col(b).alias("y"))).alias("p", "z"))
    g = pix.groupBy(*keys, "p").agg(F.max(F.col("z.x") > 0).alias("ma"), F.max(F.col("z.y") > 0).alias("mb"), F.avg("z.x").alias("wa"), F.avg("z.y").alias("wb"))
    inter, union = F.count_if(F.col("ma") & F.col("mb")), F.count_if(F.col("ma") | F.col("mb"))
    low, high = F.sum(F.least("wa", "wb")), F.sum(F.greatest("wa", "wb"))
    return g.groupBy(*keys).agg(F.when(union > 0, inter / union).otherwise(1.0).alias("spatial_iou"), F.when(high > 0, low / high).otherwise(1.0).alias("weighted_iou"))


def pooled_score(frames: DataFrame, videos: DataFrame) -> DataFrame:
    """Benchmark score of pooled components, 0..100: frame components are means over all frames, not means of means.

    frames: mse, st, pv_mse, pv_st; videos: s, ws, pv_s, pv_ws.
    """
    a = frames.agg(*[F.avg(c).alias(c) for c in ("mse", "st", "pv_mse", "pv_st")])
    b = videos.agg(*[F.avg(c).alias(c) for c in ("s", "ws", "pv_s", "pv_ws")])
    raw = 100 * ((F.col("st") / F.col("pv_st") + F.col("s") / F.col("pv_s") + F.col("ws") / F.col("pv_ws")) / 3 - (F.col("mse") - F.col("pv_mse")))
    both = a.withColumn("_j", F.lit(1)).join(F.broadcast(b.withColumn("_j", F.lit(1))), "_j").drop("_j")  # one row each
    return both.withColumn("score", F.greatest(F.least(raw, F.lit(100.0)), F.lit(0.0)))


def position_score(relation: Column, a: Column, b: Column, limit: float = 0.1) -> Column:
    """How well two boxes [x0, y0, x1, y1] stand left/right or top/bottom of each other: full below the overlap limit, less above."""
    dx = (F.get(b, 0) + F.get(b, 2) - F.get(a, 0) - F.get(a, 2)) / 2
    dy = (F.get(b, 1) + F.get(b, 3) - F.get(a, 1) - F.get(a, 3)) / 2
    area = lambda r: (F.get(r, 2) - F.get(r, 0)) * (F.get(r, 3) - F.get(r, 1))
    inter = F.greatest(F.lit(0.0), F.least(F.get(a, 2), F.get(b, 2)) - F.greatest(F.get(a, 0), F.get(b, 0))) * F.greatest(F.lit(0.0), F.least(F.get(a, 3), F.get(b, 3)) - F.greatest(F.get(a, 1), F.get(b, 1)))
    union = area(a) + area(b) - inter
    iou = F.when(union > 0, inter / union).otherwise(0.0)
    worth = F.when(iou < limit, 1.0).otherwise(limit / iou)
    side = relation.contains("left") | relation.contains("right")
    level = relation.contains("top") | relation.contains("bottom")
    return F.when(side & (F.abs(dx) > F.abs(dy)), worth).when(~side & level & (F.abs(dy) > F.abs(dx)), worth).otherwise(0.0)


def share_of_frames(rows: DataFrame, keys: Sequence[str], hit: Column, among: Column | None = None) -> DataFrame:
    """Share of frames with ``hit`` among those with ``among`` (all, if not given); null without any."""
    base = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    return rows.groupBy(*keys).agg(F.avg(F.when(base, F.coalesce(hit, F.lit(False)).cast("double"))).alias("score"))


def both_objects(objects: Column, wanted: Column) -> Column:
    """Whether both of 'x and y' are among the objects; null if the request isn't of that form."""
    p = F.split(wanted, " and ")
    return F.when(F.size(p) == 2, F.array_contains(objects, F.get(p, 0)) & F.array_contains(objects, F.get(p, 1)))


def all_keywords(caption: Column, keywords: Column) -> Column:
    """1 if every keyword stands in the caption, else 0."""
    return F.forall(keywords, lambda k: F.contains(F.lower(caption), F.lower(k))).cast("double")


def in_top(labels: Column, scores: Column, wanted: Column, k: int = 5) -> Column:
    """Whether the wanted label is among the k best."""
    z = F.reverse(F.array_sort(F.zip_with(scores, labels, lambda s, l: F.struct(s.alias("s"), l.alias("l")))))
    return F.exists(F.slice(z, 1, k), lambda x: x["l"] == wanted)


def dynamic(rows: DataFrame, keys: Sequence[str], magnitude: str, height: int, width: int, per_clip: int = 16) -> DataFrame:
    """Whether a clip moves: enough frames whose (top) flow magnitude exceeds a limit that grows with the picture."""
    limit = 6.0 * min(height, width) / 256
    n = F.count(F.lit(1))
    return rows.groupBy(*keys).agg((F.count_if(F.col(magnitude) > limit) >= F.round(4 * n / per_clip)).alias("dynamic"))


def closeness(difference: Column) -> Column:
    """A mean absolute difference of 8-bit pixels as a score."""
    return (255 - difference) / 255


def flow_stats(u: np.ndarray, v: np.ndarray, gu: np.ndarray, gv: np.ndarray, floor: float = 0.5) -> tuple[float, float, float, float]:
    """Mean and greatest end-point error, mean cosine of moving pixels, share of errors above three pixels."""
    e = np.hypot(u - gu, v - gv)
    m, g = np.hypot(u, v), np.hypot(gu, gv)
    live = (m > floor) & (g > floor)
    cos = float(((u * gu + v * gv)[live] / (m * g)[live]).mean()) if live.any() else 1.0
    return float(e.mean()), float(e.max()), cos, float((e > 3).mean())


def expansion_focus(x: np.ndarray, y: np.ndarray, u: np.ndarray, v: np.ndarray, floor: float = 0.5) -> tuple[float, float] | None:
    """The point from which a flow field spreads, by least squares; null with fewer than ten moving points."""
    live = np.hypot(u, v) > floor
    if live.sum() < 10:
        return None
    a = np.stack([v[live], -u[live]], axis=1)
    fx, fy = np.linalg.lstsq(a, v[live] * x[live] - u[live] * y[live], rcond=None)[0]
    return float(fx), float(fy)


FLOW = ("mf_epe", "mf_angle_err", "mf_cosine", "mf_mag_ratio", "pixel_epe_mean", "pixel_epe_max", "px_angle_rmse", "grid_epe_mean", "grid_epe_max", "fl_all", "foe_dist", "flow_kl_2d")


def _flow_kl(a: np.ndarray, b: np.ndarray, angles: int = 36, mags: int = 20, floor: float = 0.5) -> float:
    hists = []
    for f in (a, b):
        m = np.hypot(f[..., 0], f[..., 1]).ravel()
        ang = np.degrees(np.arctan2(f[..., 1], f[..., 0])).ravel() % 360
        live = m >= floor
        if live.sum() < 10:
            return 0.0
        edges = np.logspace(np.log10(floor), np.log10(max(m[live].max(), floor + 1.0)), mags + 1)
        h = np.histogram2d(ang[live], m[live], bins=[np.linspace(0, 360, angles + 1), edges])[0] + 1
        hists.append(h / h.sum())
    p, q = hists
    return float((p * np.log(p / q)).sum())


def flow_comparison(gen: np.ndarray, gt: np.ndarray, grid: int = 8, floor: float = 0.5, top: float = 80.0, step: int = 8) -> dict[str, float]:
    """The figures of :data:`FLOW` of two H x W x 2 fields; pixels under ``floor`` or above the percentile ``top`` of the greater magnitude are masked."""
    g, m = np.linalg.norm(gt, axis=2), np.linalg.norm(gen, axis=2)
    most = np.maximum(g, m)
    mask = (most >= floor) & (most <= np.percentile(most, top))
    sel = mask if mask.any() else np.ones_like(mask)
    mg, mm = gt[sel].mean(axis=0), gen[sel].mean(axis=0)
    a, b = float(np.linalg.norm(mg)), float(np.linalg.norm(mm))
    if a < 0.1 and b < 0.1:
        angle, cos = 0.0, 1.0
    elif a < 0.1 or b < 0.1:
        angle, cos = 90.0, 0.0
    else:
        cos = float(np.clip(mg @ mm / (a * b), -1, 1))
        angle = float(np.degrees(np.arccos(cos)))
    e = np.linalg.norm(gt - gen, axis=2)
    live = mask & (g > 0.5) & (m > 0.5)
    turn = np.degrees(np.arccos(np.clip((gt * gen).sum(axis=2) / (g * m + 1e-8), -1, 1)))
    h, w = e.shape
    gh, gw = h // grid, w // grid
    cells = []
    for y in range(grid):
        for x in range(grid):
            at = np.s_[y * gh : (y + 1) * gh, x * gw : (x + 1) * gw]
            cells.append(e[at][mask[at]].mean() if mask[at].any() else e[at].mean() if e[at].size else np.nan)
    yy, xx = (k.ravel() for k in np.meshgrid(np.arange(step // 2, h, step), np.arange(step // 2, w, step), indexing="ij"))
    foci = [expansion_focus(xx.astype(float), yy.astype(float), f[yy, xx, 0], f[yy, xx, 1]) or (w / 2, h / 2) for f in (gt, gen)]
    return dict(zip(FLOW, map(float, (
        np.linalg.norm(mg - mm), angle, cos, b / a if a > 1e-6 else 1.0, e[sel].mean(), e[sel].max(), np.sqrt((turn[live] ** 2).mean()) if live.any() else 0.0,
        np.mean(cells), np.max(cells), ((e > 3) & (e > 0.05 * g))[sel].mean(), np.hypot(foci[0][0] - foci[1][0], foci[0][1] - foci[1][1]), _flow_kl(gt, gen),
    ))))


def flow_frames(rows: DataFrame, key: str, width: int) -> DataFrame:
    """The figures of :data:`FLOW` per frame of flow arrays u, v against gu, gv, row by row of ``width`` pixels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b.to_pydict()
            field = lambda i, x, y: np.stack([np.asarray(d[x][i], float), np.asarray(d[y][i], float)], axis=-1).reshape(-1, width, 2)
            out = [flow_comparison(field(i, "u", "v"), field(i, "gu", "gv")) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([o[c] for o in out], pa.float64()) for c in FLOW]], names=[key, *FLOW])

    return rows.select(key, "u", "v", "gu", "gv").mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, " + ", ".join(f"{c} double" for c in FLOW))


def flow_histogram_kl(rows: DataFrame, keys: Sequence[str], angles: int = 36, mags: int = 20, floor: float = 0.5) -> DataFrame:
    """KL between angle and log-magnitude histograms of two flows, one row per pixel (u, v, gu, gv), one added to each cell; zero if a side has fewer than ten moving pixels."""
    both = rows.select(*keys, F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("u"), F.col("v")), F.struct(F.lit("b").alias("side"), F.col("gu").alias("u"), F.col("gv").alias("v")))).alias("x")).select(*keys, "x.*")
    both = both.withColumns({"m": F.hypot("u", "v"), "ang": F.pmod(F.degrees(F.atan2("v", "u")), F.lit(360.0))}).where(F.col("m") >= floor)
    top = F.greatest(F.max("m").over(W.partitionBy(*keys, "side")), F.lit(floor + 1.0))
    both = both.withColumns({"i": F.least(F.floor(F.col("ang") / (360.0 / angles)), F.lit(angles - 1)), "j": F.least(F.floor((F.log10("m") - F.log10(F.lit(floor))) / (F.log10(top) - F.log10(F.lit(floor))) * mags), F.lit(mags - 1))})
    cells = both.groupBy(*keys, "i", "j").agg(F.count_if(F.col("side") == "a").alias("a"), F.count_if(F.col("side") == "b").alias("b"))
    cells = cells.withColumns({"na": F.sum("a").over(W.partitionBy(*keys)), "nb": F.sum("b").over(W.partitionBy(*keys))})
    size = angles * mags
    p, q = (F.col("a") + 1) / (F.col("na") + size), (F.col("b") + 1) / (F.col("nb") + size)
    base = F.log((F.col("nb") + size) / (F.col("na") + size))
    # Cells that neither side fills all weigh the same: 1/(na+size) * base each.
    g = cells.groupBy(*keys).agg(F.sum(p * F.log(p / q)).alias("s"), F.count(F.lit(1)).alias("n"), F.max("na").alias("na"), F.max("nb").alias("nb"), F.max(base).alias("base"))
    return g.select(*keys, F.when((F.col("na") < 10) | (F.col("nb") < 10), 0.0).otherwise(F.col("s") + (size - F.col("n")) / (F.col("na") + size) * F.col("base")).alias("kl"))


def moments(rows: DataFrame, side: str, vector: str) -> DataFrame:
    """side, i, x: number of finite rows (i = -1), sums (i < d) and sums of products, merged from one partial per task.

    A task folds its rows into d*d sums, whatever their number; rows that
    aren't finite are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[str, list] = {}
        for b in batches:
            sides = b.column(0).to_pylist()
            x = np.array(b.column(1).to_pylist(), dtype=float) if b.num_rows else np.empty((0, 0))
            if not x.size:
                continue
            ok = np.isfinite(x).all(axis=1)
            for s in set(sides):
                m = x[np.array([v == s for v in sides]) & ok]
                if len(m):
                    n, t, p = acc.get(s, (0, 0, 0))
                    acc[s] = (n + len(m), t + m.sum(0), p + m.T @ m)
        for s, (n, t, p) in acc.items():
            flat = np.concatenate([[n], t, p.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([s] * len(flat)), pa.array(np.arange(-1, len(flat) - 1)), pa.array(flat)], names=["side", "i", "x"])

    parts = rows.where(F.col(vector).isNotNull()).select(F.col(side).cast("string"), vector).mapInArrow(run, "side string, i bigint, x double")
    return parts.groupBy("side", "i").agg(F.sum("x").alias("x"))


def frechet(rows: DataFrame, side: str, vector: str, a: str, b: str, epsilon: float = 1e-6) -> DataFrame:
    """One row: n of both sides and the Fréchet distance of their Gaussian fits; null with fewer than two finite rows a side.

    What comes to the driver is two d*d matrices, a size the vectors fix.
    """
    got: dict[str, dict[int, float]] = {a: {}, b: {}}
    for r in moments(rows, side, vector).where(F.col("side").isin(a, b)).collect():
        got[r["side"]][r["i"]] = r["x"]
    ns, fits = [], []
    for s in (a, b):
        n = int(got[s].get(-1, 0))
        ns.append(n)
        if n >= 2:
            flat = np.array([got[s][i] for i in range(len(got[s]) - 1)])
            d = int((np.sqrt(1 + 4 * len(flat)) - 1) / 2)
            mu, p = flat[:d] / n, flat[d:].reshape(d, d)
            fits.append((mu, (p - n * np.outer(mu, mu)) / (n - 1) + epsilon * np.eye(d)))
    score = frechet_distance(*fits[0], *fits[1]) if len(fits) == 2 else None
    return rows.sparkSession.createDataFrame([(ns[0], ns[1], score)], "n_a bigint, n_b bigint, score double")


def frechet_distance(mu1: np.ndarray, s1: np.ndarray, mu2: np.ndarray, s2: np.ndarray) -> float:
    w, v = np.linalg.eigh(s1)
    root = (v * np.sqrt(np.clip(w, 0, None))) @ v.T
    cross = np.sqrt(np.clip(np.linalg.eigvalsh(root @ s2 @ root), 0, None)).sum()
    return float(((mu1 - mu2) ** 2).sum() + np.trace(s1) + np.trace(s2) - 2 * cross)


@dataclass(frozen=True)
class Metric:
    name: str
    higher_is_better: bool
    needs_reference: bool = False
    corpus: bool = False
    compute: Callable | None = None


def _m(name: str, up: bool, compute: Callable, ref: bool = False, corpus: bool = False) -> tuple[str, Metric]:
    return name, Metric(name, up, ref, corpus, compute)


#: Names, directions and operators of all metrics, in the order in which 'all' lists them.
REGISTRY: dict[str, Metric] = dict((
    _m("common.psnr", True, psnr, True), _m("common.ssim", True, ssim, True), _m("common.lpips", False, mean_score, True), _m("common.fvd", False, frechet, False, True),
    _m("audio.frechet_distance", False, frechet, True, True), _m("audio.kl_divergence", False, kl_softmax, True), _m("audio.wer", False, wer), _m("audio.clap_score", True, cosine),
    _m("audio.imagebind_score", True, cosine), _m("audio.audiobox_aesthetics", True, mean_score), _m("audio.desync", False, desync), _m("videoscore2", True, mean_score),
    _m("physics_iq", True, pooled_score, True), _m("physics_iq.mse", False, mse, True), _m("physics_iq.spatiotemporal_iou", True, frame_iou, True), _m("physics_iq.spatial_iou", True, spatial_masks, True),
    _m("physics_iq.weighted_spatial_iou", True, spatial_masks, True), _m("optical_flow.gt_optical_flow", False, flow_frames, True), _m("optical_flow.synthetic_optical_flow", False, flow_frames),
    _m("vbench.appearance_style", True, cosine), _m("vbench.aesthetic_quality", True, mean_score), _m("vbench.background_consistency", True, series.consistency), _m("vbench.color", True, share_of_frames),
    _m("vbench.dynamic_degree", True, dynamic), _m("vbench.human_action", True, in_top), _m("vbench.imaging_quality", True, mean_score), _m("vbench.motion_smoothness", True, closeness),
    _m("vbench.multiple_objects", True, both_objects), _m("vbench.object_class", True, share_of_frames), _m("vbench.overall_consistency", True, dot), _m("vbench.temporal_style", True, dot),
    _m("vbench.scene", True, all_keywords), _m("vbench.spatial_relationship", True, position_score), _m("vbench.subject_consistency", True, series.consistency),
    _m("vbench.temporal_flickering", True, closeness), _m("judge.third_person_separation", True, rewards.win_rate, True, True),
))


def resolve(names: Sequence[str]) -> list[Metric]:
    """Metrics by name, by group prefix or 'all', each once, in the order asked for."""
    out: dict[str, Metric] = {}
    for n in names:
        hit = [m for k, m in REGISTRY.items() if n == "all" or k == n or k.startswith(f"{n}.")]
        if not hit:
            raise KeyError(f"no metric or group {n}")
        out.update((m.name, m) for m in hit)
    return list(out.values())


def per_sample(samples: DataFrame) -> DataFrame:
    """Per-sample metrics don't see the rows that only serve as corpus references."""
    return samples.where(~F.coalesce(F.col("role") == "reference", F.lit(False)))


def require_corpus(samples: DataFrame) -> None:
    """A corpus metric of one sample is refused."""
    if len(samples.limit(2).take(2)) < 2:
        raise ValueError("a corpus metric needs more than one sample")


__all__ = ["REGISTRY", "cosine", "dot", "norm", "resolve"]
