"""Robust scale recovery. Fits that need an SVD run as grouped Arrow functions; the rest are aggregates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranks import medians


def similarity(src: np.ndarray, dst: np.ndarray, with_scale: bool = True):
    """(scale, rotation, translation) of the least-squares similarity from src to dst points."""
    a, b = src - src.mean(0), dst - dst.mean(0)
    u, d, vt = np.linalg.svd(b.T @ a / len(a))
    flip = np.ones(3)
    flip[-1] = np.sign(np.linalg.det(u) * np.linalg.det(vt)) or 1.0
    r = (u * flip) @ vt
    s = float((d * flip).sum() / (a * a).sum() * len(a)) if with_scale else 1.0
    return s, r, dst.mean(0) - s * r @ src.mean(0)


def robust_scale(src: np.ndarray, dst: np.ndarray, percentile: float = 80.0) -> dict:
    """Fit, keep the points within the residual percentile, refit when three or more are left."""
    if src.shape != dst.shape or src.ndim != 2 or src.shape[1] != 3 or len(src) < 3:
        raise ValueError("needs two equal sets of at least three points")
    if not (np.isfinite(src).all() and np.isfinite(dst).all()):
        raise ValueError("points must be finite")
    if np.ptp(src, axis=0).max() <= 1e-12:
        raise ValueError("degenerate points")
    fit = similarity(src, dst)
    far = np.linalg.norm(fit[0] * src @ fit[1].T + fit[2] - dst, axis=1)
    near = far <= np.percentile(far, percentile)
    if near.sum() >= 3:
        fit = similarity(src[near], dst[near])
    left = np.linalg.norm(fit[0] * src @ fit[1].T + fit[2] - dst, axis=1)
    return {"scale": fit[0], "inliers": int(near.sum()), "points": len(src), "residual": float(np.median(left))}


def scale_by_clip(points: DataFrame, key: str, src=("sx", "sy", "sz"), dst=("dx", "dy", "dz"), percentile: float = 80.0) -> DataFrame:
    """(key, scale, inliers, points, residual) of each clip's point pairs; a clip's frames, a bounded group, meet in one call.
    Unusable clips have a null scale."""
    kind = points.schema[key].dataType.simpleString()

    def fit(k, rows: pd.DataFrame) -> pd.DataFrame:
        try:
            got = robust_scale(rows[[*src]].to_numpy(float), rows[[*dst]].to_numpy(float), percentile)
        except (ValueError, np.linalg.LinAlgError):
            got = {"scale": None, "inliers": 0, "points": len(rows), "residual": None}
        return pd.DataFrame([{key: k[0], **got}])

    return points.select(key, *src, *dst).groupBy(key).applyInPandas(fit, f"{key} {kind}, scale double, inliers int, points int, residual double")


def frame_ratios(pixels: DataFrame, keys=("clip_id", "frame"), a: str = "a", b: str = "b", eps: float = 1e-8) -> DataFrame:
    """Weighted least-squares ratio b/a of each frame over its valid pixels, weights 1/(b+eps)."""
    valid = F.col(a).isNotNull() & F.col(b).isNotNull() & ~F.isnan(a) & ~F.isnan(b) & (F.abs(a) < float("inf")) & (F.abs(b) < float("inf")) & (F.col(a) > 0) & (F.col(b) > 0)
    w = 1 / (F.col(b) + eps)
    top, low = (F.sum(F.when(valid, w * F.col(a) * F.col(x))) for x in (b, a))
    return pixels.groupBy(*keys).agg((top / (low + eps)).alias("ratio"), (F.count_if(valid) / F.count("*")).alias("valid_share"))


def mad_scale(ratios: DataFrame, key: str = "clip_id", ratio: str = "ratio", sigmas: float = 4.0) -> DataFrame:
    """Mean of the ratios within ``sigmas`` deviations (1.4826 times the median absolute deviation of the logs, at
    least 1e-6) of the median; null with fewer than max(3, half) valid frames."""
    ok = F.col(ratio).isNotNull() & ~F.isnan(ratio) & (F.col(ratio) > 0) & (F.col(ratio) < float("inf"))
    d = ratios.select(key, F.when(ok, F.log(ratio)).alias("l"), F.when(ok, F.col(ratio)).alias("r"))
    mid = d.groupBy(key).agg(F.median("l").alias("mid"), F.count("*").alias("frames"), F.count("l").alias("valid"), F.percentile("r", 0.1).alias("p10"), F.percentile("r", 0.9).alias("p90"))
    d = d.join(mid, key)
    mad = d.groupBy(key).agg(F.median(F.abs(F.col("l") - F.col("mid"))).alias("mad"))
    d = d.join(mad, key).withColumn("inlier", F.abs(F.col("l") - F.col("mid")) <= F.greatest(F.lit(1e-6), sigmas * 1.4826 * F.col("mad")))
    enough = F.max("valid") >= F.greatest(F.lit(3), F.ceil(F.max("frames") / 2))
    return d.groupBy(key).agg(F.when(enough, F.avg(F.when(F.col("inlier"), F.col("r")))).alias("scale"), F.max("frames").alias("frames"), F.max("valid").alias("valid"), F.count_if("inlier").alias("inliers"), (F.max("p90") / F.max("p10")).alias("spread"))


def fill_gaps(frames: DataFrame, key: str, order: str, value: str, fallback) -> DataFrame:
    """``value`` with entries outside 0.2 to 5 times the median of the positive ones rebuilt linearly from their neighbours
    (the nearest at the ends); a track without a good entry takes ``fallback``."""
    mid = frames.groupBy(key).agg(F.median(F.when(F.col(value) > 0, F.col(value))).alias("__mid"))
    d = frames.join(mid, key, "left")
    good = F.when(F.col(value).between(0.2 * F.col("__mid"), 5 * F.col("__mid")), F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    # both ways a running last: a frame that begins at the row is folded anew for each row, which is quadratic in a track
    upto = lambda o: Window.partitionBy(key).orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__a", F.last(good, True).over(upto(F.col(order)))).withColumn("__b", F.last(good, True).over(upto(F.col(order).desc())))
    span = F.col("__b.o") - F.col("__a.o")
    line = F.when(span > 0, F.col("__a.v") + (F.col("__b.v") - F.col("__a.v")) * (F.col(order) - F.col("__a.o")) / span).otherwise(F.col("__a.v"))
    return d.withColumn(value, F.coalesce(line, "__a.v", "__b.v", fallback)).drop("__mid", "__a", "__b")


def best_scale(samples: DataFrame, key: str, near: str, far: str, scales) -> DataFrame:
    """(key, scale, residual): the multiplier of least median |s near - far| / far. The scales are a fixed list in an array."""
    d = samples.withColumn("s", F.explode(F.array(*map(F.lit, scales))))
    r = medians(d.select(key, "s", (F.abs(F.col("s") * F.col(near) - F.col(far)) / F.col(far)).alias("residual")), [key, "s"], "residual", "residual")
    return r.groupBy(key).agg(F.min_by("s", F.struct("residual", "s")).alias("scale"), F.min("residual").alias("residual"))
