"""Structural validation of clips, deliveries, archives and pose conventions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import all_reasons, reason
from ..functions.specs import on_spec
from .ranks import medians, tiles


def _finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def pose_defects(poses: Column, tol: float = 1e-3, row_tol: float = 1e-6) -> Column:
    """Codes of what is wrong with a track of 16-number poses: shape, finite, orthonormal, handed, bottom_row."""
    p = F.coalesce(poses, F.array().cast("array<array<double>>"))
    ok = lambda f: F.coalesce(F.forall(p, f), F.lit(False))
    dot = lambda m, a, b: m[a] * m[b] + m[a + 4] * m[b + 4] + m[a + 8] * m[b + 8]
    unit = lambda m: F.greatest(*[F.abs(dot(m, a, b) - (1.0 if a == b else 0.0)) for a in range(3) for b in range(a, 3)]) <= tol
    det = lambda m: m[0] * (m[5] * m[10] - m[6] * m[9]) - m[1] * (m[4] * m[10] - m[6] * m[8]) + m[2] * (m[4] * m[9] - m[5] * m[8])
    shape = (F.size(p) > 0) & ok(lambda m: F.size(m) == 16)
    finite = ok(lambda m: F.forall(m, _finite))
    good = shape & finite
    tests = [("shape", ~shape), ("finite", shape & ~finite), ("orthonormal", good & ~ok(unit)), ("handed", good & ~ok(lambda m: F.abs(det(m) - 1) <= tol)), ("bottom_row", good & ~ok(lambda m: (F.abs(m[12]) <= row_tol) & (F.abs(m[13]) <= row_tol) & (F.abs(m[14]) <= row_tol) & (F.abs(m[15] - 1) <= row_tol)))]
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in tests]), lambda x: x.isNotNull())


def clip_defects(target_fps: float, fps="fps", num_frames="num_frames", poses="poses", intrinsics="intrinsics") -> Column:
    """All reasons against a packaged clip: its track, counts that disagree, a length or rate off the spec, focal lengths."""
    f, n, p, k = (F.col(c) for c in (fps, num_frames, poses, intrinsics))
    bad = pose_defects(p)
    return F.concat(
        F.transform(bad, lambda x: F.concat(F.lit("poses_"), x)),
        F.transform(
            all_reasons(
                reason(~F.coalesce(F.size(p) == n, F.lit(False)), "pose_count"),
                reason(~F.coalesce(F.size(k) == n, F.lit(False)), "intrinsics_count"),
                reason(~on_spec(n), "length"),
                reason(~F.coalesce(F.abs(f - target_fps) <= 0.5, F.lit(False)), "fps"),
                reason(~F.coalesce((F.size(k) > 0) & F.forall(k, lambda x: _finite(x["fx"]) & _finite(x["fy"]) & (x["fx"] > 0) & (x["fy"] > 0)), F.lit(False)), "focal"),
            ),
            lambda r: r["code"],
        ),
    )


def delivery_defects(tasks: DataFrame, delivered: DataFrame, key: str = "output_clip_id", equal=("num_frames", "width", "height", "source_start_frame")) -> DataFrame:
    """(key, defects) of every task and every stray delivery: missing, stray, repeated, or the fields that differ."""
    t = tasks.groupBy(key).agg(F.min(F.struct(*equal)).alias("want"), F.count("*").alias("tn"))
    d = delivered.groupBy(key).agg(F.min(F.struct(*equal)).alias("got"), F.count("*").alias("dn"))
    j = t.join(d, key, "full")
    parts = [F.when(F.col("dn").isNull(), F.lit("missing")), F.when(F.col("tn").isNull(), F.lit("stray")), F.when((F.col("dn") > 1) | (F.col("tn") > 1), F.lit("repeated"))]
    parts += [F.when(F.col("want").isNotNull() & F.col("got").isNotNull() & ~F.col(f"want.{c}").eqNullSafe(F.col(f"got.{c}")), F.lit(c)) for c in equal]
    return j.select(key, F.filter(F.array(*parts), lambda x: x.isNotNull()).alias("defects"))


def complete_groups(members: DataFrame, group: str, name: str, expected: list[str]) -> DataFrame:
    """(group, complete, missing): which archive groups hold every expected member."""
    have = F.collect_set(F.when(F.col(name).isin(*expected), F.col(name)))
    return members.groupBy(group).agg(F.array_sort(F.array_except(F.array(*map(F.lit, expected)), have)).alias("missing")).withColumn("complete", F.size("missing") == 0)


def merge_split_frames(splits: DataFrame, group: str = "scene", part: str = "split", frame: str = "frame", value: str = "pose") -> DataFrame:
    """One row a (group, frame): of frames that several splits hold, the last split's."""
    return splits.groupBy(group, frame).agg(F.max_by(value, part).alias(value), F.max(part).alias(part))


def pose_convention(points: DataFrame, key: str, ours=("ax", "ay", "az"), other=("bx", "by", "bz")) -> DataFrame:
    """(key, resid_norm, verdict) of a similarity fit between two tracks: skip without span or spread, pass under 0.15."""
    from .robust import similarity

    kind = points.schema[key].dataType.simpleString()

    def fit(k, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[[*ours]].to_numpy(float), rows[[*other]].to_numpy(float)
        verdict, r = "skip", None
        if len(a) >= 3 and np.isfinite(a).all() and np.isfinite(b).all():
            span = float(np.linalg.norm(np.ptp(b, axis=0)))
            e = np.linalg.eigvalsh(np.cov(b.T))
            if span >= 0.05 and e[-1] > 0 and e[-2] / e[-1] >= 0.02:
                s, rot, t = similarity(a, b)
                r = float(np.sqrt((((s * a @ rot.T + t) - b) ** 2).sum(1).mean()) / span)
                verdict = "pass" if r < 0.15 else "fail"
        return pd.DataFrame({key: [k[0]], "resid_norm": [r], "verdict": [verdict]})

    return points.select(key, *ours, *other).groupBy(key).applyInPandas(fit, f"{key} {kind}, resid_norm double, verdict string")


def decile_ratios(samples: DataFrame, key: str, ours: str, truth: str) -> DataFrame:
    """(key, decile, n, ratio): median ours/truth in each tenth of truth; tenths from counts of ranks within the key, of which no task
    sorts or holds all rows."""
    d = samples.where((F.col(truth) > 0) & F.col(ours).isNotNull())
    d = tiles(d, key, truth, ours, 10, "decile").withColumn("ratio", F.col(ours) / F.col(truth))
    return medians(d, [key, "decile"], "ratio", "ratio").select(key, "decile", "n", "ratio")


def disparity_fit(samples: DataFrame, key: str, ours: str, truth: str) -> DataFrame:
    """1/ours = slope / truth + intercept, least squares."""
    x, y = 1 / F.col(truth), 1 / F.col(ours)
    return samples.where((F.col(truth) > 0) & (F.col(ours) > 0)).groupBy(key).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def ramp_agreement(frames: DataFrame, key: str, order: str, ours: str, truth: str) -> DataFrame:
    """Whether a focal ramp keeps falling or rising by no more than 5 against it, covers 0.6 of the range, and errs under 15 %."""
    w = Window.partitionBy(key).orderBy(order)
    d = frames.withColumn("step", F.col(ours) - F.lag(ours).over(w))
    g = d.groupBy(key).agg(F.coalesce(F.min("step") > -5, F.lit(True)).alias("monotonic"), ((F.max(ours) - F.min(ours)) / F.nullif(F.max(truth) - F.min(truth), F.lit(0.0))).alias("range_ratio"), (100 * F.avg(F.abs(F.col(ours) - F.col(truth)) / F.col(truth))).alias("mape"))
    return g.withColumn("ok", F.col("monotonic") & (F.col("range_ratio") > 0.6) & (F.col("mape") < 15))


def window_consensus(windows: DataFrame, key: str, scale: str = "scale", error: str = "nrmse", max_error: float = 0.15, tolerance: float = 1.5) -> DataFrame:
    """Scale of a track from local windows: those aligned within ``max_error``, within max(4 sigma, ln tolerance) of the
    median log; null with fewer than min(3, n) of them."""
    ok = (F.col(error) <= max_error) & (F.col(scale) > 0)
    d = windows.select(key, F.when(ok, F.log(scale)).alias("l"))
    mid = d.groupBy(key).agg(F.median("l").alias("mid"), F.count("*").alias("n"))
    d = d.join(mid, key)
    mad = d.groupBy(key).agg(F.median(F.abs(F.col("l") - F.col("mid"))).alias("mad"))
    d = d.join(mad, key).withColumn("inlier", F.abs(F.col("l") - F.col("mid")) <= F.greatest(F.log(F.lit(tolerance)), 4 * 1.4826 * F.col("mad")))
    enough = F.count_if("inlier") >= F.least(F.lit(3), F.max("n"))
    return d.groupBy(key).agg(F.when(enough, F.exp(F.median(F.when(F.col("inlier"), F.col("l"))))).alias("scale"), F.max("n").alias("windows"), F.count_if("inlier").alias("inliers"))


def decode_depth(raw: Column, near: float, far: float, scale: float = 1.0) -> Column:
    """Metres of a 16-bit inverse-depth value; 0 and 65535 mark near and far and are -1."""
    inverse = 1 / F.lit(far) + raw.cast("double") / 65535 * (1 / F.lit(near) - 1 / F.lit(far))
    return F.when((raw <= 0) | (raw >= 65535), F.lit(-1.0)).otherwise(scale / inverse)
