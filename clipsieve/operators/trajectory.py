"""Trajectory statistics, from a frame table or from pose arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import relative_trace, rotation_angle, unit_clip


def frame_stats(frames: DataFrame, key: str, order: str, axes=("x", "y", "z")) -> DataFrame:
    """(key, n, path, disp, diag, tort, straight, vel_med, vel_p95, max_seg) from rows of centres; a track with a null
    or non-finite centre or one row has ok = false and null statistics."""
    w = Window.partitionBy(key).orderBy(order)
    step = F.sqrt(sum(((F.col(a) - F.lag(a).over(w)) ** 2 for a in axes), F.lit(0.0)))
    bad = F.lit(False)
    for a in axes:
        bad = bad | F.col(a).isNull() | F.isnan(a) | (F.abs(F.col(a)) == float("inf"))
    d = frames.select(key, order, *axes).withColumn("step", step).withColumn("bad", bad)
    norm = lambda parts: F.sqrt(sum((p * p for p in parts), F.lit(0.0)))
    g = d.groupBy(key).agg(
        F.count("*").alias("n"), F.bool_or("bad").alias("bad"), F.sum("step").alias("path"), F.median("step").alias("vel_med"), F.percentile("step", 0.95).alias("vel_p95"), F.max("step").alias("max_seg"),
        norm([F.max_by(a, order) - F.min_by(a, order) for a in axes]).alias("disp"), norm([F.max(a) - F.min(a) for a in axes]).alias("diag"),
    )
    ok = ~F.col("bad") & (F.col("n") >= 2)
    stats = {"path": F.col("path"), "disp": F.col("disp"), "diag": F.col("diag"), "tort": F.when(F.col("diag") > 1e-9, F.col("path") / F.col("diag")).otherwise(F.lit(float("inf"))), "straight": F.when(F.col("path") > 1e-9, F.col("disp") / F.col("path")).otherwise(F.lit(0.0)), "vel_med": F.col("vel_med"), "vel_p95": F.col("vel_p95"), "max_seg": F.col("max_seg")}
    return g.select(key, "n", ok.alias("ok"), *[F.when(ok, v).alias(k) for k, v in stats.items()])


def _steps(poses: Column) -> Column:
    """(length, angle, trace) of each consecutive pair."""
    pair = lambda a, b: F.struct(F.sqrt((b[3] - a[3]) ** 2 + (b[7] - a[7]) ** 2 + (b[11] - a[11]) ** 2).alias("d"), rotation_angle(relative_trace(a, b)).alias("ang"))
    return F.when(F.size(poses) >= 2, F.transform(F.sequence(F.lit(0), F.size(poses) - 2), lambda i: pair(F.get(poses, i), F.get(poses, i + 1))))


def _rank(a: Column, q: float) -> Column:
    """Linear-interpolated quantile of an array."""
    s = F.array_sort(a)
    at = F.lit(q) * (F.size(s) - 1)
    lo = F.floor(at).cast("int")
    return F.get(s, lo) + (at - lo) * (F.coalesce(F.get(s, lo + 1), F.get(s, lo)) - F.get(s, lo))


def pose_stats(clips: DataFrame, poses: str = "poses", keep=("clip_id",)) -> DataFrame:
    """All statistics of arrays of 16-number poses (camera to world): one row for every clip, without a shuffle; unusable
    tracks have ok = false."""
    p = F.col(poses)
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    ok = F.coalesce((F.size(p) >= 2) & F.forall(p, lambda m: (F.size(m) == 16) & fine(m[3]) & fine(m[7]) & fine(m[11])), F.lit(False))
    d = clips.select(*keep, F.when(ok, p).alias("p"), ok.alias("ok"))
    d = d.withColumn("s", _steps(F.col("p")))
    axis = lambda k: F.transform("p", lambda m: m[k])
    extent = lambda k: F.array_max(axis(k)) - F.array_min(axis(k))
    first, last = F.get("p", F.lit(0)), F.element_at("p", -1)
    seg, ang = F.transform("s", lambda x: x["d"]), F.transform("s", lambda x: x["ang"])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    norm = lambda m: F.sqrt(m[2] ** 2 + m[6] ** 2 + m[10] ** 2)
    facing = unit_clip((first[2] * last[2] + first[6] * last[6] + first[10] * last[10]) / (norm(first) * norm(last) + 1e-12))
    d = d.withColumns({"path": total(seg), "disp": F.sqrt((last[3] - first[3]) ** 2 + (last[7] - first[7]) ** 2 + (last[11] - first[11]) ** 2), "diag": F.sqrt(extent(3) ** 2 + extent(7) ** 2 + extent(11) ** 2)})
    return d.select(
        *keep, "ok", F.size("p").alias("n_frames"), "path", "disp", "diag", F.when(F.col("ok"), F.when(F.col("diag") > 1e-9, F.col("path") / F.col("diag")).otherwise(F.lit(float("inf")))).alias("tort"),
        F.when(F.col("ok"), F.when(F.col("path") > 1e-9, F.col("disp") / F.col("path")).otherwise(0.0)).alias("straight"), total(ang).alias("rot_deg"), F.degrees(F.acos(facing)).alias("fov_sweep"),
        _rank(seg, 0.5).alias("vel_med"), _rank(seg, 0.95).alias("vel_p95"), F.array_max(seg).alias("max_seg"), (F.col("path") / (F.size("p") - 1)).alias("avg_motion"), (F.col("path") / (F.col("diag") + 1e-6)).alias("tortuosity"),
        (F.array_max(seg) / (_rank(seg, 0.5) + 1e-6)).alias("jump_ratio"), _rank(ang, 0.5).alias("ang_med"), _rank(ang, 0.95).alias("ang_p95"), F.array_max(ang).alias("ang_max"),
    )


def islands(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Runs of intervals that each begin one after the last one's end: (key, island, start, end, parts)."""
    w = Window.partitionBy(key).orderBy(start, end)
    new = F.when(F.col(start) == F.lag(end).over(w) + 1, 0).otherwise(1)
    d = df.withColumn("__new", new).withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(key, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("parts"))
