"""Selections over metrics: camera-dynamic clips, best-first batches, retries and attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import first_reason
from ..functions.text import outdoor_class

# Default bounds of the camera-dynamic selection.
DYNAMIC = {"dover_min_gt": 0.25, "dover_min_default": 0.50, "unimatch_min": 5.0, "scale_cov_max": 0.10, "min_frames": 81, "gt_span_min": 1.0, "def_span_min": 0.5, "rot_floor": 0.1, "jump_frac_max": 0.5, "ang_med_max": 3.0, "ang_max_max": 25.0}


def quality_verdict(mode: Column, bounds: dict | None = None) -> Column:
    """First failing rule over dover_tech, dover_aes, unimatch and scale_cov, or ok."""
    b = DYNAMIC | (bounds or {})
    gt = mode == "gt_pose"
    floor = F.when(gt, b["dover_min_gt"]).otherwise(b["dover_min_default"])
    return first_reason(
        ("dover_missing", F.col("dover_tech").isNull() | F.col("dover_aes").isNull()),
        ("dover_low", (F.col("dover_tech") + F.col("dover_aes")) / 2 < floor),
        ("frozen_img", F.col("unimatch").isNull() | (F.col("unimatch") < b["unimatch_min"])),
        ("scale_cov", ~gt & F.coalesce(F.col("scale_cov") >= b["scale_cov_max"], F.lit(False))),
    )


def motion_verdict(mode: Column, bounds: dict | None = None) -> Column:
    """First failing rule over n_frames, ang_med, ang_max, span_m and max_seg, or ok."""
    b = DYNAMIC | (bounds or {})
    span = F.when(mode == "gt_pose", b["gt_span_min"]).otherwise(b["def_span_min"])
    return first_reason(
        ("short", F.col("n_frames") < b["min_frames"]),
        ("static_cam", (F.col("ang_med") < b["rot_floor"]) & (F.col("span_m") < span)),
        ("jump_cut", (F.col("span_m") > 0) & (F.col("max_seg") / F.nullif(F.col("span_m"), F.lit(0.0)) > b["jump_frac_max"])),
        ("too_fast", F.col("ang_med") > b["ang_med_max"]),
        ("rot_cut", F.col("ang_max") > b["ang_max_max"]),
    )


def distance_verdict(path: Column, disp: Column) -> Column:
    """static, scale_diverged, both joined by +, or empty."""
    parts = F.array(F.when(path < 1, F.lit("static")), F.when((disp > 2000) | (path > 5000), F.lit("scale_diverged")))
    return F.array_join(F.filter(parts, lambda x: x.isNotNull()), "+")


def outdoor_batch(clips: DataFrame, caption: str = "caption") -> DataFrame:
    return clips.where(outdoor_class(F.col(caption)) == "outdoor")


def best_first(df: DataFrame, n: int | None = None, flags: str = "flags", quality: str = "quality", cuts: str = "cuts", keys=("source", "clip_id")) -> DataFrame:
    """Fewest flags, highest quality (null as 0), fewest cuts, then the keys; with n as a take-ordered, without a full sort."""
    order = [F.size(F.coalesce(flags, F.array().cast("array<string>"))), F.desc(F.coalesce(quality, F.lit(0.0))), F.coalesce(cuts, F.lit(0)), *keys]
    d = df.orderBy(*order)
    return d if n is None else d.limit(n)


def per_source_cap(df: DataFrame, k: int, source: str = "source", order=("clip_id",)) -> DataFrame:
    w = Window.partitionBy(source).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def first_accepted(attempts: DataFrame, key: str, order: str, accepted: Column) -> DataFrame:
    """The first accepted attempt of each key; aggregated in each task first."""
    row = F.struct(order, *[c for c in attempts.columns if c not in (key, order)])
    return attempts.where(accepted).groupBy(key).agg(F.min_by(row, order).alias("r")).select(key, "r.*")


def pending(items: DataFrame, done: DataFrame, defects: DataFrame, attempts: DataFrame, max_attempts: int = 3, key: str = "item") -> DataFrame:
    """Items neither done nor closed by a defect nor out of attempts."""
    tired = attempts.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= max_attempts).select(key)
    closed = done.select(key).unionByName(defects.select(key)).unionByName(tired).distinct()
    return items.join(closed, key, "left_anti")


def restrict_items(items: DataFrame, wanted: DataFrame, key: str = "item") -> DataFrame:
    """Items equal to a wanted one, wholly or by base name; all items where none matches."""
    base = lambda c: F.regexp_extract(c, r"([^/]*)$", 1)
    names = wanted.select(F.col(key).alias("w")).unionByName(wanted.select(base(F.col(key)).alias("w"))).distinct()
    whole = items.join(names, items[key] == names["w"], "left_semi")
    by_name = items.join(names, base(items[key]) == names["w"], "left_semi").join(whole.select(F.col(key).alias("h")).distinct(), F.col(key) == F.col("h"), "left_anti")
    got = whole.unionByName(by_name)
    return items if got.isEmpty() else got
