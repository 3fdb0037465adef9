"""Whole jobs: recipes, window views, calibration, selections and packing, composed of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import shard_key
from ..functions.text import outdoor_class
from ..operators import calibrate, dedup, packing, select, semantic, split
from .views import stored


def build_recipe(meta: DataFrame, tiers=split.TIERS, per_owner: int = 100, repeats: dict[str, int] | None = None, owners=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, test, report) of (owner, clip_id, kept_tier) rows; train has repeat. Named owners and repeats must have rows."""
    if owners:
        split.check_owners(meta, owners)
        meta = meta.where(F.col("owner").isin(*owners))
    d = stored(split.eligible(meta, tiers).select("owner", "clip_id", "kept_tier"))
    if repeats:
        split.check_owners(d, list(repeats))
    train, test = split.train_test(d, per_owner)
    train = split.with_repeat(train, repeats or {})
    split.check_split(train, test)
    return train, test, split.split_report(d, test, repeats)


def build_window_view(meta: DataFrame, window: int, tiers=split.TIERS, per_owner: int = 100, min_frames: int = 0, max_frames: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) windows; the split is by clip, so no clip is on both sides."""
    d = stored(split.fits(split.eligible(meta, tiers), window, min_frames, max_frames).select("owner", "clip_id", "num_frames", "kept_tier"))
    train, test = split.train_test(d, per_owner)
    split.check_split(train, test)
    cols = ["owner", "clip_id", "start_frame", "num_frames", "kept_tier"]
    return split.window_rows(train, window).select(*cols), split.window_rows(test, window).select(*cols)


def calibrated(clips: DataFrame, source: str = "source", sample: int = 0) -> tuple[DataFrame, DataFrame]:
    """(measured, flag rates) of each source; both heads of a score are needed. ``sample`` draws a systematic sample."""
    d = calibrate.systematic_sample(clips, source, "clip_id", sample) if sample else clips
    m = d.select(source, F.col("metrics.unimatch").alias("flow"), ((F.col("metrics.dover_tech") + F.col("metrics.dover_aes")) / 2).alias("dover"), F.col("metrics.vmaf").alias("vmaf"), F.col("metrics.saturation").alias("sat"))
    ranks = calibrate.nearest_ranks(m, source, {"flow": [2, 5, 75, 90], "dover": [25, 50], "vmaf": [90, 97], "sat": [90, 97]})
    return ranks, calibrate.flag_rates(d.withColumn("__f", F.col("metrics.vlm_reject_flags")), source, "__f", semantic.FLAG_RULES)


def select_dynamic(clips: DataFrame, bounds: dict | None = None, cap: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, verdicts): priority 1 is kept, 2 recoverable by cutting anew, 3 discarded; ``cap`` rows a source."""
    d = clips.withColumn("quality", select.quality_verdict(F.col("pose_mode"), bounds)).withColumn("motion", select.motion_verdict(F.col("pose_mode"), bounds))
    again = F.col("motion").isin("too_fast", "rot_cut", "jump_cut", "short")
    d = d.withColumn("priority", F.when(F.col("quality") != "ok", 3).when(F.col("motion") == "ok", 1).when(again, 2).otherwise(3))
    kept = d.where("priority = 1")
    return (select.per_source_cap(kept, cap) if cap else kept), d.groupBy("source", "priority", "quality", "motion").agg(F.count("*").alias("n"))


def select_outdoor(train: DataFrame, annotations: DataFrame, tracks: DataFrame, n: int | None = None) -> DataFrame:
    """Outdoor real-world clips whose track neither stands still nor diverges, best first."""
    keys = ["source", "clip_id"]
    d = train.join(annotations, keys).join(tracks, keys)
    d = d.where((F.col("vlm_scene_type") == "real_world") & (outdoor_class(F.col("dense_caption")) == "outdoor") & (select.distance_verdict(F.col("path"), F.col("disp")) == ""))
    return select.best_first(d, n, "reject_flags", "vlm_quality", "transition_count")


def pack(clips: DataFrame, limit: int = 2 << 30) -> DataFrame:
    """Clips with wds_key, wds_partition and wds_shard; colliding keys and unjudged clips raise."""
    d = clips.withColumn("wds_key", shard_key(F.col("clip_id"))).withColumn("wds_partition", packing.partition_of(F.col("kept_tier"), F.col("judged")))
    dedup.check_injective(d, "clip_id", "wds_key")
    d.agg(F.count("wds_partition")).first()  # raises here, once, rather than in several stages of the plan
    return packing.plan_shards(d, limit, "wds_partition", "clip_id", "bytes").withColumn("wds_shard", F.format_string("%s/%05d.tar", "wds_partition", "shard")).drop("lane", "shard")


def metric_scan(clips: DataFrame, tracks: DataFrame) -> DataFrame:
    """Raw numbers of every clip that has a track, ungated: those of the track rounded, the stored metrics and camera medians as they are."""
    d = clips.join(tracks, ["source", "clip_id"])
    track = [F.round(c, n).alias(c) for c, n in (("avg_motion_m", 6), ("span_m", 4), ("path_length", 4), ("tortuosity", 4), ("max_seg", 4), ("jump_ratio", 3), ("ang_med", 4), ("ang_p95", 4), ("ang_max", 4)) if c in tracks.columns]
    return d.select("source", "clip_id", "pose_mode", "n_frames", *track, *[F.col(f"metrics.{c}") for c in ("dover_tech", "dover_aes", "unimatch", "scene_cuts")], *[F.col(f"camera.{c}") for c in ("scale_cov", "fov_x", "fov_y", "focal_div")])


def backfill(clips: DataFrame, measured: DataFrame, field: str, keys=("source", "clip_id")) -> DataFrame:
    """``clips`` whose null metric ``field`` is filled from ``measured`` (keys and value, of which the least is taken); measured ones stay."""
    one = measured.groupBy(*keys).agg(F.min("value").alias("__v"))
    j = clips.join(one, list(keys), "left")
    return j.withColumn("metrics", F.col("metrics").withField(field, F.coalesce(F.col(f"metrics.{field}"), F.col("__v")))).drop("__v")
