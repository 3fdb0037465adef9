"""Corpus assembly: payloads, exclusions, side tables, judgement, audit, dedup and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.specs import on_spec
from . import dedup, judge, semantic

# Files that a clip must have.
REQUIRED = ("video.mp4", "poses.npy", "intrinsics.npy", "meta.json")


def side_tables(meta: DataFrame, annotations: DataFrame, tracks: DataFrame | None = None, keys=("source", "clip_id")) -> DataFrame:
    """``meta`` with vlm (a struct, null where unannotated) and traj (null where unmeasured). Hash or sort-merge joins on
    the keys; equal keys of a side table are one row by its least value."""
    keys = list(keys)
    one = lambda df, name: df.groupBy(*keys).agg(F.min(F.struct(*[c for c in df.columns if c not in keys])).alias(name))
    d = meta.join(one(annotations, "vlm"), keys, "left")
    return d.join(one(tracks, "traj"), keys, "left") if tracks is not None else d


def assemble(clips: DataFrame, files: DataFrame, policies: DataFrame, *, exclusions: DataFrame | None = None, camera: Column | None = None, preset: str = "off", require_track: bool = False, order=dedup.PRIORITY, exempt=()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(judged, train, collisions). Clips need source, clip_id, num_frames, the judged columns and vlm.

    Incomplete payloads and excluded ids leave before judging; off-spec lengths, unusable tracks and preset hits are
    reasons; train is what is kept after first-wins dedup by source."""
    whole = dedup.complete_payload(files, REQUIRED).where("complete").select("source", "clip_id")
    d = clips.join(whole, ["source", "clip_id"], "left_semi")
    if exclusions is not None:
        d = dedup.drop_listed(d, exclusions)
    d = judge.judge(d, policies, camera)
    extra = [F.when(~on_spec(F.col("num_frames")), F.struct(F.lit("offspec_length").alias("code"), F.col("num_frames").cast("string").alias("value")))]
    if require_track:
        extra.append(F.when(F.coalesce(~F.col("traj.ok"), F.lit(False)), F.struct(F.lit("nonfinite_poses").alias("code"), F.lit(None).cast("string").alias("value"))))
    d = d.withColumn("reject_reasons", F.concat("reject_reasons", F.filter(F.array(*extra), lambda r: r.isNotNull())))
    d = d.withColumn("semantic_hits", semantic.audit_hits(F.col("vlm")))
    drop = F.when(semantic.preset_drops(F.col("semantic_hits"), preset), F.array(F.struct(F.lit(f"semantic_{preset}").alias("code"), F.array_join("semantic_hits", ",").alias("value")))).otherwise(F.array().cast("array<struct<code:string,value:string>>"))
    d = d.withColumn("reject_reasons", F.concat("reject_reasons", drop))
    d = d.withColumn("kept_tier", F.when(F.size("reject_reasons") == 0, F.col("kept_tier")))
    kept, lost = dedup.first_wins(d.where("kept_tier IS NOT NULL"), order=order, exempt=exempt)
    return d, kept, lost


def report(judged: DataFrame, kept: DataFrame, lost: DataFrame) -> DataFrame:
    """One row a source: seen, kept, reject histogram and audit histogram as maps."""
    pairs = lambda col, name: judged.select("source", F.explode(col).alias("x")).groupBy("source", "x").count().groupBy("source").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("x", "count")))).alias(name))
    seen = judged.groupBy("source").agg(F.count("*").alias("clips_seen"), F.count("kept_tier").alias("technically_kept"))
    out = seen.join(kept.groupBy("source").agg(F.count("*").alias("kept")), "source", "left")
    out = out.join(lost.groupBy(F.col("dropped_source").alias("source")).agg(F.count("*").alias("collisions")), "source", "left")
    return out.join(pairs(F.transform("reject_reasons", lambda r: r["code"]), "reject_histogram"), "source", "left").join(pairs("semantic_hits", "semantic_audit"), "source", "left").na.fill(0, ["kept", "collisions"])
