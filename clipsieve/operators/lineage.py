"""Lineage of derived clips: eligibility of sources, planned intervals, kept sources and delivery checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import all_reasons, reason
from ..functions.specs import slice_plan

# Rate and least size of a source, size and rate of an output, source of each derived owner's clips.
FPS, LEAST_SIZE, OUTPUT_SIZE = 16, (1280, 720), (1280, 720)


def source_reasons(fps="fps", width="width", height="height", num_frames="num_frames", pose_frames="pose_frames", intr_frames="intr_frames") -> Column:
    f, w, h, n, p, i = (F.col(c) for c in (fps, width, height, num_frames, pose_frames, intr_frames))
    return all_reasons(
        reason(F.coalesce(F.isnan(f) | (F.abs(f - FPS) > 0.01), F.lit(True)), "fps", f),
        reason(w.isNull() | h.isNull(), "resolution_unknown"),
        reason(w < h, "not_landscape"),
        reason((w < LEAST_SIZE[0]) | (h < LEAST_SIZE[1]), "too_small"),
        reason(n.isNull(), "num_frames_unknown"),
        reason(n < 81, "too_short", n),
        reason(p != n, "poses", p),
        reason(i != n, "intrinsics", i),
    )


def kept_source_reasons(clean: DataFrame, kept: DataFrame, owner: str, source_id: str = "source_clip_id", kept_id: str = "clip_id") -> DataFrame:
    """``clean`` with lineage_reasons: its source must be recorded and be among the kept ids."""
    k = kept.select(F.col(kept_id).alias("__k")).distinct()
    j = clean.join(k, clean[source_id] == k["__k"], "left")
    blank = F.coalesce(F.col(source_id), F.lit("").cast(clean.schema[source_id].dataType)).cast("string") == "" if clean.schema[source_id].dataType.simpleString() == "string" else F.col(source_id).isNull()
    return j.withColumn("lineage_reasons", all_reasons(reason(blank, "no_source_clip_id"), reason(~blank & F.col("__k").isNull(), f"recipe_lineage_not_in_{owner}_kept_source"))).drop("__k")


def interval_reasons(source_frames: Column, start: Column, length: Column, fps: Column, width: Column, height: Column) -> Column:
    plan = slice_plan(source_frames)
    none = start.isNull() | length.isNull()
    return all_reasons(
        reason(none, "no_interval"),
        reason((start < 0) | (start + length > source_frames), "outside_source"),
        reason(plan.isNotNull() & ((start != plan["start"]) | (length != plan["frames"])), "not_planned"),
        reason(fps != FPS, "fps", fps),
        reason((width.isNotNull() | height.isNotNull()) & ~F.coalesce((width == OUTPUT_SIZE[0]) & (height == OUTPUT_SIZE[1]), F.lit(False)), "size"),
    )


def plan_tasks(clips: DataFrame, kept: DataFrame, key: str = "clip_id") -> tuple[DataFrame, DataFrame]:
    """(tasks, rejected): clips of the kept set whose contract holds, with their stretch; else the first reason."""
    k = kept.select(F.col(key).alias("__k")).distinct()
    j = clips.join(k, clips[key] == k["__k"], "left").withColumn("__r", F.concat(F.when(F.col("__k").isNull(), F.array(F.lit("not_kept"))).otherwise(F.array().cast("array<string>")), F.transform(source_reasons(), lambda r: r["code"]))).drop("__k")
    plan = slice_plan(F.col("num_frames"))
    tasks = j.where(F.size("__r") == 0).drop("__r").withColumns({"source_start_frame": plan["start"], "target_frames": plan["frames"]})
    return tasks, j.where(F.size("__r") > 0).withColumn("reason", F.get("__r", F.lit(0))).drop("__r")


def slice_track(track: Column, start: Column, length: Column) -> Column:
    return F.slice(track, start + 1, length)


def export_pointers(kept: DataFrame, manifests: DataFrame, source="source", clip="clip_id", item="item") -> tuple[DataFrame, DataFrame]:
    """(pointers, unmapped): the sorted kept clips of each (source, item), and kept clips that no item holds."""
    keys = [source, clip]
    m, k = manifests.select(source, clip, item), kept.select(*keys)
    # the set of an item takes repeats away, so that neither side is made distinct, with its tables in memory, before the join
    pointers = m.join(k, keys, "left_semi").groupBy(source, item).agg(F.sort_array(F.collect_set(clip)).alias("kept_clips"))
    return pointers, k.distinct().join(m, keys, "left_anti")
