"""Semantic rules over annotation records: per-source policy blocks, audit rules and presets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import all_reasons, reason

# Rule bundles.
PRESETS = {
    "off": (),
    "wide": ("scene_transition", "near_static", "blurry", "single_color", "quality_lt3"),
    "elite": ("scene_transition", "near_static", "blurry", "single_color", "quality_lt4", "watermark", "ui_overlay", "text_heavy"),
}
# Audit rules that are reject flags of the same name.
FLAG_RULES = ("near_static", "blurry", "single_color", "watermark", "ui_overlay", "text_heavy", "low_light")
KEYS = ("quality_min", "quality_max", "transition_max", "flags_allowed", "flags_forbidden", "caption_required", "path_min_m", "path_max_m")


def audit_rules(v: Column) -> dict[str, Column]:
    """Name to condition over an annotation struct. A missing quality counts as 0, missing flags as none."""
    flags = F.coalesce(v["reject_flags"], F.array().cast("array<string>"))
    q = F.coalesce(v["vlm_quality"], F.lit(0.0))
    cuts = F.coalesce(v["scene_transition"]["count"], F.lit(0))
    return {"scene_transition": cuts > 0, **{f: F.array_contains(flags, f) for f in FLAG_RULES}, "quality_lt3": q < 3, "quality_lt4": q < 4}


def audit_hits(v: Column) -> Column:
    """Names of the rules that an annotated clip breaks; an unannotated clip breaks none."""
    hits = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in audit_rules(v).items()]), lambda n: n.isNotNull())
    return F.when(v.isNull(), F.array().cast("array<string>")).otherwise(hits)


def preset_drops(hits: Column, preset: str) -> Column:
    names = PRESETS[preset]
    return F.arrays_overlap(hits, F.array(*map(F.lit, names))) if names else F.lit(False)


def audit_counts(clips: DataFrame, v: Column, source_col: str = "source") -> DataFrame:
    """One row a source with the number of clips that each rule would drop."""
    return clips.where(v.isNotNull()).groupBy(source_col).agg(*[F.count_if(c).alias(n) for n, c in audit_rules(v).items()])


def config_reasons(v: Column, block: dict, path: Column | None = None) -> Column:
    """Ordered reasons of one source's block; an unannotated clip fails any block, an unmeasured path any path bound."""
    if odd := set(block) - set(KEYS):
        raise KeyError(f"unknown semantic keys {sorted(odd)}")
    path = F.lit(None).cast("double") if path is None else path
    known = v.isNotNull()
    q, flags = v["vlm_quality"], F.coalesce(v["reject_flags"], F.array().cast("array<string>"))
    lit = lambda names: F.array(*map(F.lit, names)).cast("array<string>")
    get = block.get
    out = []
    if get("path_min_m") is not None or get("path_max_m") is not None:
        out.append(reason(path.isNull(), "path_unmeasured"))
    if get("path_min_m") is not None:
        out.append(reason(F.coalesce(path < get("path_min_m"), F.lit(False)), "path_min"))
    if get("path_max_m") is not None:
        out.append(reason(F.coalesce((path > get("path_max_m")) & ~F.isnan(path), F.lit(False)), "path_max"))
    if block:
        out.append(reason(~known, "vlm_missing"))
    if get("quality_min") is not None:
        out.append(reason(known & F.coalesce(q < get("quality_min"), F.lit(True)), "q_min"))
    if get("quality_max") is not None:
        out.append(reason(known & F.coalesce(q > get("quality_max"), F.lit(True)), "q_max"))
    if get("transition_max") is not None:
        out.append(reason(known & (F.coalesce(v["scene_transition"]["count"], F.lit(0)) > get("transition_max")), "transition"))
    if get("flags_allowed") is not None:
        out.append(reason(known & (F.size(F.array_except(flags, lit(get("flags_allowed")))) > 0), "flags"))
    if get("flags_forbidden"):
        out.append(reason(known & F.arrays_overlap(flags, lit(get("flags_forbidden"))), "flags"))
    if get("caption_required"):
        out.append(reason(known & (F.regexp_replace(F.coalesce(v["dense_caption"], F.lit("")), r"\s+", "") == ""), "caption_empty"))
    return all_reasons(*out) if out else F.array().cast("array<struct<code:string,value:string>>")
