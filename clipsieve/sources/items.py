"""Work items of the sources: what one unit of acquisition is, read off a listing of paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Of each source, the paths that make a work item, and the part of them that names it.
LISTED = {
    "mira": r"^(.*shard-.*)\.tar$",
    "dl3dv": r"^(.*)/video\.mp4$",
    "mind": r"^(.*)/video\.mp4$",
    "sekai_walking": r"sekai-real-walking_part.*_(part\d+)\.tar$",
}
# Archives of realcam_vid, the part of it that is taken, groups and archives of spatialvid, and the items of a sekai_game that is not unpacked.
ARCHIVES, REALCAM_PART = r"\.(zip|tar\.gz|tgz|tar)$", "/RealEstate10K/"
SPATIAL_GROUPS, SPATIAL_ZIPS, SEKAI_WHOLE = 74, (5, 5), ("drone", "walking")


def _named(paths: DataFrame, pattern: str) -> DataFrame:
    return paths.select(F.regexp_extract("path", pattern, 1).alias("item")).where("item <> ''").distinct()


def _or_else(first: DataFrame, other: DataFrame) -> DataFrame:
    return other if first.isEmpty() else first


def work_items(spark: SparkSession, source: str, paths: DataFrame | None = None, *, records: DataFrame | None = None, game: str = "", stripes: int = 0) -> DataFrame:
    """(source, item), each once. ``paths`` has the relative paths of the source's files as path; ``records`` the episodes of
    abot with sample_id. ``game`` chooses the annotations of omniworld; ``stripes`` cuts each group of spatialvid into so many items, and
    without it its archives are the items. A source that no rule lists raises."""
    if source in LISTED:
        items = _named(paths, LISTED[source])
    elif source == "omniworld":
        items = _named(paths, rf"^annotations/\Q{game}\E/([^/]+)(?:/.*)?_others\.tar\.gz$")
    elif source == "sekai_game":  # a video counts only with its track beside it
        stems = lambda kind: _named(paths, rf"^(?:.*/)?([^/]+/[^/]+)\.{kind}$")
        items = _or_else(stems("mp4").join(stems("npz"), "item", "left_semi"), spark.createDataFrame([(x,) for x in SEKAI_WHOLE], "item string"))
    elif source == "realcam_vid":
        part = paths.where(F.col("path").contains(REALCAM_PART))
        items = _or_else(part.where(F.col("path").rlike(ARCHIVES)), part.where(F.col("path").endswith(".mp4"))).select(F.col("path").alias("item")).distinct()
    elif source == "abot":
        items = records.select(F.col("sample_id").alias("item")).where("item IS NOT NULL").distinct()
    elif source == "spatialvid" and stripes:
        items = spark.range(1, SPATIAL_GROUPS + 1).select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(stripes - 1)), lambda k: F.format_string("%04d#%d", F.col("id"), k))).alias("item"))
    elif source == "spatialvid":
        items = spark.range(1, SPATIAL_ZIPS[0] + 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(SPATIAL_ZIPS[1])), lambda z: F.format_string("%03d/data_%03d", F.col("id"), z))).alias("item"))
    else:
        raise NotImplementedError(f"no rule lists the items of {source!r}")
    return items.select(F.lit(source).alias("source"), "item")


def stem(path: Column) -> Column:
    """The file's name without folders and without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def path_by_key(paths: DataFrame, level: int = -2) -> DataFrame:
    """(key, path): the part of each path at ``level``, of several paths the least."""
    return paths.select(F.element_at(F.split("path", "/"), level).alias("key"), "path").where("key <> ''").groupBy("key").agg(F.min("path").alias("path"))


def with_metadata(clips: DataFrame, meta: DataFrame, path_col: str = "video_path") -> DataFrame:
    """``clips`` joined to the metadata (stem, align_factor, translation) of their file's stem, translations scaled by the factor (null: one)."""
    j = clips.join(meta.withColumnRenamed("stem", "__stem"), stem(F.col(path_col)) == F.col("__stem")).drop("__stem")
    return j.withColumn("translation", F.transform("translation", lambda x: x * F.coalesce("align_factor", F.lit(1.0))))


def requested(rows: DataFrame, ids: list, order: str, id_col: str = "sample_id", limit: int | None = None) -> DataFrame:
    """The rows of the named ids, all of which must be there, in the order of ``order``; then the first ``limit``. No ids: all rows."""
    if ids:
        rows = rows.where(F.col(id_col).isin(list(ids)))
        have = {r[0] for r in rows.select(id_col).distinct().limit(len(set(ids)) + 1).collect()}
        if missing := set(ids) - have:
            raise ValueError(f"no rows of {sorted(map(str, missing))[:5]}")
    return rows.orderBy(order).limit(limit) if limit is not None else rows.orderBy(order)
