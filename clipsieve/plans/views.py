"""The driver's tables in the roles of the engine's: documents as clips, labels as annotations, and so on.

Metrics that documents do not have are arithmetic of their id and length, the same in the SQL beside it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCES = [f"src{i}" for i in range(20)]
POLICIES = {
    s: {
        "min_frames": 200, "vmaf": [0.5, 9.0], "unimatch": [2.0, 38.0], "dover": [0.1, 1.0], "color_sat": [0, 90], "scene_cuts": 2, "vlm_quality": None if i % 2 else [3.0, 5.0],
        "vlm_reject_flags": ["blurry", "near_static"] if i % 3 else None, "vlm_reject_flags_forbidden": ["near_static"], "resolution": [1280, 720] if i % 4 == 0 else None, "require_caption": True, "vlm_transition_max": 1,
        "xhigh": {"vmaf": [1.0, 6.0], "scene_cuts": 0} if i % 5 else None,
    }
    for i, s in enumerate(SOURCES)
}
_LOCAL: list[str] = []
ORDER = ("src3", "src1", "src2", "src0")


def scratch(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it; on a single machine that names none, a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="clipsieve-"))
        atexit.register(shutil.rmtree, _LOCAL[0].removeprefix("file://"), ignore_errors=True)
    return _LOCAL[0]


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: what it took to make it is done once, whatever reads it how often."""
    path = f"{scratch(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    i, n = F.col("doc_id"), F.col("n_chars")
    dbl = lambda c: c.cast("double")
    flags = F.filter(F.array(F.when(F.col("toxic") == 1, F.lit("watermark")), F.when(i % 6 == 0, F.lit("blurry")), F.when(i % 9 == 0, F.lit("near_static"))), lambda x: x.isNotNull())
    cuts = F.struct(F.lit(None).cast("string").alias("label"), (i % 3).cast("int").alias("count"))
    metrics = F.struct(
        dbl(i % 50 * 2).alias("saturation"), F.when(i % 13 != 0, dbl(n % 100) / 10).alias("vmaf"), dbl(i % 40).alias("unimatch"), F.when(i % 11 != 0, dbl(i % 100) / 100).alias("dover_tech"), (dbl(n % 100) / 100).alias("dover_aes"),
        (i % 4).cast("int").alias("scene_cuts"), (1 + i % 3).cast("int").alias("vlm_entity_density"), (1.0 + F.col("quality") * 3.0).cast("double").alias("vlm_quality"), flags.alias("vlm_reject_flags"), cuts.alias("vlm_scene_transition"),
    )
    fov = lambda k: dbl(20 + (i * k) % 120)
    wide = lambda v: F.when(i % 2 == 0, v)
    camera = F.struct(fov(3).alias("fov_x"), fov(5).alias("fov_y"), (dbl(i % 30) / 100).alias("focal_div"), (dbl(i % 20) / 100).alias("scale_cov"), wide(fov(3) - 5).alias("fov_x_min"), wide(fov(3) + 5).alias("fov_x_max"), wide(fov(5) - 5).alias("fov_y_min"), wide(fov(5) + 5).alias("fov_y_max"), wide(dbl(i % 40) / 100).alias("focal_div_max"))
    annotation = F.when(F.col("quality").isNotNull(), F.struct((1.0 + F.col("quality") * 3.0).cast("double").alias("vlm_quality"), flags.alias("reject_flags"), cuts.alias("scene_transition"), F.col("text").alias("dense_caption")))
    return d.select(i.cast("string").alias("clip_id"), "doc_id", "source", n.cast("int").alias("num_frames"), F.when(i % 7 == 0, 640).otherwise(1280).alias("width"), F.lit(720).alias("height"), F.col("text").alias("caption"), F.array(F.lit(1.0), 1.0 + dbl(i % 5) / 20).alias("scale_factors"), metrics.alias("metrics"), camera.alias("camera"), annotation.alias("vlm"))


#: The same in SQL: a CTE c to put other queries after.
CLIPS_SQL = """
WITH c AS (SELECT CAST(d.doc_id AS VARCHAR) AS clip_id, d.doc_id, source, CAST(n_chars AS INT) AS num_frames,
  CASE WHEN d.doc_id % 7 = 0 THEN 640 ELSE 1280 END AS width, 720 AS height, text AS caption,
  [1.0::DOUBLE, 1.0 + CAST(d.doc_id % 5 AS DOUBLE) / 20] AS scale_factors,
  CAST(d.doc_id % 50 * 2 AS DOUBLE) AS saturation, CASE WHEN d.doc_id % 13 <> 0 THEN CAST(n_chars % 100 AS DOUBLE) / 10 END AS vmaf,
  CAST(d.doc_id % 40 AS DOUBLE) AS unimatch, CASE WHEN d.doc_id % 11 <> 0 THEN CAST(d.doc_id % 100 AS DOUBLE) / 100 END AS dover_tech,
  CAST(n_chars % 100 AS DOUBLE) / 100 AS dover_aes, d.doc_id % 4 AS scene_cuts, CAST(1.0 + quality * 3.0 AS DOUBLE) AS q,
  list_filter([CASE WHEN toxic = 1 THEN 'watermark' END, CASE WHEN d.doc_id % 6 = 0 THEN 'blurry' END, CASE WHEN d.doc_id % 9 = 0 THEN 'near_static' END], lambda x: x IS NOT NULL) AS flags,
  d.doc_id % 3 AS cuts, quality IS NOT NULL AS annotated,
  CAST(20 + (d.doc_id * 3) % 120 AS DOUBLE) AS fx, CAST(20 + (d.doc_id * 5) % 120 AS DOUBLE) AS fy, CAST(d.doc_id % 30 AS DOUBLE) / 100 AS fd, CAST(d.doc_id % 40 AS DOUBLE) / 100 AS fdm,
  CASE WHEN regexp_matches(source, '^src[0-9]+$') THEN CAST(substr(source, 4) AS INT) END AS i
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""


def _reasons_sql(vmaf: str, cuts: int, alias: str) -> str:
    return f"""list_filter([
  CASE WHEN coalesce(num_frames < 200, true) THEN 'num_frames' END,
  CASE WHEN i % 4 = 0 AND NOT coalesce(width = 1280 AND height = 720, false) THEN 'resolution' END,
  CASE WHEN regexp_replace(coalesce(caption, ''), '\\s+', '', 'g') = '' THEN 'caption' END,
  CASE WHEN NOT coalesce(vmaf BETWEEN {vmaf}, false) THEN 'vmaf' END,
  CASE WHEN NOT coalesce(unimatch BETWEEN 2 AND 38, false) THEN 'unimatch' END,
  CASE WHEN NOT coalesce(coalesce((dover_tech + dover_aes) / 2, dover_tech, dover_aes) BETWEEN 0.1 AND 1.0, false) THEN 'dover' END,
  CASE WHEN NOT coalesce(saturation BETWEEN 0 AND 90, false) THEN 'color_sat' END,
  CASE WHEN coalesce(scene_cuts > {cuts}, true) THEN 'scene_cuts' END,
  CASE WHEN i % 2 = 0 AND NOT coalesce(q BETWEEN 3 AND 5, false) THEN 'vlm_quality' END,
  CASE WHEN i % 3 <> 0 AND len(list_filter(flags, lambda f: f NOT IN ('blurry', 'near_static'))) > 0 THEN 'vlm_reject_flags' END,
  CASE WHEN list_contains(flags, 'near_static') THEN 'vlm_reject_flags' END,
  CASE WHEN coalesce(cuts > 1, true) THEN 'vlm_scene_transition' END], lambda x: x IS NOT NULL) AS {alias}"""


#: A second CTE j: c with kept_tier and reasons.
JUDGED_SQL = CLIPS_SQL + ", r AS (SELECT *, " + _reasons_sql("0.5 AND 9.0", 2, "k") + ", " + _reasons_sql("1.0 AND 6.0", 0, "x") + " FROM c), j AS (SELECT *, CASE WHEN len(k) > 0 THEN NULL WHEN i % 5 = 0 THEN 'high' WHEN len(x) = 0 THEN 'xhigh' ELSE 'high' END AS kept_tier FROM r)\n"
