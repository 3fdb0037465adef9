"""The sources a corpus knows, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Pose mode of each source, and for given poses whether they are metric.
DEFAULT = ("spatialvid", "dl3dv", "sekai_walking", "miradata", "mind", "openvid", "vidgen", "ditto")
GIVEN = {"omniworld": True, "multicamvideo": True, "realcam_vid": True, "zod": True, "sekai_game": False, "abot": False}


def source_table(spark: SparkSession) -> DataFrame:
    rows = [(s, "default", None) for s in DEFAULT] + [(s, "gt_pose", m) for s, m in GIVEN.items()]
    return spark.createDataFrame(rows, "source string, pose_mode string, metric boolean")


def with_mode(df: DataFrame, source_col: str = "source") -> DataFrame:
    """``df`` with pose_mode and metric; an unknown source raises. The table has a row a source and is broadcast."""
    dim = F.broadcast(source_table(df.sparkSession).withColumnRenamed("source", "__s"))
    j = df.join(dim, df[source_col] == F.col("__s"), "left")
    mode = F.when(F.col("__s").isNull(), F.raise_error(F.concat(F.lit("unknown source "), F.coalesce(F.col(source_col), F.lit("null")))).cast("string")).otherwise(F.col("pose_mode"))
    return j.withColumn("pose_mode", mode).drop("__s")
