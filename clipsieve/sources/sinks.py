"""Writers: recipes, reports, create-only overlays and tar shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_manifest(df: DataFrame, path: str) -> None:
    """JSON lines; the committer publishes all part files or none."""
    df.write.mode("overwrite").json(path)


def write_by_owner(df: DataFrame, path: str, owner: str = "source") -> None:
    """One directory an owner, rows of an owner spread over as many files as their share asks for."""
    df.repartition(owner, F.pmod(F.xxhash64(*[c for c in df.columns if c != owner][:1]), F.lit(16))).write.mode("overwrite").partitionBy(owner).json(path)


def write_recipe(train: DataFrame, test: DataFrame, report: DataFrame, path: str) -> None:
    train.write.mode("overwrite").json(f"{path}/train")
    test.write.mode("overwrite").json(f"{path}/test")
    report.coalesce(1).write.mode("overwrite").json(f"{path}/report")


def write_overlay(df: DataFrame, path: str) -> None:
    """Create-only; a marker is written last."""
    df.write.mode("errorifexists").json(f"{path}/data")
    df.sparkSession.range(1).select(F.lit("complete").alias("state")).coalesce(1).write.mode("errorifexists").json(f"{path}/COMPLETE")


def write_missing(df: DataFrame, path: str, key: str) -> DataFrame:
    """Appends the rows whose key is not there yet and returns them; a repeat of the call adds nothing."""
    spark = df.sparkSession
    try:
        have = spark.read.parquet(path).select(key).distinct()
    except Exception as e:  # noqa: BLE001  only an absent table counts as empty
        if "PATH_NOT_FOUND" not in str(e):
            raise
        new = df
    else:
        new = df.join(have, key, "left_anti")
    new.write.mode("append").parquet(path)
    return new


def write_shards(shards: DataFrame, path: str) -> DataFrame:
    """Writes (shard, tar) as one file each below a folder that all executors mount, and returns (shard, file, bytes).

    Each task writes under a name of its own attempt and renames, so a repeated task leaves one whole file."""
    import os
    import uuid

    import pandas as pd

    def put(batches):
        for pdf in batches:
            out = []
            for shard, tar in zip(pdf["shard"], pdf["tar"], strict=True):
                os.makedirs(path, exist_ok=True)
                name = f"{path}/shard-{shard}.tar"
                part = f"{name}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(tar)
                os.replace(part, name)
                out.append((str(shard), name, len(tar)))
            yield pd.DataFrame(out, columns=["shard", "file", "bytes"])

    return shards.select("shard", "tar").mapInPandas(put, "shard string, file string, bytes long")
