"""Growing directories as streams: decoding, first-seen dedup, retry state and idempotent batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import crc_shard
from ..sources.manifest import decode


def clip_stream(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    """Clip records of JSON-lines files as they arrive; ``files_at_once`` holds back a fast producer."""
    return decode(spark.readStream.option("maxFilesPerTrigger", files_at_once).text(path), strict=False)


def table_stream(spark: SparkSession, path: str, schema, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def unseen(stream: DataFrame, key: str, time: str | None = None, late: str = "1 day") -> DataFrame:
    """The first row of each key; with a time column, state older than ``late`` is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key]) if time else stream.dropDuplicates([key])


def shard_of(stream: DataFrame, key: str, index: int, count: int) -> DataFrame:
    return stream.where(crc_shard(F.col(key), count) == index)


def attempts(stream: DataFrame, key: str, failed: str, max_attempts: int = 3) -> DataFrame:
    """Running (key, tries, failures, state): done once one try worked, closed at ``max_attempts`` failures, else open."""
    g = stream.groupBy(key).agg(F.count("*").alias("tries"), F.count_if(failed).alias("failures"))
    done = F.col("failures") < F.col("tries")
    return g.withColumn("state", F.when(done, "done").when(F.col("failures") >= max_attempts, "closed").otherwise("open"))


def event_counts(stream: DataFrame, time: str, by: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def run_once(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Works off what is there in micro-batches and stops. ``batch`` gets an id that a repeated batch keeps, so
    writing to a folder named by it makes the sink idempotent."""
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    return lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}")
