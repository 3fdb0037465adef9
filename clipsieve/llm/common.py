"""Shared plumbing: reading tables, Arrow byte views, and durable intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it; on a single machine that names none, a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    # one machine, as in tests; the setting stays unset, so that nothing takes this folder for a shared one
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="clipsieve-"))
        atexit.register(shutil.rmtree, _LOCAL[0].removeprefix("file://"), ignore_errors=True)
    return _LOCAL[0]


def durable(df: DataFrame) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back: lineage ends there, and
    an executor that is lost takes no part of it along."""
    path = f"{shared_dir(df.sparkSession)}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column_bytes(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, n+1 offsets) of a string or binary column without a copy; null counts as empty."""
    arr = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_null(arr.type):
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    arr = pc.fill_null(arr, b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], name: str, max_bytes: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts the batches into runs of whole rows of about ``max_bytes`` of the named column, so that
    the arrays derived from them stay small whatever the lengths are."""
    for batch in batches:
        data, offs = column_bytes(batch, name)
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
            yield batch.slice(lo, hi - lo), data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            lo = hi


_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)


def run_hashes(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the runs of 64-bit ``values`` that begin at ``at``, each up to the next one: polynomials in all of a run's values, however
    long it is, that do not depend on where it stands. Zeros at a run's end count for nothing."""
    up = np.cumprod(np.full(len(values), _STEP, np.uint64), dtype=np.uint64)
    down = np.cumprod(np.full(len(values), _BACK, np.uint64), dtype=np.uint64)
    return np.add.reduceat(values * up, at) * down[at]


def out_batch(schema: list[tuple[str, pa.DataType]], *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for (_, t), c in zip(schema, cols, strict=True)], names=[n for n, _ in schema])


def forget(spark: SparkSession, *tables: list[str]) -> None:
    """Deletes the files of ``durable`` tables, given by their inputFiles, that nothing reads any more, and lets Spark drop
    the shuffle files of DataFrames that the caller has let go."""
    import gc

    delete(spark, *tables)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, *tables: list[str]) -> None:
    """Deletes the files of ``durable`` tables, given by their inputFiles, that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for d in {f.rsplit("/", 1)[0] for files in tables for f in files}:
        path = jvm.org.apache.hadoop.fs.Path(d)
        path.getFileSystem(conf).delete(path, True)
