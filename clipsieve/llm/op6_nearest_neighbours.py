"""Approximate nearest neighbours by a hash-prefix forest.

Rows are dealt to shards by the hash of their id. In a shard each of ``trees`` trees is one sorted
array of long hash strings, bits of signs of random projections about the mean. A query descends every tree at
once to the length of its longest matching prefix there, then all trees ascend together, a prefix bit at a time, until
the ranges that share the prefix hold together ``reach`` of the shard's different vectors;
candidates are compared exactly. The best of every shard are merged by query.
Near-isotropic vectors have no near neighbour in any useful sense, so ``reach`` is a share and
recall does not fall as tables grow; it is measured against brute force in the tests.

Equal vectors are one leaf that keeps the k+1 smallest ids, which is all an answer of k can need, so
a vector held by a third of all rows costs as much as any other. Every query visits every
shard: a task searches one shard of about ``shard_rows`` rows for one block of about ``query_block`` queries, and
neither grows with the tables, but the number of such tasks is that of shards times that of blocks.

Vectors that are null, zero, of another length than the most common one, or hold null or non-finite components take no part, neither do
rows with a null id. Of repeated ids, each row is a candidate; of an id that is queried with several vectors, the
smallest vector is the query.
Empty tables give no rows. Further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable, table


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.where(F.coalesce(fine, F.lit(False)))
    width = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return v.where(F.size("v") == (width[0][0] if width else 0))


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of rows with q; equal rows get equal values."""
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * math.sqrt(float((q * q).sum())))


class Forest:
    def __init__(self, x: np.ndarray, trees: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        centred = x / np.sqrt((x * x).sum(1))[:, None]
        self.mean, self.planes = centred.mean(0) if len(x) > 1 else np.zeros(x.shape[1]), rng.normal(size=(x.shape[1], trees * bits))
        self.trees, self.bits, self.n = trees, bits, len(x)
        keys = self.keys(centred)
        self.order = np.argsort(keys, axis=0, kind="stable")
        self.sorted = np.take_along_axis(keys, self.order, 0)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """(rows, trees) hash strings, first bit highest."""
        sign = ((unit - self.mean) @ self.planes > 0).reshape(len(unit), self.trees, self.bits)
        return (sign * (np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64))).sum(2, dtype=np.uint64)

    def candidates(self, q: np.ndarray, reach: float):
        """For each query the places of its candidates."""
        key = self.keys(q / np.sqrt((q * q).sum(1))[:, None])
        low = np.zeros((self.bits + 1, *key.shape), np.int64)
        high = np.full_like(low, self.n)
        for depth in range(1, self.bits + 1):
            rest = np.uint64(self.bits - depth)
            first = (key >> rest) << rest
            last = first | ((np.uint64(1) << rest) - np.uint64(1))
            for t in range(self.trees):
                low[depth, :, t] = np.searchsorted(self.sorted[:, t], first[:, t], "left")
                high[depth, :, t] = np.searchsorted(self.sorted[:, t], last[:, t], "right")
        for i in range(len(q)):
            depth = self.bits
            mark = np.zeros(self.n, bool)
            while True:
                for t in range(self.trees):
                    mark[self.order[low[depth, i, t] : high[depth, i, t], t]] = True
                if depth == 0 or mark.sum() >= reach * self.n:
                    break
                # no level can suffice whose ranges, even if they met nowhere, are too short
                depth -= 1
                while depth and (high[depth, i] - low[depth, i]).sum() < reach * self.n:
                    depth -= 1
            yield np.flatnonzero(mark)


def nearest(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, trees: int = 16, bits: int = 40, reach: float = 0.75, shard_rows: int = 20_000, query_block: int = 2_000, seed: int = 11) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of each query row, itself left out by id."""
    spark = vectors.sparkSession
    rows = durable(usable(vectors, id_col, vec_col))
    asked = usable(queries, id_col, vec_col).groupBy("id").agg(F.min("v").alias("v"))
    # equal vectors: k+1 smallest ids; the rank limit is applied before the shuffle as well as after
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    leaves = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    n = rows.count()
    if n == 0:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    shards = max(1, math.ceil(n / shard_rows))
    blocks = max(1, math.ceil(asked.count() / query_block))
    # a task holds one shard and one block of queries, each of them bounded, however many there are
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    leaves = durable(leaves).select(F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block"), F.lit(False).alias("asks"), "ids", "v")
    asked = asked.select(every(shards).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(True).alias("asks"), F.array("id").alias("ids"), "v")

    def run(key, tile):
        x, ids, q, qid = [], [], [], []
        for b in tile.to_batches():
            asks = b.column(2).to_numpy(zero_copy_only=False)
            width = len(b.column(4)[0]) if b.num_rows else 0
            m = b.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            lists = b.column(3).to_pylist()
            x.append(m[~asks])
            ids += [lists[i] for i in np.flatnonzero(~asks)]
            q.append(m[asks])
            qid += [lists[i][0] for i in np.flatnonzero(asks)]
        x, q = np.concatenate(x), np.concatenate(q)
        order = np.argsort([i[0] for i in ids], kind="stable")
        x, ids = x[order], [ids[i] for i in order]
        out: list = []
        if len(x) and len(q):
            forest = Forest(x, trees, bits, seed)
            unit = x / np.sqrt((x * x).sum(1))[:, None]
            for i, cand in enumerate(forest.candidates(q, reach)):
                s = unit[cand] @ (q[i] / np.sqrt((q[i] * q[i]).sum()))
                top = min(len(cand), k + 1)
                edge = np.partition(s, len(s) - top)[len(s) - top]
                cand = cand[s >= edge - 1e-9]
                s = exact(x[cand], q[i])
                best = sorted((-float(c), v) for c, j in zip(s, cand, strict=True) for v in ids[j] if v != qid[i])[:k]
                out += [(qid[i], v, -c) for c, v in best]
        cols = list(zip(*out, strict=True)) if out else [[]] * 3
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "id", "score"])

    found = leaves.unionByName(asked).groupBy("shard", "block").applyInArrow(run, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(v, v.where(F.col("vec_id") % 50 == 0))
