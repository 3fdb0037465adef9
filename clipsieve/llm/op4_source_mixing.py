"""Mixing sources to target weights by Pfair scheduling.

Each source's rows, in the order of md5(id), are cut into blocks of ``block_rows``. A source's weight w is its
exact rational share of the sum of the weights, and its block j is released at slot floor((j-1) / w) and due at
ceil(j / w), over the whole run. Earliest deadline first gives every source less than one block of deviation from
its target weight at every slot, however long the run is. If the weights' common denominator is at most
``frame``, all lags are zero after so many slots and one table of slots serves the whole run, whatever its length. Only for given weights of a larger
denominator the driver schedules each block once, without visiting empty slots, and its work and its table grow with the blocks.
Without given weights the targets are whole slots of a frame (``default_weights``), so that the driver's work is one frame.
A source that has run out leaves its slots empty; the others keep their relative rates.

Blocks are numbered without gathering a source: ranks within (source, first hex digits of the
md5) plus the counts of the earlier buckets. A null source is a source of its own, named null; a
null id hashes as the empty string; ties are broken by the id and the text's hash. Repeated rows
stay. Other columns pass through; ``slot`` and ``seq`` are replaced where they clash.
"""

from __future__ import annotations

import heapq
import math
from array import array
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

MAX_SOURCES = 100_000
#: The table of slots is broadcast while it has at most this many rows; beyond it the join shuffles by block.
BROADCAST_SLOTS = 200_000
#: The counts of a source's buckets are at most 4,096 a source, whatever the rows; they are broadcast for up to 48 sources.
BROADCAST_STARTS = 200_000


def frame_counts(weights: dict, frame: int) -> dict:
    """Slots of a frame for each source, by largest remainder with at least one each."""
    total = sum(Fraction(w) for w in weights.values())
    if any(w <= 0 for w in weights.values()) or frame < len(weights):
        raise ValueError("weights must be positive and a frame needs a slot for every source")
    order = sorted(weights, key=lambda s: (s is not None, str(s)))
    exact = {s: Fraction(weights[s]) / total * frame for s in order}
    got = {s: max(1, int(exact[s])) for s in order}
    while sum(got.values()) > frame:  # slots for sources of less than one come from those furthest over their share
        got[max((s for s in order if got[s] > 1), key=lambda s: got[s] - exact[s])] -= 1
    for s in sorted(order, key=lambda s: got[s] - exact[s])[: frame - sum(got.values())]:
        got[s] += 1
    return got


def default_weights(sizes: dict, temperature: float, frame: int) -> dict:
    """The targets of a run without given weights: row counts to the power ``temperature``, as whole slots of a frame, one at least.

    These whole numbers are the weights that the lags are held against; they are within a slot of the powers' shares, but for sources of under one."""
    return frame_counts({s: n**temperature for s, n in sizes.items()}, frame)


def whole_shares(weights: dict) -> tuple[dict, int]:
    """(k, n): every source's weight as exactly k of n, n the least common denominator."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    total = sum(Fraction(w) for w in weights.values())
    exact = {s: Fraction(w) / total for s, w in weights.items()}
    n = math.lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * n) for s, x in exact.items()}, n


def edf_frame(counts: dict, frame: int) -> list:
    """The source of each slot of a frame: of the released blocks, the one with the earliest deadline."""
    order = sorted(counts, key=lambda s: (s is not None, str(s)))
    due = lambda s, j: -(-j * frame // counts[s])
    waiting = [(0, i, 1) for i in range(len(order))]
    heapq.heapify(waiting)
    ready: list = []
    out = []
    for t in range(frame):
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due(order[i], j), i, j))
        d, i, j = heapq.heappop(ready)
        if d <= t:
            raise AssertionError("a deadline was missed")
        out.append(order[i])
        if j < counts[order[i]]:
            heapq.heappush(waiting, (j * frame // counts[order[i]], i, j + 1))
    return out


def edf_run(shares: dict, n: int, blocks: dict) -> dict:
    """For each source the slots of its ``blocks`` blocks under the weights shares / n; a source's end leaves the others' windows as they are."""
    order = sorted(shares, key=lambda s: (s is not None, str(s)))
    k, many = [shares[s] for s in order], [blocks[s] for s in order]
    waiting = [(0, i, 1) for i in range(len(order)) if many[i]]
    heapq.heapify(waiting)
    ready: list = []
    out = [array("q") for _ in order]
    t = 0
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * n // k[i]), i, j))
        d, i, j = heapq.heappop(ready)
        if d <= t:
            raise AssertionError("a deadline was missed")
        out[i].append(t)
        t += 1
        if j < many[i]:
            heapq.heappush(waiting, (j * n // k[i], i, j + 1))
    return dict(zip(order, out, strict=True))


def mix(docs: DataFrame, weights: dict | None = None, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", block_rows: int = 16, frame: int | None = None, temperature: float = 0.5) -> DataFrame:
    """``docs`` with ``slot`` (the block's place in the interleaving) and ``seq`` (the row's place in
    its block); order by both to read the mixture. Without ``weights``,
    they are ``default_weights``. Sources not named in ``weights`` raise."""
    spark = docs.sparkSession
    docs = docs.drop("slot", "seq")
    sizes = {r[0]: r[1] for r in docs.groupBy(F.col(source_col).alias("s")).count().limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources")
    frame = frame or max(1000, 10 * len(sizes))
    if weights is None:
        weights = default_weights(sizes, temperature, max(frame, len(sizes)))
    if missing := set(sizes) - set(weights):
        raise ValueError(f"no weight for {sorted(map(str, missing))[:5]}")
    schema = docs.withColumns({"slot": F.lit(0).cast("long"), "seq": F.lit(0)}).schema
    if not sizes:
        return spark.createDataFrame([], schema)
    weights = {s: w for s, w in weights.items() if s in sizes}
    shares, turn = whole_shares(weights)
    blocks = {s: -(-sizes[s] // block_rows) for s in weights}
    number = {s: i for i, s in enumerate(weights)}
    if turn <= frame:
        where: dict = {s: [] for s in weights}
        for t, s in enumerate(edf_frame(shares, turn)):
            where[s].append(t)
    else:
        where, shares = edf_run(shares, turn, blocks), blocks
    plan = pa.table({"__i": np.repeat(np.array([*number.values()], np.int32), [len(where[s]) for s in weights]), "__j": np.concatenate([np.arange(len(where[s]), dtype=np.int64) for s in weights]), "__t": np.concatenate([np.asarray(where[s], np.int64) for s in weights])})
    slots = spark.createDataFrame(plan)
    if plan.num_rows <= BROADCAST_SLOTS:
        slots = F.broadcast(slots)
    kind = docs.schema[source_col].dataType.simpleString()

    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.withColumn("__key", key).withColumn("__bucket", F.substring("__key", 1, 3))
    starts = rows.groupBy(F.col(source_col).alias("__src"), F.col("__bucket").alias("__b")).agg(F.count("*").alias("__n"))
    starts = starts.withColumn("__before", F.sum("__n").over(Window.partitionBy("__src").orderBy("__b")) - F.col("__n")).drop("__n")
    rank = F.row_number().over(Window.partitionBy(source_col, "__bucket").orderBy("__key", id_col, F.xxhash64(text_col)))
    rows = rows.withColumn("__rank", rank)
    rows = rows.join(F.broadcast(starts) if len(sizes) * 4096 <= BROADCAST_STARTS else starts, F.col(source_col).eqNullSafe(F.col("__src")) & (F.col("__bucket") == F.col("__b")))
    rows = rows.withColumn("__at", F.col("__before") + F.col("__rank") - 1).withColumn("__block", F.floor(F.col("__at") / block_rows))
    ks = F.broadcast(spark.createDataFrame([(s, i, shares[s]) for s, i in number.items()], f"__ks {kind}, __ki int, __kk long"))
    rows = rows.join(ks, F.col(source_col).eqNullSafe(F.col("__ks"))).withColumn("__in", F.col("__block") % F.col("__kk"))
    rows = rows.join(slots, (F.col("__ki") == F.col("__i")) & (F.col("__in") == F.col("__j")))
    slot = F.floor(F.col("__block") / F.col("__kk")) * F.lit(turn if turn <= frame else 0) + F.col("__t")
    return rows.withColumns({"slot": slot.cast("long"), "seq": (F.col("__at") % block_rows).cast("int")}).select(*schema.names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "slot", "seq")
