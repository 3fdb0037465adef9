"""Shard plans: partitions by tier, greedy size-bounded groups, fixed-size archives and tar shards."""

from __future__ import annotations

import bisect
import io
import itertools
import tarfile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Files of a clip, in the order in which a shard holds them.
MEMBERS = ("meta.json", "video.mp4", "poses.npy", "intrinsics.npy", "prompt.txt")
#: Bytes that stand for a null size: with them a shard never fills.
NEVER = -(1 << 61)


def partition_of(tier: Column, judged: Column) -> Column:
    """kept-xhigh, kept-high, or rejected for a judged null; an unjudged clip or another tier raises."""
    return (
        F.when(~judged, F.raise_error(F.lit("a clip without kept_tier was never judged")).cast("string"))
        .when(tier.isNull(), "rejected")
        .when(tier.isin("xhigh", "high"), F.concat(F.lit("kept-"), tier))
        .otherwise(F.raise_error(F.concat(F.lit("unknown kept_tier "), tier)).cast("string"))
    )


def lane_table(sizes: list, limit: int) -> list[tuple[int, int, int]]:
    """(reach, shards, used) of the rows of a lane that can begin its first new shard: the lane's bytes up to the row, with it, and
    the shards from there to the lane's end with the bytes of the last. The row for ``used`` bytes carried in is the first whose reach passes ``limit - used``."""
    at = [0, *itertools.accumulate(sizes)]
    n = len(sizes)
    shards, used = [1] * n, [0] * n
    high, rows = [], []  # rows whose reach passes all between, last first, so that the negated reaches ascend
    for i in range(n - 1, -1, -1):
        k = bisect.bisect_left(high, -(at[i] + limit)) - 1
        if k < 0:
            used[i] = at[n] - at[i]
        else:
            shards[i], used[i] = shards[rows[k]] + 1, used[rows[k]]
        while high and high[-1] >= -at[i + 1]:
            high.pop()
            rows.pop()
        high.append(-at[i + 1])
        rows.append(i)
    out = []
    for h, i in zip(reversed(high), reversed(rows), strict=True):
        out.append((-h, shards[i], used[i]))
        if -h > limit:  # no lower bytes carried in go further
            break
    return out


def plan_shards(df: DataFrame, limit: int, partition: str, order: str, size: str, lane_rows: int = 100_000) -> DataFrame:
    """``df`` with shard, the greedy plan: a new shard when the next clip would pass ``limit``; an oversize clip is alone.

    The fold runs over lanes of ``lane_rows`` rows of a partition, so that no partition is gathered. Each lane first gives a table
    of where its plan ends for any bytes carried in (``lane_table``); the tables are chained over the few lanes, and each lane is then
    planned from its true start. So shard is one running number a partition, whatever ``lane_rows`` is. Sizes are at least 0; a
    null size leaves the shard open for good. Equal ``order`` is broken by size."""
    kind = df.schema[partition].dataType.simpleString()
    d = df.withColumn("__at", F.row_number().over(Window.partitionBy(partition).orderBy(order, size))).withColumn("lane", F.floor((F.col("__at") - 1) / lane_rows))
    rows = d.select(F.col(partition).alias("p"), "lane", "__at", F.coalesce(F.col(size).cast("long"), F.lit(NEVER)).alias("s"))

    def tabled(pdf: pd.DataFrame) -> pd.DataFrame:
        s = pdf.sort_values("__at")["s"].tolist()
        t = pd.DataFrame(lane_table(s, limit), columns=["reach", "shards", "used"])
        t["used"] = t["used"].clip(lower=NEVER)
        return t.assign(p=pdf["p"].iloc[0], lane=pdf["lane"].iloc[0], total=max(sum(s), NEVER))[["p", "lane", "reach", "shards", "used", "total"]]

    def chained(pdf: pd.DataFrame) -> pd.DataFrame:
        shard, used, out = -1, None, []
        for lane, t in pdf.sort_values(["lane", "reach"]).groupby("lane", sort=True):
            out.append((pdf["p"].iloc[0], lane, shard, used))
            reach = t["reach"].tolist()
            k = 0 if used is None else bisect.bisect_right(reach, limit - used)
            if k < len(reach):
                shard, used = shard + int(t["shards"].iloc[k]), int(t["used"].iloc[k])
            else:
                used = max(used + int(t["total"].iloc[0]), NEVER)
        return pd.DataFrame(out, columns=["p", "lane", "shard", "used"]).astype({"used": "Int64"})

    def planned(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__at")
        shard, used, out = int(pdf["shard"].iloc[0]), int(pdf["used"].iloc[0]), []
        for s in pdf["s"].tolist():
            if shard < 0 or used + s > limit:
                shard, used = shard + 1, s
            else:
                used += s
            out.append(shard)
        return pdf[["p", "__at"]].assign(shard=out)

    tables = rows.groupBy("p", "lane").applyInPandas(tabled, f"p {kind}, lane long, reach long, shards long, used long, total long")
    starts = tables.groupBy("p").applyInPandas(chained, f"p {kind}, lane long, shard int, used long")
    starts = starts.select(F.col("p").alias("__sp"), F.col("lane").alias("__sl"), "shard", F.coalesce("used", F.lit(0)).alias("used"))
    begun = rows.join(starts, F.col("p").eqNullSafe(F.col("__sp")) & (F.col("lane") == F.col("__sl"))).select("p", "lane", "__at", "s", "shard", "used")
    plan = begun.groupBy("p", "lane").applyInPandas(planned, f"p {kind}, __at int, shard int").select(F.col("p").alias("__p"), F.col("__at").alias("__a"), "shard")
    return d.join(plan, F.col(partition).eqNullSafe(F.col("__p")) & (F.col("__at") == F.col("__a"))).drop("__at", "__p", "__a")


def archive_groups(df: DataFrame, n: int = 200, partition: str = "source", order: str = "clip_id") -> DataFrame:
    w = Window.partitionBy(partition).orderBy(order)
    return df.withColumn("group_id", F.floor((F.row_number().over(w) - 1) / n).cast("int"))


def tar_shards(members: DataFrame) -> DataFrame:
    """(shard, tar, bytes, clips) from rows (shard, key, name, content): members in their fixed order, a clip's together.

    One group is one shard, whose size the plan bounds."""
    rank = {m: i for i, m in enumerate(MEMBERS)}

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        buf = io.BytesIO()
        rows = rows.assign(at=rows["name"].map(rank)).sort_values(["key", "at"])
        with tarfile.open(fileobj=buf, mode="w") as tar:
            for key, name, content in rows[["key", "name", "content"]].itertuples(index=False):
                info = tarfile.TarInfo(f"{key}.{name}")
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
        data = buf.getvalue()
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "tar": [data], "bytes": [len(data)], "clips": [rows["key"].nunique()]})

    kind = members.schema["shard"].dataType.simpleString()
    return members.where(F.col("name").isin(*MEMBERS)).groupBy("shard").applyInPandas(build, f"shard {kind}, tar binary, bytes long, clips long")


def read_tars(files: DataFrame) -> DataFrame:
    """(path, key, name, content) of the members of tar files given as (path, content). Files reach Python by the hundred, not by the
    Arrow batch, which holds up to 10,000 of them."""

    def members(content: bytes):
        with tarfile.open(fileobj=io.BytesIO(content)) as tar:
            return [(*m.name.split(".", 1), tar.extractfile(m).read()) for m in tar if m.isfile()]

    read = F.udf(members, "array<struct<key:string,name:string,content:binary>>", useArrow=False)
    return files.select("path", F.explode(read("content")).alias("m")).select("path", "m.key", "m.name", "m.content")
