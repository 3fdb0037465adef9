"""Readers of many small files give their rows on in frames of bounded size."""

import struct

import pandas as pd

from clipsieve.sources import manifest


class Files:
    """Stands for a DataFrame of files, to see the frames that a reader makes."""

    def __init__(self, contents):
        self.pdf = pd.DataFrame({"path": [str(i) for i in range(len(contents))], "content": contents})

    def select(self, *_):
        return self

    def mapInPandas(self, f, schema):
        return list(f(iter([self.pdf, self.pdf])))


def _cameras(n):
    return struct.pack("<Q", n) + b"".join(struct.pack("<iiQQ3d", i, 0, 8, 8, 1.0, 2.0, 3.0) for i in range(n))


def test_frames_of_binary_files():
    small = manifest.camera_binary(Files([_cameras(1)] * 7000))
    assert [len(x) for x in small] == [7000, 7000]
    large = manifest.camera_binary(Files([_cameras(25_000), _cameras(0)]))
    assert [len(x) for x in large] == [10_000, 10_000, 5_000] * 2 and large[2]["camera_id"].iloc[-1] == 24_999
    image = struct.pack("<Qi7di", 1, 7, *[1.0] * 7, 3) + b"a.jpg\0" + struct.pack("<Q", 0)
    assert [len(x) for x in manifest.image_binary(Files([image] * 30))] == [30, 30]


def test_jobs_judge_once(spark):
    """The split, its check and both sides read the eligible rows, not what it took to judge them."""
    from pyspark.sql import functions as F

    from clipsieve.plans import jobs

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    d = spark.range(20).select(F.lit("o").alias("owner"), F.col("id").cast("string").alias("clip_id"), F.lit("high").alias("kept_tier"), F.lit(400).alias("num_frames")).mapInPandas(count, "owner string, clip_id string, kept_tier string, num_frames int")
    train, test = jobs.build_window_view(d, 200, per_owner=5)
    assert (train.count(), test.count(), seen.value) == (30, 10, 20)
    seen.value = 0
    train, test, report = jobs.build_recipe(d, per_owner=5)
    assert (train.count(), test.count(), report.first().eligible, seen.value) == (15, 5, 20, 20)


def test_tars_do_not_come_by_the_arrow_batch(spark):
    from clipsieve.operators import packing

    d = spark.createDataFrame([(i % 2, f"k{i}", n, b"x" * i) for i in range(6) for n in ("meta.json", "video.mp4")], "shard int, key string, name string, content binary")
    tars = packing.tar_shards(d).selectExpr("CAST(shard AS STRING) AS path", "tar AS content")
    out = packing.read_tars(tars)
    assert "MapInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.path, r.key, r.name, bytes(r.content)) for r in out.collect()) == sorted((str(i % 2), f"k{i}", n, b"x" * i) for i in range(6) for n in ("meta.json", "video.mp4"))


def test_pointers_are_made_distinct_once(spark):
    from clipsieve.operators import lineage

    kept = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", "b"), ("s", "z"), (None, "a")], "source string, clip_id string")
    m = spark.createDataFrame([("s", "b", 1), ("s", "a", 1), ("s", "a", 1), ("s", "a", 2), ("s", "c", 2), (None, "a", 3)], "source string, clip_id string, item int")
    pointers, unmapped = lineage.export_pointers(kept, m)
    plan = pointers._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert sorted((r.source, r.item, r.kept_clips) for r in pointers.collect()) == [("s", 1, ["a", "b"]), ("s", 2, ["a"])]
    assert sorted((str(r.source), r.clip_id) for r in unmapped.collect()) == [("None", "a"), ("s", "z")]
