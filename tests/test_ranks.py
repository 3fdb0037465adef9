import math
import random
import statistics

from pyspark.sql import functions as F

from clipsieve.operators import ranks, robust


def _groups():
    random.seed(5)
    inf, nan = float("inf"), float("nan")
    return {
        "wide": [random.lognormvariate(0, 3) - 1 for _ in range(25_001)], "few": [float(random.randrange(3)) for _ in range(24_000)], "one": [2.0] * 15_000, "ends": [-inf] * 6_000 + [inf] * 6_000, "nan": [1.0] * 5_000 + [nan] * 9_000,
        "small": [3.0, 1.0, 2.0, 5.0], "lone": [7.0], None: [random.random() for _ in range(12_000)],
    }


def test_medians_of_large_groups(spark):
    groups = _groups()
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("wide", None), ("empty", None)]
    d = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got = {r.k: (r.m, r.n) for r in ranks.medians(d, ["k"], "v", "m").collect()}
    want = {r.k: r.m for r in d.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert set(got) == set(want) == {*groups, "empty"} and got["empty"] == (None, 0)
    assert all(got[k][1] == len(v) for k, v in groups.items())
    assert all(got[k][0] == m or math.isnan(got[k][0]) and math.isnan(m) for k, m in want.items())


def test_best_scale_holds_no_group(spark):
    """The residuals of a key are not gathered in one task's map."""
    d = spark.range(30_000).select(F.lit("a").alias("k"), (1.0 + F.col("id") % 977).alias("near"), (1.5 * (1.0 + F.col("id") % 977) + (F.col("id") * 7919 % 1000) / 1000.0).alias("far"))
    out = robust.best_scale(d, "k", "near", "far", [1.0, 1.5, 2.0])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan and "median(" not in plan
    r = out.first()
    want = statistics.median(abs(1.5 * x.near - x.far) / x.far for x in d.collect())
    assert r.scale == 1.5 and math.isclose(r.residual, want, rel_tol=1e-12)


def test_collisions_whatever_the_order_of_rows(spark):
    """Rows come in another order each time that Spark computes them."""
    import pandas as pd

    from clipsieve.operators import dedup

    def shuffled(batches):
        import os

        for pdf in batches:
            yield pdf.sample(frac=1, random_state=int.from_bytes(os.urandom(4), "little"))

    rows = pd.DataFrame({"clip_id": [f"c{i % 40}" for i in range(400)], "source": [f"s{i % 3}" for i in range(400)]})
    d = spark.createDataFrame(rows).repartition(4).mapInPandas(shuffled, "clip_id string, source string")
    kept, lost = dedup.first_wins(d, order=("s1", "s0"))
    assert kept.count() == 40 and {r.source for r in kept.collect()} == {"s1"}
    assert lost.count() == 360 and {r.kept_source for r in lost.collect()} == {"s1"}
    assert lost.where("dropped_source = 's1'").count() == sum(i % 3 == 1 for i in range(400)) - 40


def test_gaps_are_filled_in_one_pass(spark):
    """No frame begins at the row, which Spark folds anew for each row of a track."""
    d = spark.createDataFrame([("a", 0, -1.0), ("a", 1, 1.0), ("a", 2, None), ("a", 3, 900.0), ("a", 5, 3.0), ("a", 6, 0.0), ("b", 0, None)], "k string, at int, v double")
    out = robust.fill_gaps(d, "k", "at", "v", F.lit(7.0))
    assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted((r.k, r["at"], r.v) for r in out.collect()) == [("a", 0, 1.0), ("a", 1, 1.0), ("a", 2, 1.5), ("a", 3, 2.0), ("a", 5, 3.0), ("a", 6, 3.0), ("b", 0, 7.0)]


def test_tiles_of_large_groups(spark):
    random.seed(6)
    rows = [(k, float(random.randrange(m)), random.randrange(4)) for k, n, m in (("a", 30_011, 10**6), ("b", 20_007, 7), (None, 12_345, 1), ("c", 17, 5), ("d", 3, 2)) for _ in range(n)]
    d = spark.createDataFrame(rows, "k string, a double, b int").repartition(3)
    got = sorted(((str(r.k), r.a, r.b, r.t) for r in ranks.tiles(d, "k", "a", "b", 10, "t").collect()))
    from pyspark.sql import Window

    want = d.withColumn("t", F.ntile(10).over(Window.partitionBy("k").orderBy("a", "b")))
    assert got == sorted((str(r.k), r.a, r.b, r.t) for r in want.collect())
