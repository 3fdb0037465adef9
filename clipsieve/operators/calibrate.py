"""Threshold calibration from nearest-rank percentiles, and systematic samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest_ranks(df: DataFrame, by: str, values: dict[str, list[float]]) -> DataFrame:
    """For each group and column v, columns v_pNN = sorted(v)[min(n-1, int(p/100 n))] of the non-null values.

    Counts by value come first, so a group with a third of all rows is ranked over its different values; percentiles are
    read from the running counts."""
    out = None
    for name, ps in values.items():
        c = df.where(F.col(name).isNotNull()).groupBy(by, F.col(name).alias("v")).agg(F.count("*").alias("n"))
        w = Window.partitionBy(by).orderBy("v")
        c = c.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(by)))
        at = lambda p: F.least(F.col("total") - 1, F.floor(F.lit(p / 100) * F.col("total")))
        row = c.groupBy(by).agg(*[F.min(F.when(F.col("upto") > at(p), F.col("v"))).alias(f"{name}_p{p:g}") for p in ps])
        out = row if out is None else out.join(row, by, "full")
    return out


def flag_rates(df: DataFrame, by: str, flags: str, names) -> DataFrame:
    f = F.coalesce(F.col(flags), F.array().cast("array<string>"))
    return df.groupBy(by).agg(F.count("*").alias("n"), *[(F.count_if(F.array_contains(f, x)) / F.count("*")).alias(f"rate_{x}") for x in names])


def systematic_sample(df: DataFrame, by: str, ident: str, k: int) -> DataFrame:
    """Every max(1, n//k)-th row of each group in the order of the id, at most k of them."""
    w = Window.partitionBy(by).orderBy(ident)
    d = df.withColumn("__i", F.row_number().over(w) - 1).withColumn("__step", F.greatest(F.lit(1), F.floor(F.count("*").over(Window.partitionBy(by)) / k)))
    return d.where((F.col("__i") % F.col("__step") == 0) & (F.col("__i") / F.col("__step") < k)).drop("__i", "__step")


def policy_rows(measured: DataFrame, elite: bool) -> DataFrame:
    """Gate bounds of each group from percentile columns flow, dover, vmaf and sat, unrounded."""
    lo, hi = ("flow_p5", "flow_p75") if elite else ("flow_p2", "flow_p90")
    top = "p90" if elite else "p97"
    return measured.withColumns({"vmaf": F.array(F.lit(0.5), F.col(f"vmaf_{top}")), "unimatch": F.array(lo, hi), "dover": F.array(F.col("dover_p50" if elite else "dover_p25"), F.lit(1.0)), "color_sat": F.array(F.lit(0.0), F.col(f"sat_{top}"))})
