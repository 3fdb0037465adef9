"""Leak-free splits, repeats and fixed-length window views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import split_rank

TIERS = ("xhigh", "high")


def _lowest(df: DataFrame, owner: str, clip: str, n: int) -> DataFrame:
    """The n rows of lowest rank of each owner. A rank filter on a window: each task keeps n rows an owner before the shuffle."""
    w = Window.partitionBy(owner).orderBy(split_rank(F.col(clip)), clip)
    return df.select(owner, clip).withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def eligible(df: DataFrame, tiers=TIERS, tier_col: str = "kept_tier") -> DataFrame:
    if odd := set(tiers) - set(TIERS):
        raise ValueError(f"unknown tiers {sorted(odd)}")
    return df.where(F.col(tier_col).isin(*tiers))


def train_test(df: DataFrame, per_owner: int = 100, owner: str = "owner", clip: str = "clip_id") -> tuple[DataFrame, DataFrame]:
    """(train, test): the ``per_owner`` lowest ranks of each owner are test. Tier and length filters go before this.

    The test rows, at most ``per_owner`` an owner, are what is joined; a large owner is never gathered."""
    marks = _lowest(df, owner, clip, per_owner).distinct().withColumnsRenamed({owner: "__o", clip: "__c"})
    on = F.col(owner).eqNullSafe(F.col("__o")) & F.col(clip).eqNullSafe(F.col("__c"))
    return df.join(marks, on, "left_anti"), df.join(marks, on, "left_semi")


def with_repeat(train: DataFrame, repeats: dict[str, int], owner: str = "owner") -> DataFrame:
    factor = F.lit(1)
    for name, n in repeats.items():
        factor = F.when(F.col(owner) == name, n).otherwise(factor)
    return train.withColumn("repeat", factor.cast("int"))


def check_owners(df: DataFrame, wanted, owner: str = "owner") -> None:
    """Raises if a named owner has no row."""
    have = {r[0] for r in df.where(F.col(owner).isin(*wanted)).select(owner).distinct().collect()}
    if missing := set(wanted) - have:
        raise ValueError(f"no rows of owner {sorted(missing)}")


def check_split(train: DataFrame, test: DataFrame, keys=("owner", "clip_id")) -> None:
    """Raises on an overlap of the two, or a key twice in one."""
    both = train.select(*keys, F.lit(1).alias("t")).unionByName(test.select(*keys, F.lit(0).alias("t")))
    n = both.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("t").alias("sides")).where("n > 1").agg(F.count_if(F.col("sides") > 1), F.count("*")).first()
    if n[0]:
        raise ValueError(f"{n[0]} keys are in train and test")
    if n[1]:
        raise ValueError(f"{n[1]} keys occur more than once")


def windows(num_frames: Column, length: int) -> Column:
    """Starts of the whole non-overlapping windows; null below one window, so that explode gives no row."""
    n = F.floor(num_frames / length).cast("int")
    return F.when(n >= 1, F.transform(F.sequence(F.lit(0), n - 1), lambda i: i * length))


def window_rows(df: DataFrame, length: int, frames_col: str = "num_frames") -> DataFrame:
    """A row a window, with start_frame and num_frames = length; windows inherit their clip's side."""
    return df.withColumn("start_frame", F.explode(windows(F.col(frames_col), length))).withColumn(frames_col, F.lit(length))


def fits(df: DataFrame, window: int, min_frames: int = 0, max_frames: int | None = None, frames_col: str = "num_frames") -> DataFrame:
    n = F.col(frames_col)
    ok = n >= max(window, min_frames)
    return df.where(ok & (n <= max_frames) if max_frames is not None else ok)


def source_windows(df: DataFrame, seconds: float, target_fps: float, target_frames: int, fps_col: str = "fps", frames_col: str = "num_frames", clip: str = "clip_id") -> DataFrame:
    """Windows of ``seconds`` of each header, with their frame picks for the target rate; rates below the target give none."""
    span = F.greatest(F.lit(2), F.rint(F.col(fps_col) * seconds).cast("int"))
    d = df.withColumn("__span", span).where(F.col(fps_col) >= target_fps).where(F.col(frames_col) >= F.col("__span"))
    d = d.withColumn("window", F.explode(F.sequence(F.lit(0), (F.floor(F.col(frames_col) / F.col("__span")) - 1).cast("int"))))
    pick = F.transform(F.sequence(F.lit(0), F.lit(target_frames - 1)), lambda j: F.least(F.col(frames_col) - 1, F.col("window") * F.col("__span") + F.rint(j * F.col("__span") / target_frames)).cast("int"))
    name = F.when(F.col("window") == 0, F.col(clip)).otherwise(F.concat(F.col(clip), F.lit("_w"), F.lpad(F.col("window").cast("string"), 3, "0")))
    return d.withColumns({"window_id": name, "frames": pick}).drop("__span")


def split_report(df: DataFrame, test: DataFrame, repeats: dict[str, int] | None = None, owner: str = "owner") -> DataFrame:
    """(owner, eligible, test, train, repeat, virtual)."""
    t = test.groupBy(F.col(owner).alias("__o")).agg(F.count("*").alias("test"))
    r = df.groupBy(owner).agg(F.count("*").alias("eligible")).join(t, F.col(owner).eqNullSafe(F.col("__o")), "left").drop("__o")
    r = with_repeat(r.withColumn("test", F.coalesce("test", F.lit(0))), repeats or {}, owner)
    return r.withColumn("train", F.col("eligible") - F.col("test")).withColumn("virtual", F.col("train") * F.col("repeat"))
