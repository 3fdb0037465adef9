"""First-wins dedup across sources, collisions, and key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Sources in the order in which their copy of a clip wins.
PRIORITY = ("dl3dv", "omniworld", "sekai_game", "multicamvideo", "zod", "realcam_vid", "spatialvid", "sekai_walking", "miradata", "openvid", "vidgen", "ditto")


def priority(source, order=PRIORITY):
    out = F.lit(99)
    for i, name in enumerate(order):
        out = F.when(source == name, i).otherwise(out)
    return out


def first_wins(df: DataFrame, key: str = "clip_id", source: str = "source", order=PRIORITY, exempt=(), then=()) -> tuple[DataFrame, DataFrame]:
    """(kept, collisions): of each key the row of the best source, then by source name, ``then`` and the hash of the whole row; exempt sources
    pass. Every other row of the key is a collision, also one that is equal to the kept row in all columns, or whose source
    is null. A rank filter drops all but the first of each task before the shuffle on the key.

    Collisions come from counts of equal rows, one copy less of the winner's, so that they do not hang on the order in which rows arrive,
    which is another one whenever Spark computes ``df`` anew."""
    free = F.coalesce(F.col(source).isin(*exempt), F.lit(False)) if exempt else F.lit(False)
    whole = F.xxhash64(*[f.name for f in df.schema if "map<" not in f.dataType.simpleString()])
    by = ["__p", source, *then, "__h"]
    w = Window.partitionBy(key).orderBy(*by)
    ranked = df.where(~free).withColumns({"__p": priority(F.col(source), order), "__h": whole})
    kept = ranked.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__p", "__h")
    best = F.struct("__p", F.col(source).alias("kept_source"), *then, "__h")
    equal = ranked.groupBy(key, *by).agg(F.count("*").alias("n"))
    winner = equal.groupBy(F.col(key).alias("__key")).agg(F.min(best).alias("w"), F.sum("n").alias("all")).where(F.col("all") > 1)
    lost = equal.join(winner, F.col(key).eqNullSafe(F.col("__key"))).withColumn("n", F.col("n") - F.when(best.eqNullSafe(F.col("w")), 1).otherwise(0)).where("n > 0")
    # a row a copy, in two steps, so that no array has more than 65,536 entries for 4 billion copies
    lost = lost.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(65_536).cast("long"))))
    lost = lost.withColumn("s", F.explode(F.sequence(F.col("s"), F.least(F.col("n"), F.col("s") + 65_536) - 1)))
    return (kept.unionByName(df.where(free)) if exempt else kept), lost.select(key, F.col(source).alias("dropped_source"), F.col("w.kept_source").alias("kept_source"))


def drop_listed(df: DataFrame, listed: DataFrame, keys=("source", "clip_id")) -> DataFrame:
    return df.join(listed.select(*keys).distinct(), list(keys), "left_anti")


def complete_payload(files: DataFrame, required, keys=("source", "clip_id"), name: str = "name") -> DataFrame:
    """(keys, complete, missing) of every clip from its listing, names gathered as a set of the required ones only."""
    need = F.array(*map(F.lit, sorted(required)))
    have = F.collect_set(F.when(F.col(name).isin(*required), F.col(name)))
    return files.groupBy(*keys).agg(have.alias("have")).withColumn("missing", F.array_sort(F.array_except(need, "have"))).withColumn("complete", F.size("missing") == 0).drop("have")


def colliding_keys(df: DataFrame, ident: str, key: str) -> DataFrame:
    """(key, ids) of keys that stand for more than one id."""
    return df.groupBy(key).agg(F.count_distinct(ident).alias("ids")).where("ids > 1")


def check_injective(df: DataFrame, ident: str, key: str) -> None:
    bad = colliding_keys(df, ident, key).take(3)
    if bad:
        raise ValueError(f"keys of more than one id: {[r[0] for r in bad]}")


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, with the side."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
