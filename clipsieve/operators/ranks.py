"""Exact order statistics of groups of any size: a sketch brackets each wanted rank, and only the values within are sorted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Least rows of a group that is bracketed, the sketch's accuracy, half the width of a bracket (four times the
# sketch's greatest error), and the rows up to which a small table is gathered and broadcast.
LARGE, ACCURACY, MARGIN, FEW = 10_000, 2_000, 0.002, 10_000


def few(df: DataFrame) -> DataFrame:
    """``df`` computed once and broadcast if it has at most FEW rows; else as it is, for a shuffle join."""
    got = df.limit(FEW + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(got, df.schema)) if len(got) <= FEW else df


def same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def counted(rows: DataFrame, keys: list[str], value: str, then: list[str], shares: list[float]) -> DataFrame:
    """(keys, v, then, n, upto, total): how many rows have each value near the given shares of a group, and how many rows come up to it.
    Rows away from all shares are one row of null v a stretch. Null values count for nothing, though their group stays.

    Groups of more than LARGE rows get a bracket for each share from a mergeable sketch of fixed size; the counts are exact whatever the
    sketch says. ``place`` raises if a rank should not lie in its bracket."""
    d = rows.select(*keys, F.col(value).cast("double").alias("v"), *then)
    ends = [min(1.0, max(0.0, p + m)) for p in shares for m in (-MARGIN, MARGIN)]
    inf = float("inf")
    sketch = F.percentile_approx(F.when(F.isnan("v"), inf).otherwise(F.col("v")), F.array(*map(F.lit, ends)), F.lit(ACCURACY))
    large = few(d.groupBy(*keys).agg(F.count("v").alias("__n"), sketch.alias("__b")).where(F.col("__n") > LARGE).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__b"))
    low = lambda i: F.get("__b", F.lit(2 * i))
    high = lambda i: F.nullif(F.get("__b", F.lit(2 * i + 1)), F.lit(inf))  # noqa: E731  NaN sorts after it
    v, n = F.col("v"), range(len(shares))
    past = sum((F.coalesce((v > high(i)).cast("int"), F.lit(0)) for i in n), F.lit(0))
    within = F.col("__b").isNull() | reduce(lambda a, b: a | b, [(v >= low(i)) & F.coalesce(v <= high(i), F.lit(True)) for i in n])
    d = d.join(large, same(keys, [f"__k{i}" for i in range(len(keys))]), "left").withColumn("__in", F.coalesce(within, F.lit(False)))
    inside = [F.when(F.col("__in"), F.col(c)).alias(c) for c in ("v", *then)]
    c = d.groupBy(*keys, past.alias("__past"), "__in", *inside).agg(F.count(v).alias("n"))
    w = Window.partitionBy(*keys).orderBy("__past", "__in", "v", *then)
    return c.withColumns({"upto": F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)), "total": F.sum("n").over(Window.partitionBy(*keys))}).drop("__past")


def place(rank: Column) -> Column:
    """Whether a row of ``counted`` holds the rank (from 0); one outside the brackets raises."""
    here = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
    return F.when(here & ~F.col("__in"), F.raise_error(F.lit("a rank lies outside its bracket")).cast("boolean")).otherwise(here)


def medians(rows: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """(keys, name, n) with the exact median of the non-null values of each group and their number; as F.median, but no task holds a group."""
    c = counted(rows, keys, value, [], [0.5])
    at = [F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)]
    a, b = (F.max(F.when(place(r), F.col("v"))) for r in at)
    return c.groupBy(*keys).agg(a.alias("__a"), b.alias("__b"), F.max("total").alias("n")).select(*keys, F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise(0.5 * F.col("__a") + 0.5 * F.col("__b")).alias(name), "n")


def tiles(rows: DataFrame, key: str, first: str, second: str, parts: int, name: str) -> DataFrame:
    """``key``, ``first``, ``second`` and the tile (as ntile over key by first and second) of each row, none of them null but the key. Only the rows
    whose pair of values holds a bound between tiles are counted and dealt out anew; they are equal in both, so which copy goes where is all one."""
    d = rows.select(key, first, second)
    total = F.col("total")
    size = lambda t: F.lit(t) * F.floor(total / parts) + F.least(F.lit(t), total % parts)  # noqa: E731  rows of the first t tiles
    c = counted(d, [key], first, [second], [t / parts for t in range(1, parts)])
    bound = reduce(lambda a, b: a | b, [place(size(t)) for t in range(1, parts)])
    share = lambda t: F.least(F.col("upto"), size(t)) - F.greatest(F.col("upto") - F.col("n"), size(t - 1))
    pieces = F.filter(F.array(*[F.struct(F.lit(t).alias("tile"), share(t).cast("long").alias("copies")) for t in range(1, parts + 1)]), lambda x: x["copies"] > 0)
    edges = few(c.where(bound).select(F.col(key).alias("__key"), F.struct(F.col("v").alias("a"), F.col(second).alias("b"), pieces.alias("p")).alias("__e")).groupBy("__key").agg(F.sort_array(F.collect_list("__e")).alias("__e")))
    # bounds as plain columns, which are compared a row at a time without building structs
    edge = lambda i: F.get("__e", F.lit(i))
    flat = few(edges.select("__key", *[c for i in range(parts - 1) for c in (edge(i)["a"].alias(f"__a{i}"), edge(i)["b"].alias(f"__b{i}"), F.element_at(edge(i)["p"], -1)["tile"].alias(f"__t{i}"))]))
    x, y = F.col(first).cast("double"), F.col(second)
    on = reduce(lambda a, b: a | b, [(x == F.col(f"__a{i}")) & (y == F.col(f"__b{i}")) for i in range(parts - 1)])
    tile = F.greatest(F.lit(1), *[F.when((x > F.col(f"__a{i}")) | ((x == F.col(f"__a{i}")) & (y > F.col(f"__b{i}"))), F.col(f"__t{i}")) for i in range(parts - 1)])
    plain = d.join(flat, F.col(key).eqNullSafe(F.col("__key")), "left").where(~F.coalesce(on, F.lit(False))).select(key, first, second, tile.alias(name))
    cut = edges.select("__key", F.explode("__e").alias("e")).select("__key", "e", F.explode("e.p").alias("p"))
    # copies in two steps, so that no array has more than 65,536 entries for 4 billion of them
    cut = cut.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("p.copies") - 1, F.lit(65_536).cast("long"))))
    cut = cut.withColumn("s", F.explode(F.sequence(F.col("s"), F.least(F.col("p.copies"), F.col("s") + 65_536) - 1)))
    kind = d.schema[first].dataType
    return plain.unionByName(cut.select(F.col("__key").alias(key), F.col("e.a").cast(kind).alias(first), F.col("e.b").alias(second), F.col("p.tile").alias(name)))
