"""Array aggregates, index plans and interpolation, in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_mean(a: Column) -> Column:
    return F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a))


def array_std(a: Column) -> Column:
    """Population deviation."""
    dev = lambda m: F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)) / F.size(a))
    return F.when(F.size(a) > 0, F.transform(F.array(array_mean(a)), dev)[0])


def scale_cov_eps(a: Column) -> Column:
    """deviation / (mean + 1e-8); an empty array is infinite."""
    return F.when(F.size(a) > 0, array_std(a) / (array_mean(a) + 1e-8)).otherwise(F.lit(float("inf")))


def scale_cov_abs(a: Column) -> Column:
    """deviation / |mean|; an empty array or a zero mean is infinite."""
    m = array_mean(a)
    return F.when((F.size(a) > 0) & (m != 0), array_std(a) / F.abs(m)).otherwise(F.lit(float("inf")))


def nearest_rank(a: Column, p: float) -> Column:
    """v[min(n-1, int(p/100 n))] of the sorted non-null values; null if there is none."""
    v = F.array_sort(F.filter(a, lambda x: x.isNotNull()))
    at = F.least(F.size(v) - 1, F.floor(F.lit(p / 100) * F.size(v)).cast("int"))
    return F.when(F.size(v) > 0, F.get(v, at))


def ema(a: Column, momentum: float = 0.99) -> Column:
    """Running mean m*e + (1-m)*x; an invalid entry repeats the last value, NaN before the first valid one."""
    nan = F.lit(float("nan"))
    bad = lambda x: x.isNull() | F.isnan(x)
    step = lambda acc, x: F.concat(acc, F.array(F.transform(F.array(F.when(F.size(acc) > 0, F.element_at(acc, -1)).otherwise(nan)), lambda e: F.when(bad(x), e).when(F.isnan(e), x).otherwise(F.lit(momentum) * e + F.lit(1 - momentum) * x))[0]))
    return F.when(F.size(a) > 0, F.aggregate(a, F.array().cast("array<double>"), step)).otherwise(F.array().cast("array<double>"))


def even_indices(count: Column, n: int) -> Column:
    """min(n, count), at least one, indices spread over 0..count-1; halves round to even."""
    m = F.greatest(F.least(F.lit(n), count), F.lit(1)).cast("int")
    at = lambda i: F.when(m == 1, F.lit(0)).otherwise(F.rint(i * (count - 1) / (m - 1)).cast("int"))
    return F.transform(F.sequence(F.lit(0), m - 1), at)


def timed_indices(total: Column, fps: Column, interval_s: float, max_s: float) -> Column:
    """Every max(1, round(fps*interval))-th frame of the first ``max_s``; a clip too short for two gives its ends."""
    stride = F.greatest(F.lit(1), F.rint(fps * interval_s)).cast("int")
    last = F.least(total - 1, F.rint(fps * max_s).cast("int")).cast("int")
    plan = F.sequence(F.lit(0), F.greatest(last, F.lit(0)), stride)
    pair = F.when(total > 1, F.array(F.lit(0), (total - 1).cast("int"))).otherwise(F.array(F.lit(0)))
    return F.when(F.size(plan) >= 2, plan).otherwise(pair)


def timestamps(duration: Column, tolerance: float = 0.0) -> Column:
    """0, 1, 2, ... one a second over the whole duration, at least one."""
    n = F.greatest(F.ceil(duration - tolerance), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: i.cast("double"))


def interpolate(keys: Column, n: Column) -> Column:
    """Key values stretched linearly to n frames; one key is repeated."""
    k = F.size(keys)
    pos = lambda i: i.cast("double") * (k - 1) / (n - 1)
    low = lambda i: F.least(F.floor(pos(i)).cast("int"), k - 2)
    mid = lambda i: F.get(keys, low(i)) + (pos(i) - low(i)) * (F.get(keys, low(i) + 1) - F.get(keys, low(i)))
    return F.when(k == 1, F.transform(F.sequence(F.lit(1), n), lambda _: keys[0])).when(k == n, keys).otherwise(F.transform(F.sequence(F.lit(0), n - 1), mid))


def half_up_indices(first: Column, step: Column, count: int, total: Column) -> Column:
    """``count`` indices from ``first`` on, ``step`` apart, halves rounded up, kept within 0..total-1."""
    at = lambda j: first + F.floor(j * step + 0.5)
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda j: F.least(F.greatest(at(j), F.lit(0)), total - 1).cast("int"))
