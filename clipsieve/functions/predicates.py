"""Null- and NaN-safe gate predicates. A gate without a bound passes; a bound with a missing or NaN value fails."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def range_fails(value, lo, hi) -> Column:
    """Outside [lo, hi] while ``lo`` is set; containment, so NaN fails."""
    return _c(lo).isNotNull() & ~F.coalesce(_c(value).between(_c(lo), _c(hi)), F.lit(False))


def outside(value, lo, hi) -> Column:
    """Not contained in [lo, hi]; null stays null."""
    return ~_c(value).between(_c(lo), _c(hi))


def over_fails(value, bound) -> Column:
    return _c(bound).isNotNull() & F.coalesce(_c(value) > _c(bound), F.lit(True))


def under_fails(value, bound) -> Column:
    return _c(bound).isNotNull() & F.coalesce(_c(value) < _c(bound), F.lit(True))


def flags_not_allowed(flags, allowed) -> Column:
    return _c(allowed).isNotNull() & F.coalesce(F.size(F.array_except(_c(flags), _c(allowed))) > 0, F.lit(True))


def flags_forbidden(flags, forbidden) -> Column:
    return _c(forbidden).isNotNull() & (_c(flags).isNull() | F.coalesce(F.arrays_overlap(_c(flags), _c(forbidden)), F.lit(False)))


def reason(fails: Column, code: str, value: Column | None = None) -> Column:
    shown = F.lit(None).cast("string") if value is None else value.cast("string")
    return F.when(fails, F.struct(F.lit(code).alias("code"), shown.alias("value")))


def all_reasons(*reasons: Column) -> Column:
    """Those that fired, in gate order."""
    return F.filter(F.array(*reasons), lambda r: r.isNotNull())


def first_reason(*pairs: tuple[str, Column], otherwise: str = "ok") -> Column:
    """The code of the first condition that holds (null counts as not)."""
    out = F.lit(otherwise)
    for code, cond in reversed(pairs):
        out = F.when(cond, F.lit(code)).otherwise(out)
    return out


def codes(reasons) -> Column:
    return F.transform(_c(reasons), lambda r: r["code"])
