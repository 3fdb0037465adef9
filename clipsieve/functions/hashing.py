"""Stable keys: split ranks, shards, seeded numbers and file-safe names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_rank(sample_id: Column) -> Column:
    """First 64 bits of the sha256 as fixed-width hex: sorts as the unsigned integer. A null id is the empty one."""
    return F.substring(F.sha2(F.coalesce(sample_id.cast("string"), F.lit("")), 256), 1, 16)


def md5_shard(sample_id: Column, shards: int) -> Column:
    """md5 as a 128-bit integer modulo ``shards``, from its two halves."""
    wide = lambda at: F.conv(F.substring(F.md5(sample_id.cast("string")), at, 16), 16, 10).cast("decimal(20,0)") % shards
    return (((wide(1) * (2**64 % shards)) + wide(17)) % shards).cast("int")


def crc_shard(sample_id: Column, shards: int) -> Column:
    return F.pmod(F.crc32(sample_id.cast("string")), F.lit(shards)).cast("int")


def item_hash(item: Column) -> Column:
    return F.substring(F.sha1(item.cast("string")), 1, 16)


def seed_integer(sample_id: Column) -> Column:
    return F.conv(F.substring(F.sha1(sample_id.cast("string")), 1, 8), 16, 10).cast("long")


def seeded(sample_id: Column, lo: float, hi: float, salt: str = "") -> Column:
    """Deterministic number in [lo, hi] from sha1(id:salt)."""
    part = F.conv(F.substring(F.sha1(F.concat_ws(":", sample_id.cast("string"), F.lit(salt))), 1, 8), 16, 10).cast("double")
    return F.lit(lo) + part / F.lit(float(0xFFFFFFFF)) * F.lit(hi - lo)


def shard_key(sample_id: Column) -> Column:
    """Characters other than letters, digits, _ and - become _."""
    return F.regexp_replace(sample_id, "[^A-Za-z0-9_-]", "_")


def path_key(item: Column) -> Column:
    return F.translate(item, "/.", "__")
