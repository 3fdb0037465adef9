"""Clip specs and configuration files."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named specs as (frames, frames a second).
SPECS = {"5s": (121, 24), "60s": (1437, 24), "81f": (81, 16), "160f": (160, 16), "960f": (960, 16)}
# Frames a model needs for a target length.
MODEL_FRAMES = {81: 121, 160: 241}


def parse_spec(name: str) -> tuple[int, float]:
    if name in SPECS:
        return SPECS[name]
    m = re.fullmatch(r"(\d+)@(\d+(?:\.\d+)?)", name.strip())
    if not m or int(m[1]) < 1 or float(m[2]) <= 0:
        raise ValueError(f"unknown clip spec {name!r}")
    return int(m[1]), float(m[2])


def spec_of_frames(n: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, (frames, _) in SPECS.items():
        out = F.when(n == frames, name).otherwise(out)
    return out


def on_spec(n: Column) -> Column:
    return F.coalesce(n.isin(*[f for f, _ in SPECS.values()]), F.lit(False))


def latent_aligned(frames: Column) -> Column:
    return F.pmod(frames - 1, F.lit(4)) == 0


def slice_plan(n: Column) -> Column:
    """(start, frames) of the stretch that is cleaned: the first 160, else the middle 81, else none."""
    pair = lambda a, b: F.struct(a.cast("int").alias("start"), b.alias("frames"))
    return F.when(n >= 160, pair(F.lit(0), F.lit(160))).when(n >= 81, pair(F.floor((n - 81) / 2), F.lit(81)))


def expand(value, env=None):
    """${NAME} in all strings of a nested configuration; unset names stay as they are."""
    env = os.environ if env is None else env
    if isinstance(value, dict):
        return {k: expand(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v, env) for v in value]
    return re.sub(r"\$\{(\w+)\}", lambda m: env.get(m[1], m[0]), value) if isinstance(value, str) else value


def load_config(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return expand(yaml.safe_load(f))
