"""Reproducible samples: a row is chosen by a hash of its id, the round and the seed.

The choice depends on these values alone, not on partitions, files or the order of
rows, so a repeated task, another cluster and another engine choose the same rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42


def hash_fraction(*parts: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of the MD5 of the parts, joined by colons."""
    digits = F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 32))


def in_sample(key: Column, share: float, round_: Column | int = 0, seed: int = SEED) -> Column:
    """Whether a row is in the sample of ``share`` of a round."""
    return hash_fraction(key, round_ if isinstance(round_, Column) else F.lit(round_), F.lit(seed)) < F.lit(float(share))


def sampled_columns(names: list[str], share: float, round_: int = 0, seed: int = SEED) -> list[int]:
    """Positions of the columns of a round: the ``share`` of them (one at least) that come first by hash."""
    wanted = max(1, round(share * len(names)))
    order = sorted(range(len(names)), key=lambda i: hashlib.md5(f"{names[i]}:{round_}:{seed}".encode()).hexdigest())
    return sorted(order[:wanted])
