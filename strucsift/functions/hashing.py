"""Seeded, engine-independent pseudo-randomness from MD5.

A row's draw depends only on the seed and its key, never on partitioning, so the same seed
gives the same rows on any cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_md5(seed: int | str, key: Column) -> Column:
    """Hex digest of ``seed|key``."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")).cast("binary"))


def hex_to_long(digest: Column, digits: int) -> Column:
    """The first ``digits`` (at most 15) hex digits of a digest as a BIGINT."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def uniform(seed: int | str, key: Column) -> Column:
    """A draw in (0, 1): 52 hashed bits, shifted off zero."""
    return (hex_to_long(seeded_md5(seed, key), 13) + F.lit(1)) / F.lit(float(2**52 + 1))
