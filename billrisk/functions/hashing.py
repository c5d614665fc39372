"""A repeatable pseudo-random number per row key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def row_hash(key: Column, seed: int) -> Column:
    """60 bits of the MD5 of key and seed, as a non-negative bigint.

    Depends on the key only, so a row lands on the same side of a split
    whatever the partitioning, the run or the engine.
    """
    text = F.concat_ws("#", key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
