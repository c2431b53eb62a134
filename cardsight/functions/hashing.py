"""Seeded, order-free pseudo-randomness from row identity.

Every random choice (sample membership, SMOTE neighbour, interpolation point)
is a pure function of (seed, row id, salt). Results therefore do not depend on
partitioning, task retries or executor loss, and an SQL engine with ``md5``
reproduces them exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_key(seed: int, *parts: str | Column) -> Column:
    """``md5('seed:part1:part2...')`` as a 32-hex-digit string."""
    pieces = [F.lit(str(seed))] + [_col(p).cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *pieces))


def seeded_uniform(seed: int, *parts: str | Column) -> Column:
    """A value in [0, 1) from the first 32 bits of the seeded md5."""
    head = F.substring(seeded_key(seed, *parts), 1, 8)
    return F.conv(head, 16, 10).cast("double") / float(2**32)


def seeded_int(seed: int, modulus: int | Column, *parts: str | Column) -> Column:
    """An integer in [0, modulus) from the seeded md5 (first 32 bits)."""
    head = F.substring(seeded_key(seed, *parts), 1, 8)
    mod = modulus if isinstance(modulus, Column) else F.lit(int(modulus))
    return F.pmod(F.conv(head, 16, 10).cast("long"), mod.cast("long"))
