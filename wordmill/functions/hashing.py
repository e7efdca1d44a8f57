"""Deterministic pseudo-random keys.

All randomness in the library is ``md5(seed ':' id)``: independent of partitioning and
of the number of executors, recomputed identically after a task retry, and equal in
any SQL engine that has md5. Ordering the hex string orders the hash numerically.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_string(id_cols: str | Sequence[str]) -> Column:
    """A string form of a (possibly composite) id: parts joined by ':'."""
    if isinstance(id_cols, str):
        id_cols = [id_cols]
    parts = [F.col(c).cast("string") for c in id_cols]
    return parts[0] if len(parts) == 1 else F.concat_ws(":", *parts)


def seeded_hash(seed: int | str, id_cols: str | Sequence[str]) -> Column:
    """``md5(concat(seed, ':', id))`` as a 32-char hex string."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_string(id_cols)))


def hash_bucket(h: Column, digits: int = 4) -> Column:
    """Leading hex digits of a hash; string order equals numeric order."""
    return F.substring(h, 1, digits)


def hash_int(h: Column, digits: int = 8) -> Column:
    """Leading hex digits of a hash as a non-negative integer."""
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("bigint")
