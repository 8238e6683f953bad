"""Deterministic order keys. The same text goes into md5 everywhere, so any engine can reproduce the order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def shuffle_key(seed: int, *columns) -> Column:
    """Hex key that orders rows pseudo-randomly: depends on seed and row key only, not on input order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]))


def hex_bucket(key: Column, digits: int) -> Column:
    """Order-preserving bucket of an md5 key: 16**digits buckets of nearly equal size."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long")


def key_digits(rows: int, per_bucket: int = 65_536) -> int:
    """Hex digits for `hex_bucket` such that a bucket of so large a table holds about `per_bucket` rows at most."""
    digits = 1
    while rows > per_bucket * 16**digits:
        digits += 1
    return digits


def width_bucket(position: Column, width: int) -> Column:
    """Order-preserving bucket of a unique integer position: at most `width` rows each."""
    return F.floor(position / F.lit(width)).cast("long")
