"""Array expressions for token sequences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def common_prefix_length(a: Column, b: Column) -> Column:
    """Number of equal leading elements. zip_with pads the shorter side with nulls, which never equal a token."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1).cast("int")


def shift_inputs(row: Column) -> Column:
    return F.slice(row, F.lit(1), F.greatest(F.size(row) - 1, F.lit(0)))


def shift_targets(row: Column) -> Column:
    return F.slice(row, F.lit(2), F.greatest(F.size(row) - 1, F.lit(0)))


def mask_targets(targets: Column, mask: Column, ignore: int = -1) -> Column:
    """`mask` covers the full row; position i of the targets is governed by position i+1 of the row."""
    return F.zip_with(targets, shift_targets(mask), lambda t, m: F.when(m == 0, F.lit(ignore)).otherwise(t))


def mask_padding(targets: Column, content_len: Column, ignore: int = -1) -> Column:
    """Targets from index content_len-1 on point at padding and are ignored."""
    return F.transform(targets, lambda t, i: F.when(i >= content_len - 1, F.lit(ignore)).otherwise(t))


def pad_right(row: Column, length: Column, value) -> Column:
    return F.concat(row, F.array_repeat(F.lit(value), F.greatest(length - F.size(row), F.lit(0)).cast("int")))


def supervised_count(targets: Column, ignore: int = -1) -> Column:
    return F.size(F.filter(targets, lambda t: t != ignore))


def left_crop(row: Column, length: int) -> Column:
    """The last `length` elements."""
    return F.when(F.size(row) > length, F.slice(row, -length, length)).otherwise(row)
