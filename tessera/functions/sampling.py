"""Repeatable chance from a portable hash, the same in any SQL engine that has md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(value: Column, salt: str = "") -> Column:
    """The first eight hex digits of md5(salt + value) as a number."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), value.cast("string"))), 1, 8), 16, 10).cast("long")


def uniform(value: Column, salt: str = "") -> Column:
    """In [0, 1)."""
    return hash32(value, salt) / float(2**32)


def weighted_choice(u: Column, names: tuple[str, ...], weights: tuple[float, ...]) -> Column:
    """The name whose share of the cumulated weights holds u."""
    total, upto, out = sum(weights), 0.0, None
    for name, w in zip(names[:-1], weights[:-1], strict=True):
        upto += w
        cond = u * total < upto
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(names[-1])
