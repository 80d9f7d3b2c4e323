"""Content hashes and Hamming similarity of 64-bit signatures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(content: Column) -> Column:
    return F.md5(content)


def fallback_hash(content: Column) -> Column:
    """16 digits, of the size and the first KiB."""
    raw = content.cast("binary")
    return F.substring(F.md5(F.concat(F.octet_length(raw).cast("string").cast("binary"), F.substring(raw, 1, 1024))), 1, 16)


def sign_bits(vector: Column, bits: int = 64) -> Column:
    """A 64-bit signature: bit i is set where component i is above 0."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        out = out.bitwiseOR(F.when(F.get(vector, F.lit(i)) > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return out


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def similarity(a: Column, b: Column) -> Column:
    return 1 - distance(a, b) / 64.0


def by_method(name: str):
    """The hash function of a name: md5, fallback (size and first KiB), sign (of a vector)."""
    methods = {"md5": content_hash, "fallback": fallback_hash, "sign": sign_bits}
    if name not in methods:
        raise ValueError(f"no hash method {name}; there are {', '.join(methods)}")
    return methods[name]
