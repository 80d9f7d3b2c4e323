"""Images as bytes of columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def drawn(rows: int, columns: int, value: Callable[[Column, Column], Column]) -> Column:
    """Bytes of a grey image, row by row, whose value at (y, x) is given, 0 to 255."""
    at = F.sequence(F.lit(0).cast("bigint"), F.lit(rows * columns - 1).cast("bigint"))
    hex_ = F.transform(at, lambda i: F.lpad(F.hex(value(F.floor(i / columns), i % columns).cast("bigint")), 2, "0"))
    return F.unhex(F.array_join(hex_, ""))
