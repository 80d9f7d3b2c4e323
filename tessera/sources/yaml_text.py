"""YAML text of struct columns, as dataset descriptions have it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, StringType, StructType


def _scalar(value: Column, kind: DataType) -> Column:
    """Texts that YAML would read as something else, or not at all, are quoted; null is null."""
    text = value.cast("string")
    if isinstance(kind, StringType):
        plain = text.rlike(r"^[A-Za-z/][\w./-]*( [\w./-]+)*$") & ~F.lower(text).isin("true", "false", "yes", "no", "on", "off", "null", "y", "n")
        text = F.when(plain, text).otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'")))
    elif isinstance(kind, BooleanType):
        text = F.lower(text)
    return F.coalesce(text, F.lit("null"))


def as_yaml(value: Column, kind: DataType, depth: int = 0) -> Column:
    """A struct as YAML in block style, its fields in order; arrays of plain values as lists. Ends with a line end."""
    pad, lines = "  " * depth, []
    for field in kind.fields:
        inner = value[field.name]
        if isinstance(field.dataType, StructType):
            lines.append(F.concat(F.lit(f"{pad}{field.name}:\n"), as_yaml(inner, field.dataType, depth + 1)))
        elif isinstance(field.dataType, ArrayType):
            items = F.transform(inner, lambda x, k=field.dataType.elementType: F.concat(F.lit(f"{pad}- "), _scalar(x, k), F.lit("\n")))
            lines.append(F.concat(F.lit(f"{pad}{field.name}:"), F.when(F.coalesce(F.size(inner), F.lit(0)) < 1, F.lit(" []\n")).otherwise(F.concat(F.lit("\n"), F.array_join(items, "")))))
        else:
            lines.append(F.concat(F.lit(f"{pad}{field.name}: "), _scalar(inner, field.dataType), F.lit("\n")))
    return F.concat(*lines)
