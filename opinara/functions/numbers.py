"""Lenient text-to-number conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java would also read "5d" and "5f" as numbers, so the text is checked before it is cast.
DECIMAL = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(col: Column) -> Column:
    """Double value of a column, null where it is not a number."""
    text = col.cast("string")
    return F.when(text.rlike(DECIMAL), F.trim(text).try_cast("double"))


def is_missing(column: str, kind: str) -> Column:
    """Null, or NaN in a floating column; ``kind`` is the column's type name."""
    col = quoted(column)
    return col.isNull() | F.isnan(col) if kind in ("float", "double") else col.isNull()


def quoted(column: str) -> Column:
    """A column by its plain name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def clean_double(col: Column) -> Column:
    """The column as double with NaN turned into null."""
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
