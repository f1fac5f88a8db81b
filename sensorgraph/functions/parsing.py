"""Text to number and text to timestamp; text that does not parse becomes NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: plain or scientific notation, or a special value. Keeps out Java's type suffixes ("1d").
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def to_number(col: Column | str) -> Column:
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def to_ts(col: Column | str, formats: Sequence[str] = ()) -> Column:
    """ISO text, or else the first of ``formats`` (Spark date patterns) that fits."""
    column = F.col(col) if isinstance(col, str) else col
    found = [F.try_to_timestamp(column.cast("string"), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(column.try_cast("timestamp_ntz"), *found)
