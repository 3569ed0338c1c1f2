"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded(number: Column, digits: int) -> Column:
    """``format_string`` of ``%0{digits}d``, which is slow: only what is null, negative or longer goes through it."""
    return F.when(number.between(0, 10 ** digits - 1), F.lpad(number.cast("string"), digits, "0")).otherwise(F.format_string(f"%0{digits}d", number))
