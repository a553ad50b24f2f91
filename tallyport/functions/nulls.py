"""The rule that turns blank delimited and Parquet text into NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"(?U)^\s+|\s+$"


def blank_to_null(value: Column) -> Column:
    """NULL if nothing but Unicode white space; otherwise the text as it is, untrimmed."""
    return F.when(F.regexp_replace(value, _EDGES, "") != "", value)
