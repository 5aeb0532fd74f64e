"""Missing values: one null inside, whatever a source writes; comparisons with it are false."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FILL = -32767.0


def to_null(x: Column, fill: float = FILL) -> Column:
    """NaN, infinities and the fill value become null."""
    bad = F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")) | (x.cast("double") == fill)
    return F.when(~F.coalesce(bad, F.lit(True)), x)


def flag(condition: Column) -> Column:
    """A condition that is false where it is unknown; to be taken before any negation."""
    return F.coalesce(condition, F.lit(False))


def real(x: float) -> Column:
    """A single-precision literal."""
    return F.lit(x).cast("float")
