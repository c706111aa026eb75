from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, digits: int, exact_scale: int | None = None) -> Column:
    """Round half-up.

    A mean of doubles depends on the order of addition in its last bits.  With
    ``exact_scale`` the value first passes through a decimal of that scale, so
    the rounded result no longer depends on partitioning or task retries.
    """
    if exact_scale is None:
        return F.round(c, digits)
    return F.round(c.cast(f"decimal(28,{exact_scale})"), digits).cast("double")


def percentage(part: Column, total: Column) -> Column:
    """``part`` in percent of ``total``; 0 of nothing."""
    return F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))
