from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dimension: DataFrame, on: str, *, literal: bool = False) -> DataFrame:
    """Left outer lookup of a dimension; unmatched rows keep null labels.

    ``literal=True`` is for a dimension built from constants in the program:
    Spark knows no size for it, its bound is the program text, so it is
    broadcast.  Every other dimension is left to Spark's own size check
    (broadcast below the threshold, by statistics or as measured at run time)
    and to a sort-merge join with skew split above it.
    """
    return df.join(F.broadcast(dimension) if literal else dimension, on, "left")


def missing_from(df: DataFrame, dimension: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of ``column`` that the dimension does not hold.

    Both sides are made distinct first, so a value that fills a third of the
    rows is one row per map task by the time it is shuffled.
    """
    present = df.where(F.col(column).isNotNull()).select(column).distinct()
    known = dimension.select(column).distinct()
    return present.join(known, column, "left_anti")
