"""Typing of raw text.

A value that does not parse becomes null instead of stopping the load;
``quality.cast_rejects`` counts such values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text outside these patterns never parses.  Spark's own cast raises and catches an
# exception for it, which costs more than ten times a value that parses, so it is sorted out first.
_INT_TEXT = r"^[\x00-\x20\x7F]*[+-]?[0-9]+(\.[0-9]*)?[\x00-\x20\x7F]*$|^[\x00-\x20\x7F]*[+-]?\.[0-9]*[\x00-\x20\x7F]*$"
_DOUBLE_TEXT = (
    r"^[\x00-\x20\x7F]*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?"
    r"|[+-]?(?i:nan|inf|infinity)|[+-]?0[xX].*)[\x00-\x20\x7F]*$"
)


def _guarded(c: Column, pattern: str, kind: str) -> Column:
    """``try_cast`` whatever the type; the pattern is for text only.

    The type is known when the plan is made, so of the condition nothing is left for a
    column that is no text.
    """
    typed_already = ~F.startswith(F.typeof(c), F.lit("string"))
    return F.when(typed_already | c.cast("string").rlike(pattern), c.try_cast(kind))


def as_int(c: Column | str) -> Column:
    return _guarded(_column(c), _INT_TEXT, "int")


def as_double(c: Column | str) -> Column:
    return _guarded(_column(c), _DOUBLE_TEXT, "double")


def as_key(c: Column | str) -> Column:
    """Keys stay text, so leading zeros survive."""
    return _column(c).cast("string")


def as_timestamp(c: Column | str) -> Column:
    return F.try_to_timestamp(_column(c))


_CASTS = {"int": as_int, "double": as_double, "string": as_key, "timestamp": as_timestamp}


def as_kind(c: Column | str, kind: str) -> Column:
    """The typed version of a column, null where it does not parse."""
    return _CASTS[kind](c)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace the named columns by their typed version, in place."""
    return df.withColumns({name: _CASTS[kind](name) for name, kind in types.items()})
