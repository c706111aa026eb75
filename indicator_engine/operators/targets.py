"""Targets: newest version per key, wide years to long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicator_engine.functions import as_int
from indicator_engine.names import Names


def _newest_first(
    df: DataFrame, age: Column, keys: Sequence[str], ties: Sequence[str] | None
) -> list[Column | str]:
    """Descending (null last), then tie columns, so that a re-run picks the same row."""
    if ties is None:
        ties = [c for c in df.columns if c not in keys]
    return [age.desc_nulls_last(), *ties]


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    year: str = Names.year,
    ties: Sequence[str] | None = None,
    *,
    age: Column | None = None,
) -> DataFrame:
    """The row of the newest year per key; ``age`` orders by something other than a year.

    The rank filter lets Spark keep one row per key and map task before the
    shuffle (``WindowGroupLimit``), so a hot key does not reach one task whole.
    ``ties`` decides between rows of the same age; all other columns by default.
    """
    order = _newest_first(df, as_int(year) if age is None else age, keys, ties)
    newest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def latest_overall(df: DataFrame, year: str = Names.year, ties: Sequence[str] | None = None) -> DataFrame:
    """The one row of the newest year."""
    return df.orderBy(*_newest_first(df, as_int(year), (), ties)).limit(1)


def unpivot_targets(
    wide: DataFrame, keys: Sequence[str], years: Sequence[int], names: Names = Names()
) -> DataFrame:
    """One row per key and target year; a year without target stays as a null row.

    Ask only for the years that are needed: a later filter on the target year
    does not reach below the generated rows.
    """
    rows = ", ".join(
        f"named_struct('{names.target_year}', {year}, "
        f"'{names.target}', try_cast(`{names.target_column(year)}` AS double))"
        for year in years
    )
    return wide.selectExpr(*(f"`{k}`" for k in keys), f"inline(array({rows}))")


def _needed(
    wide: DataFrame, keys: Sequence[str], years: Sequence[int], names: Names, ties: Sequence[str] | None
) -> DataFrame:
    """Only the columns the long targets depend on."""
    others = [names.year, *(names.target_column(y) for y in years), *(ties or ())]
    return wide.select(
        *(F.col(k).cast("string").alias(k) for k in keys),
        *(c for c in dict.fromkeys(others) if c not in keys),
    )


def keyed_targets(
    wide: DataFrame,
    key: str,
    years: Sequence[int],
    names: Names = Names(),
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Long targets of the newest version per key.

    Old versions are dropped before the rows multiply by the number of years.
    """
    newest = latest_by_key(_needed(wide, [key], years, names, ties), [key], names.year, ties)
    return unpivot_targets(newest, [key], years, names)


def national_targets(
    wide: DataFrame, years: Sequence[int], names: Names = Names(), ties: Sequence[str] | None = None
) -> DataFrame:
    """Long targets of the single newest row."""
    newest = latest_overall(_needed(wide, [], years, names, ties), names.year, ties)
    return unpivot_targets(newest, [], years, names)
