"""The four served products, each a transform of the integrated table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicator_engine.functions import round_half_up
from indicator_engine.names import Names
from indicator_engine.operators.targets import latest_by_key


def latest_indicator(integrated: DataFrame, names: Names = Names()) -> DataFrame:
    """The last observation of every entity, all columns."""
    return latest_by_key(integrated, [names.entity], names.year)


def target_vs_result(integrated: DataFrame, names: Names = Names()) -> DataFrame:
    """Rows that have a target, in the shape of the product."""
    return integrated.where(F.col(names.current_target).isNotNull()).select(
        names.year,
        names.entity,
        names.region,
        names.macro,
        names.rate,
        names.current_target,
        names.gap,
        names.reached,
    )


def evolution(integrated: DataFrame, names: Names = Names()) -> DataFrame:
    """Change against the previous observation of the entity.

    That is the previous row, not the previous calendar year.  The input is at
    (entity, year) grain, so one entity holds at most one row per year and no
    window partition can grow with the raw data.
    """
    by_year = Window.partitionBy(names.entity).orderBy(names.year)
    previous = F.lag(names.rate).over(by_year)
    return integrated.select(
        names.year, names.entity, names.region, names.rate, previous.alias(names.previous)
    ).withColumn(names.change, F.col(names.rate) - F.col(names.previous))


def region_summary(
    integrated: DataFrame, names: Names = Names(), *, exact_scale: int | None = None
) -> DataFrame:
    """Entities, mean rate and share at target per region and year.

    Entities without a target count as entities but not in the share.
    """
    return integrated.groupBy(names.year, names.region, names.macro).agg(
        F.count(F.lit(1)).alias(names.entities),
        round_half_up(F.avg(names.rate), 2, exact_scale).alias(names.mean_rate),
        round_half_up(F.avg(names.reached), 3, exact_scale).alias(names.reached_share),
    )
