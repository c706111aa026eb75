from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_engine.names import Names


def integrate(
    fact: DataFrame,
    targets: DataFrame,
    names: Names = Names(),
    *,
    unique_inputs: bool = False,
    by_entity: bool = False,
) -> DataFrame:
    """Each entity-year result beside the target of its own year, with gap and attainment.

    Without a target, gap and attainment are null.  ``unique_inputs=True`` says
    that the fact is unique per (entity, year) and the targets per (entity,
    target year), as the operators of this package build them; the final
    duplicate removal could then change nothing and is left out.

    ``by_entity=True`` joins on the entity alone and compares the year of the
    pairs, so tables bucketed by entity are not shuffled; it is for inputs with
    at most one row per year and entity, where a pair of entities is few rows.
    """
    own_year = targets.select(
        F.col(names.entity).alias("_entity"),
        F.col(names.target_year).alias("_year"),
        F.col(names.target).alias(names.current_target),
    )
    gap = F.col(names.rate) - F.col(names.current_target)
    year = F.col(names.year)
    # a difference is no join key, so the year does not ask for a layout of its own
    same_year = (year - F.col("_year") == 0) if by_entity else (year == F.col("_year"))
    joined = fact.join(own_year, (F.col(names.entity) == F.col("_entity")) & same_year, "left").select(
        names.year,
        names.entity,
        *names.labels,
        *names.measures,
        names.current_target,
        gap.alias(names.gap),
        (gap >= 0).cast("int").alias(names.reached),
    )
    return joined if unique_inputs else joined.dropDuplicates()
