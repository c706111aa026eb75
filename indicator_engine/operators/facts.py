"""Typed facts at (year, key) grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_engine.functions import as_double, as_int, as_key, flag_from_text
from indicator_engine.functions.text import TRUE_TEXTS
from indicator_engine.names import Names
from indicator_engine.operators.lookup import lookup


def yearly_means(raw: DataFrame, year: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Mean of every measure per (year, keys), typed from text.

    Partial means are built before the shuffle: a hot key ships one row per map
    task, whatever its share of the input.
    """
    return (
        raw.groupBy(as_int(year).alias(year), *(as_key(k).alias(k) for k in keys))
        .agg(*(F.avg(as_double(m)).alias(m) for m in measures))
    )


def entity_year_fact(
    raw: DataFrame,
    territory: DataFrame,
    names: Names = Names(),
    *,
    code_length: int = 2,
    literal_territory: bool = False,
) -> DataFrame:
    """Entity-year means with the labels of the territory the entity code starts with.

    The territory code is a prefix of the entity, so it is derived after the
    aggregation and stays out of the shuffle key.
    """
    means = yearly_means(raw, names.year, [names.entity], names.measures)
    coded = means.select(F.substring(names.entity, 1, code_length).alias(names.code), "*")
    return lookup(coded, territory, names.code, literal=literal_territory)


def region_year_fact(raw: DataFrame, names: Names = Names()) -> DataFrame:
    return yearly_means(raw, names.year, [names.region], names.measures)


def sample_indicator(
    raw: DataFrame,
    names: Names = Names(),
    *,
    true_texts: Sequence[str] = TRUE_TEXTS,
) -> DataFrame:
    """Micro-data rolled up to entity-year: rows, mean score, share of positive flags."""
    return raw.groupBy(
        as_int(names.year).alias(names.year), as_key(names.entity).alias(names.entity)
    ).agg(
        F.count(F.lit(1)).alias(names.sample_rows),
        F.avg(as_double(names.raw_score)).alias(names.sample_score),
        F.avg(flag_from_text(names.flag_text, true_texts)).alias(names.sample_share),
    )


def coverage_profile(raw: DataFrame, names: Names = Names()) -> DataFrame:
    """Rows per network and year: which cut of the source is actually filled."""
    return raw.groupBy(names.network, names.year).count()
