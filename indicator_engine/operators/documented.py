"""Steps the design describes around the load: state targets, scores, updates, priorities, health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_engine.functions import as_double, as_int, as_key
from indicator_engine.names import Names
from indicator_engine.operators.quality import ALERT, OK
from indicator_engine.operators.sampling import ordered_sample
from indicator_engine.operators.targets import latest_by_key

# Fixed value: the score from which a student counts as literate.
SCORE_CUT = 743


def indicator_from_scores(raw: DataFrame, names: Names = Names(), *, cut: float = SCORE_CUT) -> DataFrame:
    """Share of students at or above the cut per entity and year; unreadable scores do not count."""
    passed = (as_double(names.raw_score) >= cut).cast("int")
    keys = (as_int(names.year).alias(names.year), as_key(names.entity).alias(names.entity))
    return raw.groupBy(*keys).agg(F.avg(passed).alias(names.sample_share))


def attach_region_target(
    integrated: DataFrame, region_targets: DataFrame, names: Names = Names(), *, column: str = "meta_uf"
) -> DataFrame:
    """The integrated table with the target of the region for the same year."""
    own_year = region_targets.select(
        names.region,
        F.col(names.target_year).alias(names.year),
        F.col(names.target).alias(column),
    )
    joined = integrated.join(own_year, [names.region, names.year], "left")
    return joined.select(*integrated.columns, column)


def apply_updates(fact: DataFrame, events: DataFrame, names: Names = Names()) -> DataFrame:
    """The fact with the measures of the newest event of its entity and year.

    A measure the event lacks keeps its value.
    """
    keys = [names.entity, names.year]
    newest = latest_by_key(events, keys, age=F.col(names.event_time)).select(
        *keys, *(F.col(m).alias(f"_new_{m}") for m in names.measures)
    )
    merged = fact.join(newest, keys, "left").withColumns(
        {m: F.coalesce(F.col(f"_new_{m}"), F.col(m)) for m in names.measures}
    )
    return merged.select(*fact.columns)


def priority_list(product: DataFrame, k: int, names: Names = Names()) -> DataFrame:
    """The ``k`` rows furthest below their target."""
    behind = product.where(F.col(names.gap).isNotNull())
    return ordered_sample(behind, k, [names.gap, names.year, names.entity])


def health(audits: DataFrame, history: DataFrame) -> DataFrame:
    """The last load of every table beside the last value of every check.

    Both are histories of a row a write and a row a check; no table is read to count it.
    """
    last_load = latest_by_key(audits, ["tabela"], age=F.col("executado_em"))
    loads = last_load.select(
        F.lit("carga").alias("sinal"),
        F.col("tabela").alias("alvo"),
        F.col("linhas").cast("double").alias("valor"),
        F.when(F.col("rejeitadas") > 0, ALERT).otherwise(OK).alias("status"),
        F.col("executado_em").alias("quando"),
    )
    last_run = latest_by_key(history, ["tabela", "metrica"], age=F.col("executado_em"))
    checks = last_run.select(
        F.lit("qualidade").alias("sinal"),
        F.concat_ws(".", "tabela", "metrica").alias("alvo"),
        "valor",
        "status",
        F.col("executado_em").alias("quando"),
    )
    return loads.unionByName(checks)
