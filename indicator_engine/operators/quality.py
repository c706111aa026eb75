"""Data-quality report: every check is a row, none stops the load.

All checks that look at the rows of one table share one aggregation over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicator_engine.functions import as_kind, percentage, round_half_up
from indicator_engine.operators.lookup import missing_from

OK, ALERT = "ok", "alerta"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("teste", T.StringType()),
        T.StructField("tabela", T.StringType()),
        T.StructField("metrica", T.StringType()),
        T.StructField("valor", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("detalhe", T.StringType()),
        T.StructField("executado_em", T.TimestampType()),
    ]
)
REPORT_COLUMNS = [f.name for f in REPORT_SCHEMA if f.name != "executado_em"]


@dataclass(frozen=True)
class Check:
    """Rows that must not be there: those meeting ``bad``, or those beyond the first of each key.

    The value is their number, or with ``percent`` their share of all rows; it
    is held against the ceiling unrounded.
    """

    test: str
    metric: str
    bad: Column | None = field(default=None, compare=False)
    keys: tuple[str, ...] = ()
    percent: bool = False
    ceiling: float = 0.0
    detail: str = ""


def duplicates(keys: Sequence[str]) -> Check:
    """Rows beyond the first of each key; a null in a key counts as a value."""
    return Check("duplicidade", "linhas_duplicadas", keys=tuple(keys), detail=f"chave=({', '.join(keys)})")


def missing(column: str, ceiling: float) -> Check:
    """Share of nulls in percent."""
    return Check(
        "ausentes",
        f"pct_nulo_{column}",
        F.col(column).isNull(),
        percent=True,
        ceiling=ceiling,
        detail=f"teto={ceiling}%",
    )


def unresolved(column: str, metric: str = "municipios_sem_uf", detail: str | None = None) -> Check:
    """Rows whose lookup found nothing."""
    if detail is None:
        detail = f"{column} nao resolvida pelo codigo IBGE"
    return Check("chave_relacionamento", metric, F.col(column).isNull(), detail=detail)


def out_of_range(
    column: str, low: float, high: float, metric: str = "taxa_fora_0_100", detail: str | None = None
) -> Check:
    """Rows outside [low, high]; null is not counted, NaN is."""
    outside = (F.col(column) < low) | (F.col(column) > high)
    if detail is None:
        detail = f"taxa deve ficar em [{low:g},{high:g}]"
    return Check("consistencia", metric, outside, detail=detail)


def cast_rejects(column: str, kind: str) -> Check:
    """Raw values that typing turned into null."""
    lost = F.col(column).isNotNull() & as_kind(column, kind).isNull()
    return Check("tipagem", f"rejeitados_{column}", lost, detail=f"tipo={kind}")


def rejected_lines(quarantine: DataFrame, table: str) -> DataFrame:
    """Report row with the number of lines of a raw table's files that had another width."""
    check = Check("carga", "linhas_rejeitadas", F.lit(True), detail="largura diferente do cabecalho")
    return run_checks(quarantine, table, [check])


def load_rejects(raw: Mapping[str, DataFrame], types: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Report rows with the values that typing turns into null, per raw table and column."""
    reports = [
        run_checks(raw[table], table, [cast_rejects(column, kind) for column, kind in kinds.items()])
        for table, kinds in types.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def _totals(df: DataFrame, keys: Sequence[str], counts: dict[str, Column]) -> DataFrame:
    """One row: all rows, distinct keys, rows meeting each condition.

    Counting per key first and adding up keeps it to one pass.  The keys are
    grouped as plain columns, so a table laid out by one of them is not shuffled.
    """
    counts = {"_rows": F.count(F.lit(1)), **counts}
    if not keys:
        return df.agg(*(c.alias(name) for name, c in counts.items()))
    per_key = df.groupBy(*keys).agg(*(c.alias(name) for name, c in counts.items()))
    sums = (F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts)
    return per_key.agg(F.count(F.lit(1)).alias("_keys"), *sums)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One report row per check from a single pass over ``df``."""
    key_sets = {c.keys for c in checks if c.keys}
    if len(key_sets) > 1:
        raise ValueError("one pass can look for duplicates of one key only")
    counts = {f"_{i}": F.count_if(c.bad) for i, c in enumerate(checks) if not c.keys}
    totals = _totals(df, next(iter(key_sets), ()), counts)
    rows = []
    for i, check in enumerate(checks):
        value = F.col("_rows") - F.col("_keys") if check.keys else F.col(f"_{i}")
        if check.percent:
            value = percentage(value, F.col("_rows"))
        value = value.cast("double")
        rows.append(
            F.struct(
                F.lit(check.test).alias("teste"),
                F.lit(table).alias("tabela"),
                F.lit(check.metric).alias("metrica"),
                (round_half_up(value, 2) if check.percent else value).alias("valor"),
                F.when(value <= check.ceiling, OK).otherwise(ALERT).alias("status"),
                F.lit(check.detail).alias("detalhe"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


def unknown_codes(
    df: DataFrame, dimension: DataFrame, column: str, table: str, metric: str = "siglas_fora_da_dim"
) -> DataFrame:
    """Report row with the number of distinct codes the dimension does not hold."""
    check = Check("chave_relacionamento", metric, F.lit(True))
    return run_checks(missing_from(df, dimension, column), table, [check])


def quality_report(
    df: DataFrame, dimension: DataFrame, code: str, table: str, checks: Sequence[Check]
) -> DataFrame:
    """The row checks and the code check as one relation, without a run time."""
    return run_checks(df, table, checks).unionByName(unknown_codes(df, dimension, code, table))


def stamped(report: DataFrame) -> DataFrame:
    return report.withColumn("executado_em", F.current_timestamp())


def alert_count(report: DataFrame) -> DataFrame:
    return report.where(F.col("status") == ALERT).agg(F.count(F.lit(1)).alias("alertas"))


def quality_trend(history: DataFrame) -> DataFrame:
    """Each check beside its value in the run before.

    A window partition holds one row per run of one check.
    """
    runs = Window.partitionBy("tabela", "metrica").orderBy("executado_em")
    return history.select(
        "tabela",
        "metrica",
        "executado_em",
        "status",
        "valor",
        (F.col("valor") - F.lag("valor").over(runs)).alias("variacao"),
    )
