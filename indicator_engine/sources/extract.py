"""Extraction from a wide source: named columns, a row filter, an optional sample.

Works on any DataFrame (Parquet, JDBC, a warehouse connector), so the
projection and the filter reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_engine.operators.sampling import ordered_sample

TARGET_YEARS = tuple(range(2024, 2031))
_WIDE_TARGETS = tuple(f"meta_alfabetizacao_{year}" for year in TARGET_YEARS)


@dataclass(frozen=True)
class Extract:
    columns: tuple[str, ...]
    equals: tuple[str, str] | None = None
    starts_with: tuple[str, str] | None = None
    sample: int | None = None


# What each raw entity takes from its source table.
EXTRACTS = {
    "uf": Extract(
        ("ano", "sigla_uf", "serie", "rede", "taxa_alfabetizacao", "media_portugues"),
        equals=("rede", "5"),
    ),
    "municipio": Extract(
        ("ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao", "media_portugues"),
        equals=("rede", "3"),
    ),
    "meta_alfabetizacao_brasil": Extract(
        ("ano", "rede", "taxa_alfabetizacao", *_WIDE_TARGETS, "percentual_participacao"),
    ),
    "meta_alfabetizacao_uf": Extract(
        ("ano", "sigla_uf", "rede", "taxa_alfabetizacao", *_WIDE_TARGETS, "percentual_participacao"),
    ),
    "meta_alfabetizacao_municipio": Extract(
        (
            "ano",
            "id_municipio",
            "rede",
            "taxa_alfabetizacao",
            *_WIDE_TARGETS,
            "nivel_alfabetizacao",
            "percentual_participacao",
        ),
    ),
    "alunos": Extract(
        (
            "ano",
            "id_municipio",
            "id_escola",
            "id_aluno",
            "serie",
            "rede",
            "presenca",
            "alfabetizado",
            "proficiencia",
            "peso_aluno",
        ),
    ),
}

# The sample of one state that a small trial run takes instead of all students.
STUDENT_SAMPLE = Extract(
    EXTRACTS["alunos"].columns,
    starts_with=("id_municipio", "35"),
    sample=20000,
)


def extract(source: DataFrame, spec: Extract, order_by: Sequence[str] | None = None) -> DataFrame:
    """Apply an ``Extract``; a sample is the first rows by ``order_by`` (all columns when not given)."""
    rows = source
    if spec.equals:
        column, value = spec.equals
        rows = rows.where(F.col(column) == value)
    if spec.starts_with:
        column, prefix = spec.starts_with
        rows = rows.where(F.col(column).like(f"{prefix}%"))
    rows = rows.select(*spec.columns)
    if spec.sample is None:
        return rows
    return ordered_sample(rows, spec.sample, order_by or spec.columns, scanned=True)
