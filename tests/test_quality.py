from __future__ import annotations

import pytest

from indicator_engine.operators import quality as q
from indicator_engine.sinks import Table, append


def report(df, *checks):
    return {r.metrica: (r.valor, r.status) for r in q.run_checks(df, "t", checks).collect()}


def test_duplicates_count_null_keys_as_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (1, None)], "ano int, id string")
    assert report(df, q.duplicates(["ano", "id"])) == {"linhas_duplicadas": (2.0, "alerta")}
    assert report(df.distinct(), q.duplicates(["ano", "id"])) == {"linhas_duplicadas": (0.0, "ok")}


def test_missing_compares_the_unrounded_share(spark):
    df = spark.range(0, 100_000).selectExpr("if(id < 10001, NULL, id) AS x")
    assert report(df, q.missing("x", 10.0)) == {"pct_nulo_x": (10.0, "alerta")}
    assert report(df, q.missing("x", 10.001)) == {"pct_nulo_x": (10.0, "ok")}


def test_empty_table_is_ok(spark):
    df = spark.range(0).selectExpr("id AS x", "CAST(id AS double) AS y")
    assert report(df, q.missing("x", 0.0), q.duplicates(["x"]), q.out_of_range("y", 0, 1)) == {
        "pct_nulo_x": (0.0, "ok"),
        "linhas_duplicadas": (0.0, "ok"),
        "taxa_fora_0_100": (0.0, "ok"),
    }


def test_out_of_range_counts_nan_but_not_null(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (100.0,), (100.1,), (float("nan"),), (None,)], "x double")
    assert report(df, q.out_of_range("x", 0, 100)) == {"taxa_fora_0_100": (3.0, "alerta")}


def test_unresolved_and_cast_rejects(spark):
    df = spark.createDataFrame([(None, "2023"), ("S", "2023.0"), ("S", None)], "sigla_uf string, ano string")
    assert report(df, q.unresolved("sigla_uf"), q.cast_rejects("ano", "int")) == {
        "municipios_sem_uf": (1.0, "alerta"),
        "rejeitados_ano": (1.0, "alerta"),
    }


@pytest.fixture
def full_report(spark):
    df = spark.createDataFrame(
        [(2023, "a", "S", 50.0), (2023, "a", "X", 150.0), (2024, "b", None, None)],
        "ano int, id_municipio string, sigla_uf string, taxa_alfabetizacao double",
    )
    dim = spark.createDataFrame([("S",)], "sigla_uf string")
    checks = [
        q.duplicates(["ano", "id_municipio"]),
        q.missing("id_municipio", 0.0),
        q.missing("taxa_alfabetizacao", 10.0),
        q.unresolved("sigla_uf"),
        q.out_of_range("taxa_alfabetizacao", 0, 100),
    ]
    return q.quality_report(df, dim, "sigla_uf", "municipio_ano_integrada", checks)


def test_report_rows(full_report):
    assert full_report.columns == q.REPORT_COLUMNS
    table = "municipio_ano_integrada"
    assert {tuple(r) for r in full_report.collect()} == {
        ("duplicidade", table, "linhas_duplicadas", 1.0, "alerta", "chave=(ano, id_municipio)"),
        ("ausentes", table, "pct_nulo_id_municipio", 0.0, "ok", "teto=0.0%"),
        ("ausentes", table, "pct_nulo_taxa_alfabetizacao", 33.33, "alerta", "teto=10.0%"),
        ("chave_relacionamento", table, "municipios_sem_uf", 1.0, "alerta", "sigla_uf nao resolvida pelo codigo IBGE"),
        ("chave_relacionamento", table, "siglas_fora_da_dim", 1.0, "alerta", ""),
        ("consistencia", table, "taxa_fora_0_100", 1.0, "alerta", "taxa deve ficar em [0,100]"),
    }
    assert q.alert_count(full_report).first().alertas == 5


def test_history_grows_and_shows_its_trend(spark, full_report, tmp_path):
    history = Table(path=str(tmp_path / "report"))
    for _ in range(2):
        audit = append(q.stamped(full_report), history, q.REPORT_SCHEMA)
        assert audit.rows == 6
    stored = history.read(spark)
    assert stored.count() == 12
    assert stored.schema == q.REPORT_SCHEMA
    assert stored.select("executado_em").distinct().count() == 2
    trend = q.quality_trend(stored)
    assert trend.where("variacao IS NULL").count() == 6
    assert trend.where("variacao = 0").count() == 6


def test_one_key_per_pass(spark):
    with pytest.raises(ValueError):
        q.run_checks(spark.range(1), "t", [q.duplicates(["a"]), q.duplicates(["b"])])
