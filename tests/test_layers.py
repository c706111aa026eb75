"""The layered load on reference-shaped files, against rows worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from indicator_engine.operators import quality as q
from indicator_engine.plans import (
    Lakehouse,
    extract_all,
    land_all,
    load_gold,
    load_health,
    load_silver,
    record_loads,
    run_quality,
)
from indicator_engine.sources import EXTRACTS, RAW_ENTITIES, STUDENT_SAMPLE, read_csv_text
from tests import fixtures_raw

SP = ("SP", "Sao Paulo", "Sudeste")
RJ = ("RJ", "Rio de Janeiro", "Sudeste")
BA = ("BA", "Bahia", "Nordeste")
DF = ("DF", "Distrito Federal", "Centro-Oeste")
AM = ("AM", "Amazonas", "Norte")
NOWHERE = (None, None, None)

INTEGRATED = [
    (2023, "3550308", *SP, 55.0, 710.0, None, None, None),
    (2024, "3550308", *SP, 61.0, 730.0, 61.0, 0.0, 1),
    (2022, "3304557", *RJ, 40.0, 690.0, None, None, None),
    (2024, "3304557", *RJ, 45.5, 700.0, None, None, None),
    (2024, "9900001", *NOWHERE, 70.0, 750.0, None, None, None),
    (2024, "2927408", *BA, None, 710.0, 80.0, None, None),
    (2024, "5300108", *DF, 101.0, 760.0, 80.0, 21.0, 1),
    (None, "1302603", *AM, 30.0, 650.0, None, None, None),
]

EXPECTED = {
    "silver": {
        "fato_municipio": [
            ((r[1] or "")[:2], r[0], r[1], r[5], r[6], r[2], r[3], r[4]) for r in INTEGRATED
        ],
        "fato_uf": [(2023, "SP", 55.0, 705.0), (2024, "SP", None, 720.0)],
        "meta_municipio_long": [
            *(("3550308", 2024 + i, 61.0 + i) for i in range(7)),
            *(("3304557", 2024 + i, None if i == 0 else 49.0 + i) for i in range(7)),
            *(("2927408", y, 80.0) for y in fixtures_raw.YEARS),
            *(("5300108", y, 80.0) for y in fixtures_raw.YEARS),
        ],
        "meta_uf_long": [(s, y, 80.0) for s in ("SP", "RJ") for y in fixtures_raw.YEARS],
        "meta_brasil_long": list(zip(fixtures_raw.YEARS, (60.5, 64.0, 67.0, 70.0, 74.0, 77.0, 80.0))),
        "municipio_ano_integrada": INTEGRATED,
        "indicador_alunos_municipio": [(2023, "3550308", 5, 725.0, 0.6), (2024, "3550308", 1, 720.0, 0.0)],
    },
    "gold": {
        "indicador_por_municipio": [r for r in INTEGRATED if (r[0], r[1]) not in {(2023, "3550308"), (2022, "3304557")}],
        "meta_versus_resultado": [
            (r[0], r[1], r[2], r[4], r[5], r[7], r[8], r[9]) for r in INTEGRATED if r[7] is not None
        ],
        "evolucao_temporal": [
            (2023, "3550308", "SP", 55.0, None, None),
            (2024, "3550308", "SP", 61.0, 55.0, 6.0),
            (2022, "3304557", "RJ", 40.0, None, None),
            (2024, "3304557", "RJ", 45.5, 40.0, 5.5),
            (2024, "9900001", None, 70.0, None, None),
            (2024, "2927408", "BA", None, None, None),
            (2024, "5300108", "DF", 101.0, None, None),
            (None, "1302603", "AM", 30.0, None, None),
        ],
        "resumo_por_uf": [
            (2023, "SP", "Sudeste", 1, 55.0, None),
            (2024, "SP", "Sudeste", 1, 61.0, 1.0),
            (2022, "RJ", "Sudeste", 1, 40.0, None),
            (2024, "RJ", "Sudeste", 1, 45.5, None),
            (2024, None, None, 1, 70.0, None),
            (2024, "BA", "Nordeste", 1, None, None),
            (2024, "DF", "Centro-Oeste", 1, 101.0, 1.0),
            (None, "AM", "Norte", 1, 30.0, None),
        ],
    },
}

COLUMNS = {
    "indicador_por_municipio": [
        "ano", "id_municipio", "sigla_uf", "nome_uf", "regiao", "taxa_alfabetizacao", "media_portugues",
        "meta_ano_corrente", "gap_meta", "atingiu_meta",
    ],
    "meta_versus_resultado": [
        "ano", "id_municipio", "sigla_uf", "regiao", "taxa_alfabetizacao", "meta_ano_corrente", "gap_meta",
        "atingiu_meta",
    ],
    "evolucao_temporal": [
        "ano", "id_municipio", "sigla_uf", "taxa_alfabetizacao", "taxa_ano_anterior", "variacao",
    ],
    "resumo_por_uf": ["ano", "sigla_uf", "regiao", "qtd_municipios", "taxa_media", "prop_municipios_na_meta"],
}

REPORT = {
    ("duplicidade", "linhas_duplicadas", 0.0, "ok"),
    ("ausentes", "pct_nulo_id_municipio", 0.0, "ok"),
    ("ausentes", "pct_nulo_taxa_alfabetizacao", 12.5, "alerta"),
    ("chave_relacionamento", "municipios_sem_uf", 1.0, "alerta"),
    ("chave_relacionamento", "siglas_fora_da_dim", 0.0, "ok"),
    ("consistencia", "taxa_fora_0_100", 1.0, "alerta"),
}


# rows of the report about what the load could not take, a row a typed column and a raw table
LOST = 3 + 3 + 8 * 3 + 2 + 6


def run(lake, raw):
    audits = [*land_all(lake, str(raw)), *load_silver(lake), *load_gold(lake), run_quality(lake)]
    record_loads(lake, audits)
    return {a.table: a.rows for a in audits}


def multiset(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


def check(lake):
    for layer, tables in EXPECTED.items():
        for name, expected in tables.items():
            got = lake.read(layer and getattr(lake, layer), name, COLUMNS.get(name))
            assert multiset(got.collect()) == multiset(expected), name
    assert lake.read(lake.silver, "dim_uf").count() == 27


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    fixtures_raw.write(folder)
    return folder


LAYOUTS = {
    "folders": dict(catalog=False),
    "external": dict(catalog=True),
    "bucketed": dict(catalog=True, buckets=4),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_load_twice(spark, tmp_path, raw, layout):
    schemas = {layer: f"{layout}_{layer}" for layer in ("bronze", "silver", "gold")}
    lake = Lakehouse(spark, root=str(tmp_path / "lake"), **schemas, **LAYOUTS[layout])
    first = run(lake, raw)
    assert len(first) == 6 + 8 + 4 + 1
    assert sorted(first.values()) == sorted([3, 9, 2, 3, 6, 6, 27, 8, 2, 28, 14, 7, 8, 2, 6, 3, 8, 8, 6 + LOST])
    check(lake)
    assert run(lake, raw) == first
    check(lake)
    history = lake.read(lake.gold, "relatorio_qualidade")
    assert history.count() == 2 * (6 + LOST)
    own = history.where("tabela = 'municipio_ano_integrada'")
    assert {(r.teste, r.metrica, r.valor, r.status) for r in own.collect()} == REPORT
    assert history.columns == q.REPORT_SCHEMA.names
    lost = history.where("tabela <> 'municipio_ano_integrada' AND valor > 0").distinct().collect()
    assert {(r.tabela, r.metrica, r.valor) for r in lost} == {("municipio", "rejeitados_ano", 1.0)}
    health = {(r.sinal, r.alvo): r.valor for r in load_health(lake).collect()}
    assert len(health) == 19 + 6 + LOST
    assert health["carga", lake.table(lake.bronze, "municipio").label] == 9.0
    assert health["qualidade", "municipio.rejeitados_ano"] == 1.0


def test_broken_lines_do_not_stop_the_load(spark, tmp_path, raw):
    with open(raw / "municipio.csv", "a", encoding="utf-8") as file:
        file.write("2024,3550308,2\n2024,3550308,2,3,61.0,730.0,extra\n")
    lake = Lakehouse(spark, root=str(tmp_path / "lake"), catalog=False)
    rows = run(lake, raw)
    check(lake)
    assert rows[lake.table(lake.bronze, "municipio").label] == 9
    assert lake.quarantine("municipio").read(spark).count() == 2
    told = {(r.tabela, r.metrica): (r.valor, r.status) for r in lake.read(lake.gold, "relatorio_qualidade").collect()}
    assert told["municipio", "linhas_rejeitadas"] == (2.0, "alerta") and told["uf", "linhas_rejeitadas"] == (0.0, "ok")
    bad = load_health(lake).where("sinal = 'carga' AND status = 'alerta'").collect()
    assert [r.alvo for r in bad] == [lake.table(lake.bronze, "municipio").label]


def test_managed_tables(spark, raw):
    lake = Lakehouse(spark, "m_bronze", "m_silver", "m_gold")
    run(lake, raw)
    check(lake)
    assert lake.read(lake.bronze, "alunos").columns[-2:] == ["_arquivo_origem", "_ingestao_ts"]


def test_raw_layer_is_text_with_provenance(spark, tmp_path, raw):
    lake = Lakehouse(spark, root=str(tmp_path / "lake"), catalog=False)
    land_all(lake, str(raw))
    table = lake.read(lake.bronze, "municipio")
    assert {t for c, t in table.dtypes if c != "_ingestao_ts"} == {"string"}
    assert dict(table.dtypes)["_ingestao_ts"] == "timestamp"
    assert {r[0] for r in table.select("_arquivo_origem").distinct().collect()} == {"municipio.csv"}
    assert lake.raw("municipio").columns == fixtures_raw.FILES["municipio.csv"][0].split(",")
    assert lake.raw("municipio").where("taxa_alfabetizacao IS NULL").count() == 1


def test_raw_schema_may_change(spark, tmp_path, raw):
    lake = Lakehouse(spark, "c_bronze", "c_silver", "c_gold", root=str(tmp_path / "lake"))
    land_all(lake, str(raw), {"uf.csv": "uf"})
    (raw / "uf.csv").write_text("ano,sigla_uf,nova\n2023,SP,1\n")
    land_all(lake, str(raw), {"uf.csv": "uf"})
    assert lake.raw("uf").columns == ["ano", "sigla_uf", "nova"]


def test_extraction_feeds_the_load(spark, tmp_path, raw):
    """Wide sources with other networks and columns give the same tables as the files."""
    sources = {}
    for file, name in RAW_ENTITIES.items():
        table = read_csv_text(spark, str(raw / file)).withColumn("extra", F.lit("x"))
        if name in ("uf", "municipio"):
            table = table.union(table.withColumn("rede", F.lit("0")))
        if name == "alunos":
            table = table.union(table.withColumn("id_municipio", F.lit("1100015")))
        sources[name] = table
    extract_all(spark, sources, str(tmp_path / "csv"), EXTRACTS | {"alunos": STUDENT_SAMPLE})
    lake = Lakehouse(spark, root=str(tmp_path / "lake"), catalog=False)
    run(lake, tmp_path / "csv")
    check(lake)
