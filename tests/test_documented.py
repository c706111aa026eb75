from __future__ import annotations

import datetime as dt

from indicator_engine import operators as op
from indicator_engine.operators import quality as q
from indicator_engine.sinks import AUDIT_SCHEMA

DAY = dt.datetime(2026, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_indicator_from_scores(spark):
    raw = spark.createDataFrame(
        [("2023", "a", "743"), ("2023", "a", "742.9"), ("2023", "a", ""), ("2023", "b", "x")],
        "ano string, id_municipio string, proficiencia string",
    )
    assert rows(op.indicator_from_scores(raw)) == [(2023, "a", 0.5), (2023, "b", None)]


def test_attach_region_target(spark):
    integrated = spark.createDataFrame([(2024, "a", "S"), (2023, "a", "S"), (2024, "b", None)], "ano int, id string, sigla_uf string")
    targets = spark.createDataFrame([("S", 2024, 70.0), (None, 2024, 1.0)], "sigla_uf string, ano_meta int, meta_taxa double")
    joined = op.attach_region_target(integrated, targets)
    assert joined.columns == ["ano", "id", "sigla_uf", "meta_uf"]
    assert rows(joined) == [(2023, "a", "S", None), (2024, "a", "S", 70.0), (2024, "b", None, None)]


def test_apply_updates(spark):
    schema = "id_municipio string, ano int, taxa_alfabetizacao double, media_portugues double"
    fact = spark.createDataFrame([("a", 2024, 1.0, 1.0), ("a", 2023, 2.0, 2.0), ("b", 2024, 3.0, 3.0)], schema)
    events = spark.createDataFrame(
        [
            ("a", 2024, 10.0, 10.0, DAY),
            ("a", 2024, 20.0, None, DAY + dt.timedelta(hours=1)),
            ("a", 2024, 99.0, 99.0, None),
            ("z", 2024, 5.0, 5.0, DAY),
        ],
        schema + ", evento_ts timestamp",
    )
    updated = op.apply_updates(fact, events)
    assert updated.columns == fact.columns
    assert rows(updated) == [("a", 2023, 2.0, 2.0), ("a", 2024, 20.0, 1.0), ("b", 2024, 3.0, 3.0)]


def test_priority_list(spark):
    product = spark.createDataFrame(
        [(2024, "a", -5.0), (2024, "b", 3.0), (2024, "c", -9.0), (2024, "d", None)],
        "ano int, id_municipio string, gap_meta double",
    )
    assert [r.id_municipio for r in op.priority_list(product, 2).collect()] == ["c", "a"]
    assert op.priority_list(product, 10).count() == 3


def test_health(spark):
    later = DAY + dt.timedelta(days=1)
    audits = spark.createDataFrame([("uf", 5, 0, DAY), ("uf", 2, 1, later), ("vazia", 0, 0, DAY)], AUDIT_SCHEMA)
    history = spark.createDataFrame(
        [
            ("t", "tab", "m", 3.0, "alerta", "", DAY),
            ("t", "tab", "m", 0.0, "ok", "", later),
            ("t", "tab", "n", 1.0, "alerta", "", DAY),
        ],
        q.REPORT_SCHEMA,
    )
    assert rows(op.health(audits, history)) == sorted(
        [
            ("carga", "uf", 2.0, "alerta", later),
            ("carga", "vazia", 0.0, "ok", DAY),
            ("qualidade", "tab.m", 0.0, "ok", later),
            ("qualidade", "tab.n", 1.0, "alerta", DAY),
        ],
        key=repr,
    )
