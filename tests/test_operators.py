from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from indicator_engine import operators as op
from indicator_engine.names import Names
from indicator_engine.operators.targets import latest_overall
from indicator_engine.sources import EXTRACTS, STUDENT_SAMPLE, Extract, extract, state_dimension

N = Names()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, v) for v in t))


@pytest.fixture
def states(spark):
    return state_dimension(spark)


RAW = "ano string, id_municipio string, taxa_alfabetizacao string, media_portugues string"


def test_state_dimension(states):
    assert states.columns == ["codigo_uf", "sigla_uf", "nome_uf", "regiao"]
    assert states.count() == 27 == states.select("codigo_uf").distinct().count()
    per_region = dict(states.groupBy("regiao").count().collect())
    assert per_region == {"Norte": 7, "Nordeste": 9, "Sudeste": 4, "Sul": 3, "Centro-Oeste": 4}


def test_entity_year_fact(spark, states):
    raw = spark.createDataFrame(
        [
            ("2023", "3550308", "50.0", "700"),
            ("2023", "3550308", "60.0", ""),
            ("2024", "3550308", None, "710"),
            ("2023", "9900001", "40", "600"),
            ("2023.0", "1100015", "30", "500"),
            ("2023", None, "10", "1"),
        ],
        RAW,
    )
    fact = op.entity_year_fact(raw, states, literal_territory=True)
    assert fact.columns == [
        "codigo_uf", "ano", "id_municipio", "taxa_alfabetizacao", "media_portugues", "sigla_uf", "nome_uf", "regiao",
    ]
    assert rows(fact) == [
        ("11", None, "1100015", 30.0, 500.0, "RO", "Rondonia", "Norte"),
        ("35", 2023, "3550308", 55.0, 700.0, "SP", "Sao Paulo", "Sudeste"),
        ("35", 2024, "3550308", None, 710.0, "SP", "Sao Paulo", "Sudeste"),
        ("99", 2023, "9900001", 40.0, 600.0, None, None, None),
        (None, 2023, None, 10.0, 1.0, None, None, None),
    ]


def test_region_year_fact(spark):
    raw = spark.createDataFrame(
        [("2023", "SP", "50", "700"), ("2023", "SP", "70", "720"), ("2024", "SP", "", "1")],
        RAW.replace("id_municipio", "sigla_uf"),
    )
    assert rows(op.region_year_fact(raw)) == [(2023, "SP", 60.0, 710.0), (2024, "SP", None, 1.0)]


def test_latest_by_key_null_year_loses_and_ties_are_stable(spark):
    data = [("a", None, "z"), ("a", "2023", "x"), ("a", "2024", "q"), ("a", "2024", "p"), ("b", None, "only")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, ano string, v string").repartition(4)
        assert rows(op.latest_by_key(df, ["k"])) == [("a", "2024", "p"), ("b", None, "only")]
        assert rows(op.latest_by_key(df, ["k"], ties=["v"])) == [("a", "2024", "p"), ("b", None, "only")]


def test_latest_year_is_compared_as_number(spark):
    df = spark.createDataFrame([("a", "999"), ("a", "2024")], "k string, ano string")
    assert rows(op.latest_by_key(df, ["k"])) == [("a", "2024")]
    assert rows(latest_overall(df)) == [("a", "2024")]


def test_unpivot_keeps_null_targets(spark):
    wide = spark.createDataFrame(
        [("a", "50.5", None, "bad")],
        "k string, meta_alfabetizacao_2024 string, meta_alfabetizacao_2025 string, meta_alfabetizacao_2026 string",
    )
    long = op.unpivot_targets(wide, ["k"], [2024, 2025, 2026])
    assert long.dtypes == [("k", "string"), ("ano_meta", "int"), ("meta_taxa", "double")]
    assert rows(long) == [("a", 2024, 50.5), ("a", 2025, None), ("a", 2026, None)]
    assert rows(op.unpivot_targets(wide, [], [2024])) == [(2024, 50.5)]


def test_targets_of_the_newest_version(spark):
    wide = spark.createDataFrame(
        [("2023", "a", "1"), ("2024", "a", "2"), (None, "b", "3"), ("2023", None, "4")],
        "ano string, id_municipio string, meta_alfabetizacao_2024 string",
    )
    assert rows(op.keyed_targets(wide, "id_municipio", [2024])) == [("a", 2024, 2.0), ("b", 2024, 3.0), (None, 2024, 4.0)]
    assert rows(op.national_targets(wide, [2024])) == [(2024, 2.0)]


FACT = (
    "ano int, id_municipio string, sigla_uf string, nome_uf string, regiao string, "
    "taxa_alfabetizacao double, media_portugues double"
)
TARGETS = "id_municipio string, ano_meta int, meta_taxa double"


@pytest.mark.parametrize("unique", [True, False])
def test_integrate(spark, unique):
    fact = spark.createDataFrame(
        [
            (2023, "a", "S", "N", "R", 50.0, 1.0),
            (2024, "a", "S", "N", "R", 60.0, 1.0),
            (2024, "b", None, None, None, None, 1.0),
            (2025, "a", "S", "N", "R", 59.0, 1.0),
            (None, "a", "S", "N", "R", 1.0, 1.0),
            (2024, None, None, None, None, 2.0, 2.0),
        ],
        FACT,
    )
    targets = spark.createDataFrame(
        [("a", 2024, 60.0), ("a", 2025, 60.0), ("a", 2026, 70.0), ("b", 2024, 10.0), (None, 2024, 9.0)], TARGETS
    )
    got = {(r.ano, r.id_municipio): r for r in op.integrate(fact, targets, unique_inputs=unique).collect()}
    assert len(got) == 6
    seen = {k: (r.meta_ano_corrente, r.gap_meta, r.atingiu_meta) for k, r in got.items()}
    assert seen == {
        (2023, "a"): (None, None, None),
        (2024, "a"): (60.0, 0.0, 1),
        (2025, "a"): (60.0, -1.0, 0),
        (2024, "b"): (10.0, None, None),
        (None, "a"): (None, None, None),
        (2024, None): (None, None, None),
    }


def test_integrate_removes_equal_rows(spark):
    fact = spark.createDataFrame([(2024, "a", "S", "N", "R", 1.0, 1.0)] * 3, FACT)
    targets = spark.createDataFrame([("a", 2024, 1.0)], TARGETS)
    assert op.integrate(fact, targets).count() == 1
    assert op.integrate(fact, targets, unique_inputs=True).count() == 3


INTEGRATED = FACT + ", meta_ano_corrente double, gap_meta double, atingiu_meta int"


@pytest.fixture
def integrated(spark):
    return spark.createDataFrame(
        [
            (2021, "a", "S", "N", "R", 40.0, 1.0, None, None, None),
            (2023, "a", "S", "N", "R", 50.005, 1.0, 45.0, 5.005, 1),
            (2024, "a", "S", "N", "R", 45.0, 1.0, 50.0, -5.0, 0),
            (2023, "b", "S", "N", "R", None, 1.0, 45.0, None, None),
            (2023, "c", None, None, None, 10.0, 1.0, None, None, None),
        ],
        INTEGRATED,
    )


def test_latest_indicator(integrated):
    assert [(r.id_municipio, r.ano) for r in op.latest_indicator(integrated).orderBy("id_municipio").collect()] == [
        ("a", 2024),
        ("b", 2023),
        ("c", 2023),
    ]
    assert op.latest_indicator(integrated).columns == integrated.columns


def test_target_vs_result(integrated):
    product = op.target_vs_result(integrated)
    assert product.columns == [
        "ano", "id_municipio", "sigla_uf", "regiao", "taxa_alfabetizacao", "meta_ano_corrente", "gap_meta",
        "atingiu_meta",
    ]
    assert [(r.ano, r.id_municipio) for r in product.orderBy("id_municipio", "ano").collect()] == [
        (2023, "a"),
        (2024, "a"),
        (2023, "b"),
    ]


def test_evolution_is_previous_row_not_previous_year(integrated):
    assert rows(op.evolution(integrated).where("id_municipio = 'a'")) == [
        (2021, "a", "S", 40.0, None, None),
        (2023, "a", "S", 50.005, 40.0, pytest.approx(10.005)),
        (2024, "a", "S", 45.0, 50.005, pytest.approx(-5.005)),
    ]


def test_region_summary(integrated):
    summary = op.region_summary(integrated)
    assert summary.columns == [
        "ano", "sigla_uf", "regiao", "qtd_municipios", "taxa_media", "prop_municipios_na_meta",
    ]
    assert rows(summary) == [
        (2021, "S", "R", 1, 40.0, None),
        (2023, "S", "R", 2, 50.01, 1.0),
        (2023, None, None, 1, 10.0, None),
        (2024, "S", "R", 1, 45.0, 0.0),
    ]


def test_sample_indicator(spark):
    raw = spark.createDataFrame(
        [
            ("2023", "35", "Sim", "700"),
            ("2023", "35", "TRUE", ""),
            ("2023", "35", None, "800"),
            ("2023", "35", "1.0", "x"),
        ],
        "ano string, id_municipio string, alfabetizado string, proficiencia string",
    )
    assert rows(op.sample_indicator(raw)) == [(2023, "35", 4, 750.0, 0.5)]


def test_coverage_profile(spark):
    raw = spark.createDataFrame([("3", "2023"), ("3", "2023"), (None, "2023")], "rede string, ano string")
    assert rows(op.coverage_profile(raw)) == [("3", "2023", 2), (None, "2023", 1)]


def test_missing_from_leaves_null_out(spark):
    df = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "c string")
    known = spark.createDataFrame([("a",), (None,)], "c string")
    assert rows(op.missing_from(df, known, "c")) == [("z",)]


def test_ordered_sample_is_exact_and_repeatable(spark):
    """Against a brute-force sort, with a third of all rows equal and null keys."""
    rng = random.Random(7)
    data = [(rng.choice([None, "a", "b", "c"]), rng.randrange(40)) for _ in range(2000)] + [("a", 1)] * 1000
    df = spark.createDataFrame(data, "k string, v int")
    want = sorted(data, key=lambda t: (t[0] is None, t[0] or "", t[1]))
    for n in (1, 700, 1500, 5000):
        for parts in (1, 13):
            for scanned in (False, True):
                sample = op.ordered_sample(df.repartition(parts), n, ["k", "v"], scanned=scanned)
                assert [tuple(r) for r in sample.collect()] == want[:n]


ORDERS = {
    "int, text": ("a int, b string", lambda r: (r.choice([None, -5, 3, 2**31 - 1, -(2**31)]), r.choice(["", "ab", "é", None, "\U0001f600z"]))),
    "text, int": ("a string, b int", lambda r: ("".join(r.choices("abé\uffff", k=r.randrange(12))) or None, r.randrange(3))),
    "double, text": ("a double, b string", lambda r: (r.choice([None, float("-inf"), -0.5, 1e300, r.random()]), "x")),
    "long, int": ("a long, b int", lambda r: (r.choice([None, -(2**62), 2**62, r.randrange(9)]), r.randrange(9))),
    "int, int, text": ("a int, b int, c string", lambda r: (r.choice([1, None]), r.choice([7, 2**31 - 1, None]), r.choice("pq"))),
    "date, text": ("a date, b string", lambda r: (r.choice([None, datetime.date(1960, 1, 1), datetime.date(2020, 5, r.randrange(1, 9))]), "y")),
    "boolean, int": ("a boolean, b int", lambda r: (r.choice([None, True, False]), r.randrange(50))),
}


@pytest.mark.parametrize("kind", ORDERS)
def test_cut_samples_of_every_type(spark, kind):
    """The image of the order key never falls along the order, and nothing of the sample is cut."""
    schema, make = ORDERS[kind]
    rng = random.Random(3)
    df = spark.createDataFrame([make(rng) for _ in range(1500)], schema).repartition(7)
    order = [F.col(c).asc_nulls_last() for c in df.columns]
    whole = [tuple(r) for r in df.orderBy(*order).collect()]
    for n in (1, 40, 1499, 1600):
        assert [tuple(r) for r in op.ordered_sample(df, n, df.columns, scanned=True).collect()] == whole[:n]
    image = op.sampling.order_image(df, df.columns)
    assert (image is None) == (kind == "boolean, int")
    if image is not None:
        images = [r[0] for r in df.orderBy(*order).select(image[0]).collect() if r[0] is not None]
        assert images == sorted(images)


def test_cut_does_not_grow_with_partitions(spark, tmp_path):
    """Rows that pass the cut, of input in few or many partitions."""
    rows = spark.range(400_000).selectExpr("CAST(pmod(hash(id), 5) AS int) AS y", "CAST(hash(id, 1) AS string) AS k")
    passed = [op.sampling.below_cut(rows.repartition(parts), 500, ["y", "k"]).count() for parts in (4, 150)]
    assert all(500 <= n < 6000 for n in passed), passed


def test_extract(spark):
    source = spark.createDataFrame(
        [("3", "3501", "x", 1), ("5", "3502", "y", 2), ("3", "1101", "z", 3)],
        "rede string, id_municipio string, serie string, extra int",
    )
    columns = ("rede", "id_municipio")
    assert rows(extract(source, Extract(columns, equals=("rede", "3")))) == [("3", "1101"), ("3", "3501")]
    prefix = Extract(columns, starts_with=("id_municipio", "35"), sample=1)
    assert rows(extract(source, prefix)) == [("3", "3501")]
    assert rows(extract(source, prefix, ["id_municipio"])) == [("3", "3501")]


def test_extract_lists():
    assert EXTRACTS["uf"].equals == ("rede", "5") and EXTRACTS["municipio"].equals == ("rede", "3")
    assert EXTRACTS["alunos"].sample is None and EXTRACTS["alunos"].starts_with is None
    assert STUDENT_SAMPLE.sample == 20000 and STUDENT_SAMPLE.starts_with == ("id_municipio", "35")
    assert [len(e.columns) for e in EXTRACTS.values()] == [6, 6, 11, 12, 13, 10]


def test_preview(spark):
    assert op.preview(spark.range(100), 3).count() == 3


def test_other_column_names(spark):
    names = Names(entity="site", rate="yield", score="cost", code="zone", region="z", region_name="zn", macro="m")
    raw = spark.createDataFrame([(2020, "A1", 1.0, 2.0), (2020, "A1", 3.0, 2.0)], "ano int, site string, yield double, cost double")
    zones = spark.createDataFrame([("A", "za", "zone a", "west")], "zone string, z string, zn string, m string")
    fact = op.entity_year_fact(raw, zones, names, code_length=1)
    assert rows(fact) == [("A", 2020, "A1", 2.0, 2.0, "za", "zone a", "west")]
