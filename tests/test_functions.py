from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from indicator_engine.functions import (
    as_double,
    as_int,
    as_key,
    as_timestamp,
    decode,
    flag_from_text,
    pad_key,
    percentage,
    round_half_up,
    snake_columns,
    typed,
)


def values(spark, rows, column):
    df = spark.createDataFrame([(v,) for v in rows], "v string")
    return [r[0] for r in df.select(column).collect()]


def test_text_that_does_not_parse_becomes_null(spark):
    assert values(spark, ["2023", "2023.0", "", "x", None], as_int("v")) == [2023, None, None, None, None]
    assert values(spark, ["55.5", "7", "", "x", None], as_double("v")) == [55.5, 7.0, None, None, None]


def test_keys_stay_text(spark):
    assert values(spark, ["0012"], as_key("v")) == ["0012"]
    assert spark.range(1).select(as_key("id")).dtypes[0][1] == "string"


def test_timestamp_with_offset_and_bad_text(spark):
    got = values(spark, ["2026-07-14T18:30:00.125+00:00", "yesterday", None], as_timestamp("v"))
    assert got == [dt.datetime(2026, 7, 14, 18, 30, 0, 125000), None, None]


def test_typed_replaces_in_place(spark):
    df = spark.createDataFrame([("1", "a", "2.5")], "x string, y string, z string")
    assert typed(df, {"x": "int", "z": "double"}).dtypes == [("x", "int"), ("y", "string"), ("z", "double")]


def test_null_flag_text_is_zero(spark):
    got = values(spark, ["1", "Sim", "TRUE", "0", "1.0", "", None], flag_from_text("v"))
    assert got == [1, 1, 1, 0, 0, 0, 0]


def test_pad_key_never_cuts(spark):
    assert values(spark, ["12", "1234567", "123456789", None], pad_key("v")) == [
        "0000012",
        "1234567",
        "123456789",
        None,
    ]


def test_decode_network(spark):
    assert values(spark, ["3", "9", None], decode("v")) == ["Municipal", None, None]


def test_round_half_up(spark):
    half = F.col("v").cast("double")
    assert values(spark, ["0.125", "-0.125", "2.5"], round_half_up(half, 2)) == [0.13, -0.13, 2.5]
    assert values(spark, ["0.12499999999999"], round_half_up(half, 2, 8)) == [0.13]


@pytest.mark.parametrize("part, total, expected", [(1, 4, 25.0), (0, 0, 0.0)])
def test_percentage(spark, part, total, expected):
    assert spark.range(1).select(percentage(F.lit(part), F.lit(total))).first()[0] == expected


def test_snake_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Código Município", "taxaMédia", "_rn", "id_uf"])
    assert snake_columns(df).columns == ["codigo_municipio", "taxa_media", "_rn", "id_uf"]


ODD_TEXT = [
    "", " ", "1", " 1 ", "+1", "-1", "--1", "1.", "1.5", ".5", ".", "-.5", "+.", "1e3", "1e", "e3", "1E-3", "1.5e+3", "1,5", "1 2",
    "2147483647", "2147483648", "-2147483648", "-2147483649", "2147483647.9", "99999999999999999999", "NaN", "nan", "-NaN",
    "Infinity", "-infinity", "+Infinity", "inf", "-Inf", "INF", "1d", "1f", "1D", "1.5F", "0x1p3", "0x10", "1_000", "\t1\n",
    "\u00a01", "1\u00a0", "\u0661", "\x001", "\x7f1", "1e400", "-1e400", "1e-400", "2003.0", "true", None, "Infinityd", "nanf", "1l",
]


@pytest.mark.parametrize(("guarded", "kind"), [(as_int, "int"), (as_double, "double")])
def test_the_guard_accepts_what_the_cast_accepts(spark, guarded, kind):
    df = spark.createDataFrame([(v,) for v in ODD_TEXT], "v string")
    for r in df.select("v", guarded("v").alias("a"), F.col("v").try_cast(kind).alias("b")).collect():
        assert str(r.a) == str(r.b), repr(r.v)
    assert spark.range(1).select(guarded("id")).dtypes[0][1] == kind


VALUES = {
    "string": ["1", " 2 ", "2023.0", "1e3", "x", "", None, "3000000000", "NaN", "-.5"],
    "double": [1.5e7, -3.9, 1e20, float("nan"), float("inf"), None, 0.0],
    "float": [1.5, 2.5e9, None],
    "decimal(20,4)": ["15000000.5", "99999999999.5", "-1", None],
    "boolean": [True, False, None],
    "bigint": [5, 2**40, None],
    "int": [7, -7, None],
}


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("cast, target", [(as_int, "int"), (as_double, "double")])
def test_casts_equal_try_cast_for_every_type(spark, kind, cast, target):
    values = [(i, None if v is None else str(v)) for i, v in enumerate(VALUES[kind])]
    df = spark.createDataFrame(values, "i int, t string").select("i", F.col("t").cast(kind).alias("v"))
    both = df.select("i", cast("v").alias("own"), F.col("v").try_cast(target).alias("plain"))
    assert [r.own for r in both.collect() if r.own is not None and r.own == r.own] == [
        r.plain for r in both.collect() if r.plain is not None and r.plain == r.plain
    ]
    assert both.where("NOT (own <=> plain)").count() == 0
    if kind != "string":
        assert "RLIKE" not in both._jdf.queryExecution().optimizedPlan().toString()
