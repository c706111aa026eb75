from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from indicator_engine.session import shared_folder
from indicator_engine.sinks import (
    LoadAudit,
    Table,
    append,
    audit_frame,
    ensure_schema,
    export_csv,
    land_raw,
    overwrite,
    publish,
    publish_partitions,
    record,
)
from indicator_engine.sources import read_csv_text, read_raw


def test_csv_round_trip_keeps_text_and_null(spark, tmp_path):
    df = spark.createDataFrame([("007", None, "a,b"), ("", "x", 'say "é"')], "id string, v string, t string")
    export_csv(df, str(tmp_path / "csv"))
    back = read_csv_text(spark, str(tmp_path / "csv"))
    assert back.dtypes == df.dtypes
    # an empty field reads as null, also when it was an empty string
    assert {tuple(r) for r in back.collect()} == {("007", None, "a,b"), ("", "x", 'say "é"')}


def test_declared_columns_are_checked_against_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ano,uf\n2023,SP\n")
    path = str(tmp_path / "a.csv")
    assert read_csv_text(spark, path, ["ano", "uf"]).collect() == read_csv_text(spark, path).collect()
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_text(spark, path, ["uf", "ano"]).collect()


def test_origin_defaults_to_the_file_of_each_row(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a", "b"):
        (folder / f"{name}.csv").write_text(f"x\n{name}\n")
    table = Table(path=str(tmp_path / "raw"))
    audit = land_raw(spark, str(folder), table)
    assert (audit.table, audit.rows) == (table.path, 2)
    assert {(r.x, r._arquivo_origem) for r in table.read(spark).collect()} == {("a", "a.csv"), ("b", "b.csv")}
    assert read_raw(table.read(spark)).columns == ["x"]


def test_audit_counts_what_was_written(spark, tmp_path):
    audits = [overwrite(spark.range(n), Table(path=str(tmp_path / str(n)))) for n in (0, 5)]
    assert [r.rows for r in audit_frame(spark, audits).collect()] == [0, 5]


def test_a_table_needs_a_place(spark, tmp_path):
    with pytest.raises(ValueError):
        Table()
    with pytest.raises(ValueError):
        overwrite(spark.range(1), Table(path=str(tmp_path / "b")), bucket_by="id", buckets=2)


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def _failing(df):
    return df.withColumn("v", F.raise_error(F.lit("broken")).cast("long"))


@pytest.mark.parametrize("kind", ["folder", "managed", "external", "partitioned"])
def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path, kind):
    ensure_schema(spark, "keep_rows")
    path = str(tmp_path / "t") if kind != "managed" else None
    table = Table(f"keep_rows.{kind}" if kind in ("managed", "external") else None, path)
    write = (lambda df: publish(df, table, "y")) if kind == "partitioned" else (lambda df: overwrite(df, table))
    rows = spark.range(10).selectExpr("id AS v", "id % 2 AS y")
    write(rows)
    with pytest.raises(Exception, match="broken"):
        write(_failing(rows))
    assert table.read(spark).count() == 10
    assert write(rows.where("v < 4")).rows == 4
    assert table.read(spark).count() == 4
    assert [p for p in tmp_path.iterdir() if "staged" in p.name] == []


@pytest.mark.parametrize("kind", ["managed", "external", "partitioned", "bucketed"])
def test_a_catalog_table_is_never_half_of_two_versions(spark, tmp_path, monkeypatch, kind):
    """The last step, pointing the catalog to the new files, is cut off: the old rows stay; then it is done."""
    ensure_schema(spark, "whole_rows")
    table = Table(f"whole_rows.{kind}", None if kind == "managed" else str(tmp_path / "t"))
    write = {
        "partitioned": lambda df: publish(df, table, "y"),
        "bucketed": lambda df: overwrite(df, table, bucket_by="v", buckets=3),
    }.get(kind, lambda df: overwrite(df, table))
    rows = spark.range(10).selectExpr("id AS v", "id % 2 AS y")
    write(rows)
    write(rows.where("v < 9"))

    def cut(*_, **__):
        raise RuntimeError("cut off")

    with monkeypatch.context() as patch:
        patch.setattr(Table, "_point", cut)
        with pytest.raises(RuntimeError):
            write(rows.where("v > 5"))
    assert sorted(r.v for r in table.read(spark).collect()) == list(range(9))
    reader = table.read(spark)  # begun before the next version
    assert write(rows.where("v > 5")).rows == 4
    assert sorted(r.v for r in table.read(spark).collect()) == [6, 7, 8, 9]
    assert reader.count() in (4, 9)
    assert [t.name for t in spark.catalog.listTables("whole_rows") if "__" in t.name] == []
    if kind == "bucketed":
        by_key = table.read(spark).groupBy("v").count()
        assert "hashpartitioning" not in by_key._jdf.queryExecution().executedPlan().toString()


def test_old_versions_go(spark, tmp_path):
    ensure_schema(spark, "versions")
    table = Table("versions.t", str(tmp_path / "t"))
    for n in range(1, 6):
        overwrite(spark.range(n), table)
    assert table.read(spark).count() == 5
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]) == 2
    append(spark.range(3), table, spark.range(3).schema)
    assert table.read(spark).count() == 8
    overwrite(spark.range(2).selectExpr("id", "'x' AS more"), table)
    assert table.read(spark).columns == ["id", "more"]


def test_years_are_replaced_alone(spark, tmp_path):
    ensure_schema(spark, "years")
    table = Table("years.t", str(tmp_path / "t"))
    rows = spark.range(12).selectExpr("id AS v", "CAST(nullif(2020 + id % 4, 2023) AS int) AS ano")
    publish(rows, table)
    places = lambda: {f.split("/ano=")[1].split("/")[0]: f.split("/")[-3] for f in table.read(spark).inputFiles()}
    before = places()
    assert publish_partitions(rows.where("ano = 2021").selectExpr("v * 10 AS v", "ano"), table, [2021]).rows == 3
    after = places()
    assert {y for y in before if before[y] != after[y]} == {"2021"}
    publish_partitions(rows.where("false"), table, [2022])
    publish_partitions(rows.where("ano IS NULL").selectExpr("v + 100 AS v", "ano"), table, [None])
    got = sorted(((r.v, r.ano) for r in table.read(spark).collect()), key=repr)
    assert got == sorted(
        [(v, 2020) for v in (0, 4, 8)] + [(v, 2021) for v in (10, 50, 90)] + [(v, None) for v in (103, 107, 111)], key=repr
    )


BROKEN = 'ano,uf,v\n2023,SP,1\n2024,RJ\n2025,MG,3,4\n2026,"BA,5\n2027,"x""y",6\n\n2029,"open\nclose",8\n'
LINES = ["2024,RJ", "2025,MG,3,4", '2026,"BA,5', '2029,"open', 'close",8']


@pytest.mark.parametrize("declared", [["ano", "uf", "v"], None])
def test_lines_of_another_width_go_into_quarantine(spark, tmp_path, declared):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(BROKEN)
    (folder / "b.csv").write_text("ano,uf,v\n2030,AM,9\n")
    table, quarantine = Table(path=str(tmp_path / "raw")), Table(path=str(tmp_path / "rejected"))
    land = lambda **more: land_raw(spark, str(folder), table, columns=declared, **more)
    with pytest.raises(Exception):
        land()
    audit = land(quarantine=quarantine)
    assert (audit.rows, audit.rejected) == (3, 5)
    assert {tuple(r)[:4] for r in table.read(spark).collect()} == {
        ("2023", "SP", "1", "a.csv"), ("2027", 'x"y', "6", "a.csv"), ("2030", "AM", "9", "b.csv")
    }
    assert quarantine.read(spark).columns == ["_linha", "_valores", "_arquivo_origem", "_ingestao_ts"]
    assert sorted((r[0], r[2]) for r in quarantine.read(spark).collect()) == sorted((x, "a.csv") for x in LINES)
    (folder / "a.csv").write_text("ano,uf,v\n2023,SP,1\n")
    assert land(quarantine=quarantine).rejected == 0
    assert quarantine.read(spark).count() == 0


def test_a_quarantine_reads_values_with_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n2\n3,z\n')
    table, quarantine = Table(path=str(tmp_path / "raw")), Table(path=str(tmp_path / "rejected"))
    audit = land_raw(spark, str(tmp_path / "a.csv"), table, multi_line=True, quarantine=quarantine)
    assert (audit.rows, audit.rejected) == (2, 1)
    assert {(r.a, r.b) for r in table.read(spark).collect()} == {("1", "x\ny"), ("3", "z")}


def test_audit_history(spark, tmp_path):
    history = Table(path=str(tmp_path / "audits"))
    for n in (1, 2):
        record(spark, [LoadAudit("a", n, 3), LoadAudit("b", 0)], history)
    assert sorted(tuple(r)[:3] for r in history.read(spark).collect()) == [("a", 1, 3), ("a", 2, 3), ("b", 0, 0), ("b", 0, 0)]


def test_csv_keeps_every_value(spark, tmp_path):
    values = [' lead', 'trail ', 'say "hi", you', 'back\\slash', 'a\nb', 'x,"', None, "1"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i string, v string")
    export_csv(df, str(tmp_path / "csv"))
    back = read_csv_text(spark, str(tmp_path / "csv"), ["i", "v"], multi_line=True)
    assert {(r.i, r.v) for r in back.collect()} == {(str(i), v) for i, v in enumerate(values)}
    with pytest.raises(Exception):
        read_csv_text(spark, str(tmp_path / "csv"), ["i", "v"]).collect()


@pytest.mark.parametrize("second", ["uf,ano\nRJ,2023\n", "ano,uf,x\n2023,RJ,1\n"])
@pytest.mark.parametrize("declared", [["ano", "uf"], None])
def test_columns_are_never_taken_by_position(spark, tmp_path, second, declared):
    (tmp_path / "a.csv").write_text("ano,uf\n2024,SP\n")
    (tmp_path / "b.csv").write_text(second)
    with pytest.raises(Exception):
        read_csv_text(spark, str(tmp_path), declared).collect()
