from __future__ import annotations

import datetime as dt
import json
import time
import uuid

import pytest
from pyspark.sql import functions as F

from indicator_engine import streaming
from indicator_engine.sinks import Table, append, ensure_schema, publish

GOOD = {
    "id_municipio": "2408102",
    "ano": 2024,
    "taxa_alfabetizacao": 81.5,
    "media_portugues": 750.0,
    "evento_ts": "2025-03-09T07:41:16.250000+00:00",
}
# other field names: both measures stay null
OTHER_FIELDS = {
    "id_municipio": "1100015",
    "ano": 2025,
    "proficiencia_media": 12.5,
    "indicador_alfabetizacao": 0.25,
    "evento_ts": "2026-01-02T03:04:05+00:00",
}


class Inbox:
    def __init__(self, folder):
        self.folder = folder
        folder.mkdir()
        self.n = 0

    def put(self, event):
        text = event if isinstance(event, str) else json.dumps(event)
        (self.folder / f"e{self.n}.json").write_text(text)
        self.n += 1


@pytest.fixture
def inbox(tmp_path):
    return Inbox(tmp_path / "in")


@pytest.fixture
def drain(spark, tmp_path, inbox):
    table = Table(path=str(tmp_path / "out"))

    def run(**options):
        return streaming.ingest(spark, str(inbox.folder), table, str(tmp_path / "checkpoint"), **options)

    return run


def test_each_file_once(drain, inbox):
    inbox.put(GOOD)
    inbox.put(GOOD | {"ano": 2025})
    assert drain().count() == 2
    assert drain().count() == 2
    inbox.put(GOOD | {"ano": 2026})
    assert {r.ano for r in drain().collect()} == {2024, 2025, 2026}
    assert drain().count() == 3


def test_malformed_events_become_nulls(drain, inbox):
    for event in (
        GOOD,
        OTHER_FIELDS,
        GOOD | {"taxa_alfabetizacao": "abc"},
        GOOD | {"evento_ts": "yesterday"},
        "this is not json",
    ):
        inbox.put(event)
    landed = drain()
    assert landed.dtypes == [
        ("id_municipio", "string"),
        ("ano", "int"),
        ("taxa_alfabetizacao", "double"),
        ("media_portugues", "double"),
        ("evento_ts", "timestamp"),
        ("_ingestao_ts", "timestamp"),
    ]
    at = dt.datetime(2025, 3, 9, 7, 41, 16, 250000)
    got = [tuple(r)[:5] for r in landed.collect()]
    assert sorted(got, key=repr) == sorted(
        [
            ("2408102", 2024, 81.5, 750.0, at),
            ("1100015", 2025, None, None, dt.datetime(2026, 1, 2, 3, 4, 5)),
            ("2408102", 2024, None, 750.0, at),
            ("2408102", 2024, 81.5, 750.0, None),
            (None, None, None, None, None),
        ],
        key=repr,
    )
    assert landed.where("_ingestao_ts IS NULL").count() == 0
    assert streaming.rejects(landed).count() == 1
    summary = {tuple(r) for r in streaming.summary_by_year(landed).collect()}
    assert summary == {(2024, 3, 81.5), (2025, 1, None), (None, 1, None)}


def test_stream_equals_batch_in_many_small_batches(spark, drain, inbox):
    for i in range(9):
        inbox.put(GOOD | {"ano": 2020 + i})
    landed = drain(max_files_per_batch=2).drop("_ingestao_ts")
    batch = spark.read.schema(streaming.EVENT_SCHEMA).json(str(inbox.folder))
    batch = batch.withColumn("evento_ts", F.to_timestamp("evento_ts"))
    assert landed.exceptAll(batch).isEmpty() and batch.exceptAll(landed).isEmpty()


def test_named_table(spark, tmp_path, inbox):
    inbox.put(GOOD)
    ensure_schema(spark, "stream_bronze")
    for i, table in enumerate(
        (Table("stream_bronze.managed"), Table("stream_bronze.external", str(tmp_path / "external")))
    ):
        landed = streaming.ingest(spark, str(inbox.folder), table, str(tmp_path / f"c{i}"))
        assert landed.count() == 1
        assert spark.table(table.name).count() == 1


def test_a_file_of_any_age_is_read(drain, inbox):
    import os
    import time

    inbox.put(GOOD)
    assert drain().count() == 1
    inbox.put(GOOD | {"ano": 2025})
    old = time.time() - 30 * 86_400
    os.utime(inbox.folder / "e1.json", (old, old))
    inbox.put(GOOD | {"ano": 2026})
    assert drain().count() == 3


def test_many_small_event_files_become_few(spark, inbox, tmp_path):
    """400 files of one event: two files are written, and many tasks have read."""
    for i in range(400):
        inbox.put(GOOD | {"ano": 2000 + i})
    events = streaming.read_events(spark, str(inbox.folder)).withColumn("reader", F.spark_partition_id())
    landed = streaming.drain(events, Table(path=str(tmp_path / "out")), str(tmp_path / "checkpoint"), files_per_batch=2)
    assert landed.count() == 400
    assert len(list((tmp_path / "out").glob("part-*"))) == 2
    assert landed.select("reader").distinct().count() > 2


def test_drained_files_move_to_the_archive(drain, inbox, tmp_path):
    for i in range(3):
        inbox.put(GOOD | {"ano": 2024 + i})
        assert drain(archive=str(tmp_path / "archive")).count() == i + 1
    deadline = time.time() + 20  # files move in the background
    while time.time() < deadline and len(list(inbox.folder.glob("*.json"))) > 1:
        time.sleep(0.2)
    assert len(list(inbox.folder.glob("*.json"))) == 1
    assert len(list((tmp_path / "archive").rglob("*.json"))) == 2


@pytest.mark.parametrize("named", [True, False])
def test_another_source_lands_the_same_rows(spark, tmp_path, inbox, named):
    lines = [json.dumps(GOOD), json.dumps(OTHER_FIELDS), json.dumps(GOOD | {"taxa_alfabetizacao": "abc"}), "no json"]
    for line in lines:
        inbox.put(line)
    files = streaming.ingest(spark, str(inbox.folder), Table(path=str(tmp_path / "a")), str(tmp_path / "ca"))
    ensure_schema(spark, "event_source")
    source = Table("event_source.lines" if named else None, str(tmp_path / "lines"))
    schema = "value string"
    from_table = lambda: streaming.drain(
        streaming.read_event_table(spark, source), Table(path=str(tmp_path / "b")), str(tmp_path / "cb")
    )
    for part in (lines[:3], lines[3:]):
        frame = spark.createDataFrame([(x,) for x in part], schema)
        append(frame, source, frame.schema)
        landed = from_table()
    assert from_table().count() == 4
    plain = lambda df: sorted(repr(tuple(r)) for r in df.drop("_ingestao_ts").collect())
    assert plain(landed) == plain(files) and landed.dtypes == files.dtypes


@pytest.fixture
def served(spark, tmp_path):
    ensure_schema(spark, "served")
    table = Table(f"served.t_{uuid.uuid4().hex}", str(tmp_path / "served"))
    rows = [("2408102", y, "RN", 50.0, 700.0, None) for y in (2023, 2024, 2025)] + [("1100015", 2025, "RO", 60.0, 710.0, None)]
    schema = "id_municipio string, ano int, sigla_uf string, taxa_alfabetizacao double, media_portugues double, evento_ts timestamp"
    publish(spark.createDataFrame(rows, schema), table)
    return table


def seen(spark, table):
    return {(r.id_municipio, r.ano): (r.sigla_uf, r.taxa_alfabetizacao, r.media_portugues) for r in table.read(spark).collect()}


def absorbed(spark, inbox, tmp_path, table):
    events = streaming.stamp(streaming.read_events(spark, str(inbox.folder)))
    streaming.absorb(events, table, str(tmp_path / "absorbed")).awaitTermination()
    return seen(spark, table)


def test_events_are_absorbed_by_the_served_table(spark, tmp_path, inbox, served):
    places = lambda: {f.split("/ano=")[1][:4]: f for f in served.read(spark).inputFiles()}
    before = places()
    inbox.put(GOOD | {"evento_ts": "2025-01-01T00:00:00+00:00"})
    inbox.put(GOOD | {"taxa_alfabetizacao": 90.0, "media_portugues": None, "evento_ts": "2025-01-02T00:00:00+00:00"})
    inbox.put({"id_municipio": "5", "ano": 2024, "taxa_alfabetizacao": 1.0, "evento_ts": "2025-01-02T00:00:00+00:00"})
    inbox.put({"ano": 2024, "taxa_alfabetizacao": 1.0})
    inbox.put("no json")
    got = absorbed(spark, inbox, tmp_path, served)
    assert got["2408102", 2024] == ("RN", 90.0, 700.0)  # of two events the newest counts; what it lacks stays
    assert got["5", 2024] == (None, 1.0, None)
    assert len(got) == 5 and got["2408102", 2023] == ("RN", 50.0, 700.0)
    assert {y for y, f in places().items() if before[y] != f} == {"2024"}
    # an older event arrives later, and a newer one
    inbox.put(GOOD | {"taxa_alfabetizacao": 10.0, "evento_ts": "2024-12-31T00:00:00+00:00"})
    inbox.put(GOOD | {"ano": 2025, "taxa_alfabetizacao": 77.0, "evento_ts": "2025-01-05T00:00:00+00:00"})
    got = absorbed(spark, inbox, tmp_path, served)
    assert got["2408102", 2024] == ("RN", 90.0, 700.0)
    assert got["2408102", 2025] == ("RN", 77.0, 750.0) and got["1100015", 2025] == ("RO", 60.0, 710.0)


def test_a_batch_that_comes_again_changes_nothing(spark, served):
    events = lambda rate: streaming.stamp(
        spark.createDataFrame([(GOOD["id_municipio"], 2024, rate, None, GOOD["evento_ts"])], streaming.EVENT_SCHEMA)
    )
    assert streaming.absorb_batch(events(1.0), 0, served) == [2024]
    files = served.read(spark).inputFiles()
    assert streaming.absorb_batch(events(2.0), 0, served) == []
    assert served.read(spark).inputFiles() == files
    assert seen(spark, served)["2408102", 2024][1] == 1.0
    assert streaming.absorb_batch(events(3.0), 1, served) == [2024]
    assert streaming.absorb_batch(events(4.0), 0, served, label="other") == [2024]


def test_a_batch_cut_off_before_its_mark_is_done_again(spark, served, monkeypatch):
    events = streaming.stamp(spark.createDataFrame([(GOOD["id_municipio"], 2024, 9.0, None, GOOD["evento_ts"])], streaming.EVENT_SCHEMA))
    from indicator_engine.streaming import events as module

    with monkeypatch.context() as patch:
        patch.setattr(module, "publish_partitions", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            streaming.absorb_batch(events, 0, served)
    assert seen(spark, served)["2408102", 2024][1] == 50.0
    assert streaming.absorb_batch(events, 0, served) == [2024]
    assert seen(spark, served)["2408102", 2024] == ("RN", 9.0, 700.0)
