"""One key holds a third of all rows: results against brute force, and what the hot key may cost."""

from __future__ import annotations

from collections import defaultdict

import pytest

from indicator_engine import operators as op
from indicator_engine.names import Names
from indicator_engine.operators import quality as q

HOT = "3500000"
ROWS = 30_000
N = Names()


def generated():
    for i in range(ROWS):
        entity = HOT if i % 3 == 0 else f"{11 + i % 7}{i % 991:05d}"
        yield str(2020 + (i // 3) % 5), entity, str((i * 37 % 1000) / 10), str(i % 13)


@pytest.fixture(scope="module")
def data():
    return list(generated())


@pytest.fixture(scope="module")
def raw(spark, data):
    schema = "ano string, id_municipio string, taxa_alfabetizacao string, media_portugues string"
    return spark.createDataFrame(data, schema).repartition(8).cache()


def test_fact(raw, data):
    groups = defaultdict(list)
    for year, entity, rate, score in data:
        groups[int(year), entity].append((float(rate), float(score)))
    got = {(r.ano, r.id_municipio): r for r in op.yearly_means(raw, "ano", ["id_municipio"], N.measures).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        rates, scores = zip(*values)
        assert got[key].taxa_alfabetizacao == pytest.approx(sum(rates) / len(rates))
        assert got[key].media_portugues == pytest.approx(sum(scores) / len(scores))


def test_latest(raw, data):
    best = {}
    for row in data:
        year, entity, rate, score = row
        candidate = (-int(year), rate, score)
        best[entity] = min(best.get(entity, candidate), candidate)
    latest = op.latest_by_key(raw, ["id_municipio"])
    got = {r.id_municipio: (-int(r.ano), r.taxa_alfabetizacao, r.media_portugues) for r in latest.collect()}
    assert got == best


def test_duplicates(raw, data):
    surplus = ROWS - len({(y, e) for y, e, *_ in data})
    report = q.run_checks(raw, "t", [q.duplicates(["ano", "id_municipio"])])
    assert report.first().valor == surplus


def shuffled_records(df):
    """Records each exchange of the executed plan wrote."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        else:
            if name == "Exchange":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
    return found


def test_the_hot_key_is_reduced_before_every_shuffle(raw, data):
    """Per map task at most one record per group crosses the shuffle."""
    tasks = raw.rdd.getNumPartitions()
    keys = len({e for _, e, *_ in data})
    groups = len({(y, e) for y, e, *_ in data})
    only_hot = raw.where(f"id_municipio = '{HOT}'")
    for df, limit in (
        (op.yearly_means(only_hot, "ano", ["id_municipio"], N.measures), tasks * 5),
        (op.latest_by_key(only_hot, ["id_municipio"]), tasks),
        (op.yearly_means(raw, "ano", ["id_municipio"], N.measures), tasks * groups),
        (op.latest_by_key(raw, ["id_municipio"]), tasks * keys),
    ):
        written = shuffled_records(df)
        assert written and max(written) <= limit
        assert max(written) < ROWS / 3 or limit > ROWS / 3
