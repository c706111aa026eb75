"""Every registered query against its SQL, and that the interesting cases occur."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.oracle_compare import connect, spark_rows, sql_rows

# the corpus operators have tests of their own
QUERIES, ORACLE = contract.QUERIES, contract.ORACLE

SPARK_TYPE = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}


@pytest.fixture(scope="module")
def con(medium):
    return connect(medium)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, medium, name):
    columns, rows, types = spark_rows(QUERIES[name](spark, medium))
    sql_columns, expected, sql_types = sql_rows(con, ORACLE[name])
    assert columns == sql_columns
    assert sum(rows.values()) > 0
    assert rows == expected
    assert {c: SPARK_TYPE[t] for c, t in sql_types.items()} == types


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_cases_occur(spark, medium):
    """Unresolved territory, missing targets and both outcomes are in the compared data."""
    rows = [r.asDict() for r in QUERIES["integrated"](spark, medium).collect()]
    assert len(rows) == 2587
    assert sum(r["sigla"] is None for r in rows) == 504
    assert sum(r["meta_ano_corrente"] is None for r in rows) == 518
    assert sum(r["atingiu_meta"] == 1 for r in rows) == 779
    targets = QUERIES["entity_target_long"](spark, medium)
    assert targets.count() == 8574
    assert targets.where("meta_taxa IS NULL").count() == 119
    assert QUERIES["region_summary"](spark, medium).count() == 147
    assert QUERIES["orphan_codes"](spark, medium).count() > 0
    assert QUERIES["alert_count"](spark, medium).first().alertas > 0
