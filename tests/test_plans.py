"""What reaches the scan, what is shuffled, what a hot key costs — read from the plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from indicator_engine import operators as op
from indicator_engine.names import Names
from indicator_engine.operators import quality as q
from indicator_engine.sinks import Table, ensure_schema, overwrite, publish
from indicator_engine.sources import Extract, extract, state_dimension
from workload import relations as r

N = Names()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|Single)", plan(df)))


def scanned(text):
    """Columns of the first file scan."""
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", text).group(1)))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def integrated_table(spark, small):
    ensure_schema(spark, "plan_silver")
    table = Table("plan_silver.integrated")
    overwrite(r.integrated(spark, small), table, bucket_by="id_entity", buckets=4)
    return table.read(spark)


def test_filter_and_columns_reach_the_scan(spark, small):
    orders = r.table(spark, small, "orders")
    spec = Extract(("o_orderkey", "o_orderpriority"), equals=("o_orderpriority", "5-LOW"))
    text = plan(extract(orders, spec))
    assert "EqualTo(o_orderpriority,5-LOW)" in text
    assert scanned(text) == {"o_orderkey", "o_orderpriority"}
    prefix = Extract(("o_orderkey", "o_orderpriority"), starts_with=("o_orderpriority", "5"))
    assert "StringStartsWith(o_orderpriority,5)" in plan(extract(orders, prefix))


def test_one_shuffle_for_the_fact_and_a_broadcast_of_the_literal_states(spark, no_broadcast):
    raw = spark.range(10).selectExpr(
        "'2023' ano", "CAST(id AS string) id_municipio", "'1' taxa_alfabetizacao", "'1' media_portugues"
    )
    fact = op.entity_year_fact(raw, state_dimension(spark), literal_territory=True)
    text = plan(fact)
    assert exchanges(fact) == 1
    assert "BroadcastHashJoin" in text and "partial_avg" in text


def test_a_table_dimension_is_not_forced_to_broadcast(spark, small, no_broadcast):
    text = plan(r.entity_fact(spark, small))
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark, small):
    wide = r.table(spark, small, "orders").selectExpr("o_custkey k", "year(o_orderdate) ano", "o_orderkey v")
    text = plan(op.latest_by_key(wide, ["k"]))
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert re.search(r"WindowGroupLimit .*Partial", before_shuffle)


def test_national_target_is_a_bounded_top_row(spark):
    wide = spark.range(10).selectExpr("CAST(id AS string) ano", "CAST(id AS string) meta_alfabetizacao_2024")
    assert "TakeOrderedAndProject(limit=1" in plan(op.national_targets(wide, [2024]))


def test_bucketed_layers_need_no_shuffle(spark, small, no_broadcast, integrated_table):
    fact, targets = Table("plan_silver.fact"), Table("plan_silver.targets")
    overwrite(r.entity_fact(spark, small), fact, bucket_by="id_entity", buckets=4)
    overwrite(r.entity_targets(spark, small), targets, bucket_by="id_entity", buckets=4)
    joined = op.integrate(fact.read(spark), targets.read(spark), r.NAMES, unique_inputs=True, by_entity=True)
    assert exchanges(joined) == 0 and "SortMergeJoin" in plan(joined)
    assert exchanges(op.integrate(fact.read(spark), targets.read(spark), r.NAMES, by_entity=True)) == 0
    plain = op.integrate(fact.read(spark), targets.read(spark), r.NAMES, unique_inputs=True)
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))
    assert exchanges(op.latest_indicator(integrated_table, r.NAMES)) == 0
    assert exchanges(op.evolution(integrated_table, r.NAMES)) == 0


def test_products_shuffle_once_and_prune(spark, integrated_table):
    assert exchanges(op.target_vs_result(integrated_table, r.NAMES)) == 0
    assert exchanges(op.region_summary(integrated_table, r.NAMES)) == 1
    assert scanned(plan(op.region_summary(integrated_table, r.NAMES))) == {
        "ano", "sigla", "regiao", "taxa", "atingiu_meta",
    }
    assert "IsNotNull(meta_ano_corrente)" in plan(op.target_vs_result(integrated_table, r.NAMES))


def test_row_checks_share_one_scan(spark, integrated_table):
    checks = [q.duplicates(["ano", "id_entity"]), q.missing("taxa", 1.0), q.unresolved("sigla")]
    report = q.run_checks(integrated_table, "t", checks)
    text = plan(report)
    assert text.count("FileScan") == 1
    assert "Expand" not in text
    # laid out by entity: only the counts themselves travel
    assert exchanges(report) == 1 and "Exchange SinglePartition" in text


def test_a_hot_territory_is_split_where_the_dimension_is_too_large_to_broadcast(spark, no_broadcast):
    rows = spark.range(0, 60_000, 1, 6).selectExpr("IF(id % 3 = 0, id % 50, 7) AS code", "id")
    zones = spark.range(0, 50).selectExpr("id AS code", "CAST(id AS string) AS label")
    tight = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in tight}
    for key, value in tight.items():
        spark.conf.set(key, value)
    try:
        joined = op.lookup(rows, zones, "code")
        assert len(joined.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_published_year_is_pruned_and_columns_keep_their_order(spark, tmp_path, integrated_table):
    product = op.target_vs_result(integrated_table, r.NAMES)
    table = Table(path=str(tmp_path / "gold"))
    audit = publish(product, table)
    served = table.read(spark, product.columns)
    assert served.columns == product.columns
    assert audit.rows == served.count() == product.count()
    one_year = served.where(F.col("ano") == 1997)
    assert re.search(r"PartitionFilters: \[.*ano#\d+ = 1997", plan(one_year))
    assert one_year.count() == product.where("ano = 1997").count() > 0
    files = list((tmp_path / "gold").glob("ano=*/*.parquet"))
    assert len(files) == product.select("ano").distinct().count()


def test_a_year_that_holds_most_rows_is_split(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 200_000, 1, 8).selectExpr("IF(id % 10 < 8, 2024, 2023) ano", "id", "uuid() x")
        publish(rows, Table(path=str(tmp_path / "hot")))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "hot" / "ano=2024").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_000


def test_region_targets_are_joined_on_region_and_year(spark, small, no_broadcast):
    """A region with most rows is dealt by year too, so no task gets all of it."""
    targets = op.keyed_targets(r.region_target_wide(spark, small), "sigla", r.TARGET_YEARS, r.NAMES)
    text = plan(op.attach_region_target(r.integrated(spark, small), targets, r.NAMES))
    assert "hashpartitioning(sigla" in text
    assert all(", ano" in part.split(")")[0] for part in text.split("hashpartitioning(sigla")[1:3])


def test_a_sample_is_cut_on_two_levels(spark, no_broadcast):
    rows = op.sampling.ordered_sample(spark.range(100).selectExpr("id", "id % 7 AS v"), 5, ["v", "id"])
    assert plan(rows).count("WindowGroupLimit") >= 2
    assert [tuple(x) for x in rows.collect()] == sorted((x, x % 7) for x in range(0, 35, 7))
