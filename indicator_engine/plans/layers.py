"""The layered load: raw text, typed and integrated tables, served products, report.

Each step reads what the step before has written, so a lost executor or driver
costs one step and nothing is computed twice.  The tables of one step do not
depend on each other and are written side by side, so that the tail of one
write leaves no executors idle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from indicator_engine.names import Names
from indicator_engine.operators import (
    entity_year_fact,
    evolution,
    health,
    integrate,
    keyed_targets,
    latest_indicator,
    national_targets,
    region_summary,
    region_year_fact,
    sample_indicator,
    target_vs_result,
)
from indicator_engine.operators import quality
from indicator_engine.sinks import (
    LoadAudit,
    Table,
    append,
    ensure_schema,
    export_csv,
    land_raw,
    overwrite,
    publish,
    record,
)
from indicator_engine.sources import EXTRACTS, RAW_ENTITIES, Extract, extract, read_raw, state_dimension
from indicator_engine.sources.extract import TARGET_YEARS

INTEGRATED = "municipio_ano_integrada"

# table of the lines of a raw table's files that had another width than their header
QUARANTINE = "{}_rejeitados"
AUDITS = "historico_cargas"

PRODUCTS = {
    "indicador_por_municipio": latest_indicator,
    "meta_versus_resultado": target_vs_result,
    "evolucao_temporal": evolution,
    "resumo_por_uf": region_summary,
}


@dataclass(frozen=True)
class Lakehouse:
    """Where the layers live.

    ``root`` puts the files of every table below a folder the cluster shares;
    without it the catalog decides.  ``catalog=False`` leaves the catalog alone
    and keeps tables as folders under ``root``.  ``buckets`` lays the entity
    tables out by entity, so that the integration, the latest row and the
    evolution need no further shuffle.
    """

    spark: SparkSession
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    root: str | None = None
    catalog: bool = True
    buckets: int | None = None
    names: Names = Names()
    target_years: Sequence[int] = TARGET_YEARS

    def table(self, schema: str, name: str) -> Table:
        path = f"{self.root.rstrip('/')}/{schema}/{name}" if self.root else None
        return Table(f"{schema}.{name}" if self.catalog else None, path)

    def prepare(self, schema: str) -> None:
        if self.catalog:
            ensure_schema(self.spark, schema)

    def read(self, schema: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        return self.table(schema, name).read(self.spark, columns)

    def raw(self, name: str) -> DataFrame:
        return read_raw(self.read(self.bronze, name), self.names)

    def quarantine(self, name: str) -> Table:
        return self.table(self.bronze, QUARANTINE.format(name))

    def raw_types(self) -> dict[str, dict[str, str]]:
        """What the typed layer makes of the text of each raw table."""
        n = self.names
        measures = {n.year: "int"} | {m: "double" for m in n.measures}
        targets = {n.year: "int"} | {n.target_column(y): "double" for y in self.target_years}
        return {
            "municipio": measures,
            "uf": measures,
            "meta_alfabetizacao_municipio": targets,
            "meta_alfabetizacao_uf": targets,
            "meta_alfabetizacao_brasil": targets,
            "alunos": {n.year: "int", n.raw_score: "double"},
        }


Item = TypeVar("Item")
Done = TypeVar("Done")


def side_by_side(
    spark: SparkSession, write: Callable[[Item], Done], items: Iterable[Item]
) -> list[Done]:
    """Run independent writes at the same time; the first failure is raised."""
    items = list(items)
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(write), items))


def extract_all(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    folder: str,
    specs: Mapping[str, Extract] = EXTRACTS,
    entities: Mapping[str, str] = RAW_ENTITIES,
) -> None:
    """What each raw entity takes from its wide source, exported as CSV."""
    rows = {file: extract(sources[name], specs[name]) for file, name in entities.items()}
    side_by_side(
        spark, lambda item: export_csv(item[1], f"{folder.rstrip('/')}/{item[0]}"), rows.items()
    )


def land_all(
    lake: Lakehouse,
    folder: str,
    entities: Mapping[str, str] = RAW_ENTITIES,
    columns: Mapping[str, Sequence[str]] | None = None,
) -> list[LoadAudit]:
    """One raw table per CSV entity, and one of the lines that had another width.

    All files of an entity must have the same header: that of ``columns`` where it
    names the entity, else that of the first file.
    """
    lake.prepare(lake.bronze)

    def land(item: tuple[str, str]) -> LoadAudit:
        file, name = item
        path = f"{folder.rstrip('/')}/{file}"
        declared = list(columns[name]) if columns and name in columns else None
        table = lake.table(lake.bronze, name)
        return land_raw(
            lake.spark,
            path,
            table,
            origin=file,
            columns=declared,
            names=lake.names,
            quarantine=lake.quarantine(name),
        )

    return side_by_side(lake.spark, land, entities.items())


def load_silver(lake: Lakehouse) -> list[LoadAudit]:
    lake.prepare(lake.silver)
    n, years = lake.names, lake.target_years
    by_entity = {"fato_municipio", "meta_municipio_long", INTEGRATED}

    def save(item: tuple[str, DataFrame]) -> LoadAudit:
        name, df = item
        buckets = lake.buckets if name in by_entity else None
        return overwrite(df, lake.table(lake.silver, name), bucket_by=n.entity, buckets=buckets)

    states = state_dimension(lake.spark, n)
    conformed = {
        "dim_uf": states,
        "fato_municipio": entity_year_fact(lake.raw("municipio"), states, n, literal_territory=True),
        "fato_uf": region_year_fact(lake.raw("uf"), n),
        "meta_municipio_long": keyed_targets(lake.raw("meta_alfabetizacao_municipio"), n.entity, years, n),
        "meta_uf_long": keyed_targets(lake.raw("meta_alfabetizacao_uf"), n.region, years, n),
        "meta_brasil_long": national_targets(lake.raw("meta_alfabetizacao_brasil"), years, n),
        "indicador_alunos_municipio": sample_indicator(lake.raw("alunos"), n),
    }
    audits = side_by_side(lake.spark, save, conformed.items())
    # from the written tables: the fact and the targets are not computed again
    fact = lake.read(lake.silver, "fato_municipio")
    targets = lake.read(lake.silver, "meta_municipio_long")
    return [*audits, save((INTEGRATED, integrate(fact, targets, n, unique_inputs=True, by_entity=bool(lake.buckets))))]


def load_gold(lake: Lakehouse) -> list[LoadAudit]:
    """The products, each partitioned by year."""
    lake.prepare(lake.gold)
    base = lake.read(lake.silver, INTEGRATED)
    products = {name: product(base, lake.names) for name, product in PRODUCTS.items()}
    return side_by_side(
        lake.spark,
        lambda item: publish(item[1], lake.table(lake.gold, item[0]), lake.names.year),
        products.items(),
    )


def lost_by_load(lake: Lakehouse) -> DataFrame:
    """Report rows of what the load could not take: values of no such type, lines of another width.

    Raw tables that are not there, and columns they lack, have no row.
    """
    types = {}
    lines = []
    for name, kinds in lake.raw_types().items():
        if lake.table(lake.bronze, name).exists(lake.spark):
            there = set(lake.raw(name).columns)
            types[name] = {column: kind for column, kind in kinds.items() if column in there}
        if lake.quarantine(name).exists(lake.spark):
            lines.append(quality.rejected_lines(lake.quarantine(name).read(lake.spark), name))
    values = [quality.load_rejects({t: lake.raw(t) for t in types}, types)] if types else []
    nothing = lake.spark.createDataFrame([], T.StructType(quality.REPORT_SCHEMA.fields[:-1]))
    return reduce(DataFrame.unionByName, [*values, *lines], nothing)


def run_quality(lake: Lakehouse) -> LoadAudit:
    """Check the integrated table and what the load lost; append the report to its history."""
    lake.prepare(lake.gold)
    n = lake.names
    report = quality.quality_report(
        lake.read(lake.silver, INTEGRATED),
        lake.read(lake.silver, "dim_uf"),
        n.region,
        INTEGRATED,
        [
            quality.duplicates([n.year, n.entity]),
            quality.missing(n.entity, 0.0),
            quality.missing(n.rate, 10.0),
            quality.unresolved(n.region),
            quality.out_of_range(n.rate, 0, 100),
        ],
    )
    history = lake.table(lake.gold, "relatorio_qualidade")
    return append(quality.stamped(report.unionByName(lost_by_load(lake))), history, quality.REPORT_SCHEMA)


def record_loads(lake: Lakehouse, audits: Sequence[LoadAudit]) -> LoadAudit:
    """Append what a load's writes have counted to its history."""
    lake.prepare(lake.gold)
    return record(lake.spark, audits, lake.table(lake.gold, AUDITS))


def load_health(lake: Lakehouse) -> DataFrame:
    """The last load of every table and the last value of every check, from the two histories."""
    return health(lake.read(lake.gold, AUDITS), lake.read(lake.gold, "relatorio_qualidade"))
