"""One query per operator, over the whole driver tables."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_engine import operators as op
from indicator_engine import plans, streaming
from indicator_engine.functions import decode, flag_from_text, snake_columns, typed
from indicator_engine.names import Names
from indicator_engine.operators import quality as q
from indicator_engine.session import shared_folder
from indicator_engine.sinks import (
    REJECTED,
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
from indicator_engine.sources import Extract, extract, read_raw, state_dimension
from workload import relations as r

N = r.NAMES
INTEGRATED_MEANS = ("taxa", "media", "meta_ano_corrente", "gap_meta")
RATE_CEILING = 400_000


def entity_year_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.show(r.entity_fact(spark, sf_dir), "taxa", "media")


def region_year_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.show(op.region_year_fact(r.region_raw(spark, sf_dir), N), "taxa", "media")


def latest_target_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = op.latest_by_key(r.target_wide(spark, sf_dir), ["id_entity"])
    return r.show(latest, "base", *(N.target_column(y) for y in r.TARGET_YEARS))


def entity_target_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.show(r.entity_targets(spark, sf_dir), "meta_taxa")


def region_target_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = r.region_target_wide(spark, sf_dir)
    return r.show(op.keyed_targets(wide, "sigla", r.TARGET_YEARS, N), "meta_taxa")


def national_target_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = r.national_target_wide(spark, sf_dir)
    return r.show(op.national_targets(wide, r.TARGET_YEARS, N), "meta_taxa")


def integrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.show(r.integrated(spark, sf_dir, unique_inputs=False), *INTEGRATED_MEANS)


def latest_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.show(op.latest_indicator(r.integrated(spark, sf_dir), N), *INTEGRATED_MEANS)


def target_vs_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = op.target_vs_result(r.integrated(spark, sf_dir), N)
    return r.show(product, "taxa", "meta_ano_corrente", "gap_meta")


def evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = op.evolution(r.integrated(spark, sf_dir), N)
    return r.show(product, "taxa", "taxa_ano_anterior", "variacao")


def region_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.region_summary(r.integrated(spark, sf_dir), N, exact_scale=r.EXACT)


def sample_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = op.sample_indicator(r.student_raw(spark, sf_dir), r.STUDENT, true_texts=r.TRUE_TEXTS)
    return r.show(rolled, "proficiencia_media", "prop_alfabetizado_amostra")


def coverage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.coverage_profile(r.fact_raw(spark, sf_dir), N)


def extract_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = Extract(("ano", "id_entity", "rede", "taxa", "media"), equals=("rede", r.NETWORK))
    return extract(r.fact_raw(spark, sf_dir), spec)


def extract_prefix_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = Extract(("ano", "id", "part_key", "score", "flag"), starts_with=("part_key", "35"), sample=20000)
    return extract(r.student_raw(spark, sf_dir), spec)


def _order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text; those in status P write their year as ``1998.0``, which is no integer."""
    year = F.year("o_orderdate").cast("string")
    return r.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pedido"),
        F.when(F.col("o_orderstatus") == "P", F.concat(year, F.lit(".0"))).otherwise(year).alias("ano"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("taxa"),
        F.col("o_orderpriority").alias("prioridade"),
        F.col("o_orderstatus").alias("situacao"),
    )


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _order_text(spark, sf_dir)
    done = typed(text, {"pedido": "string", "ano": "int", "taxa": "double", "prioridade": "double"})
    return done.withColumn("flag", flag_from_text("situacao", ("f", "o")))


def cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [q.cast_rejects("ano", "int"), q.cast_rejects("taxa", "double")]
    return q.run_checks(_order_text(spark, sf_dir), "orders", checks)


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact to CSV, landed as text with provenance, read back without it."""
    text = r.fact_raw(spark, sf_dir).select(
        "ano",
        "id_entity",
        "rede",
        F.col("taxa").cast("decimal(18,2)").alias("taxa"),
        F.col("media").cast("decimal(18,2)").alias("media"),
    )
    folder = shared_folder(spark, "raw-landing")
    export_csv(text, f"{folder}/csv")
    landed = Table(path=f"{folder}/bronze")
    land_raw(spark, f"{folder}/csv", landed, origin="fact.csv")
    return read_raw(landed.read(spark))


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each table write has left behind."""
    folder = shared_folder(spark, "load-audit")
    fact = overwrite(r.entity_fact(spark, sf_dir), Table(path=f"{folder}/fato"))
    students = publish(r.student_raw(spark, sf_dir), Table(path=f"{folder}/alunos"))
    names = F.element_at(F.split("table", "/"), -1).alias("tabela")
    return audit_frame(spark, [fact, students]).select(names, F.col("rows").alias("linhas"))


def partitioned_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = integrated(spark, sf_dir)
    served = Table(path=shared_folder(spark, "publish"))
    publish(product, served)
    return served.read(spark, product.columns)


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.student_raw(spark, sf_dir).select("ano", "id", "flag").dropDuplicates()


def dup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = r.table(spark, sf_dir, "lineitem")
    return q.run_checks(lines, "lineitem", [q.duplicates(["l_orderkey", "l_linenumber"])])


def null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [q.missing("id_entity", 0.0), q.missing("sigla", 10.0), q.missing("meta_ano_corrente", 25.0)]
    return q.run_checks(r.integrated(spark, sf_dir), "integrated", checks)


def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.run_checks(r.integrated(spark, sf_dir), "integrated", [q.unresolved("sigla")])


def orphan_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = r.fact_raw(spark, sf_dir).select(F.substring("id_entity", 1, 2).alias("codigo"))
    return op.missing_from(codes, r.dim_territory(spark, sf_dir), "codigo")


def range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = r.table(spark, sf_dir, "customer")
    check = q.out_of_range("c_acctbal", 0, 10000, "saldo_fora_da_faixa", "saldo em [0,10000]")
    return q.run_checks(customers, "customer", [check])


def _with_code(rows: DataFrame) -> DataFrame:
    return rows.withColumn("codigo", F.substring("id_entity", 1, 2))


def _report(rows: DataFrame, territory: DataFrame) -> DataFrame:
    checks = [
        q.duplicates(["ano", "id_entity"]),
        q.missing("id_entity", 0.0),
        q.missing("meta_ano_corrente", 10.0),
        q.unresolved("sigla"),
        q.out_of_range("taxa", 0, RATE_CEILING, "taxa_fora_da_faixa", "taxa na faixa"),
    ]
    return q.quality_report(rows, territory, "codigo", "integrated", checks)


def _written_integrated(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The integrated table as written, so that several checks do not compute it again."""
    checked = Table(path=f"{folder}/integrated")
    overwrite(_with_code(r.integrated(spark, sf_dir)), checked)
    return checked.read(spark)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _written_integrated(spark, sf_dir, shared_folder(spark, "quality"))
    return _report(rows, r.dim_territory(spark, sf_dir))


def alert_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.alert_count(quality_report(spark, sf_dir))


def quality_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to one history; the run time is left out of the result."""
    folder = shared_folder(spark, "history")
    rows, history = _written_integrated(spark, sf_dir, folder), Table(path=f"{folder}/report")
    for _ in range(2):
        append(q.stamped(_report(rows, r.dim_territory(spark, sf_dir))), history, q.REPORT_SCHEMA)
    return history.read(spark, q.REPORT_COLUMNS)


def _landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream")
    r.event_json(spark, sf_dir).write.json(f"{folder}/in")
    return streaming.ingest(spark, f"{folder}/in", Table(path=f"{folder}/out"), f"{folder}/checkpoint")


def stream_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed_events(spark, sf_dir).select(
        "id_municipio",
        "ano",
        "taxa_alfabetizacao",
        "media_portugues",
        F.unix_micros("evento_ts").alias("evento_us"),
    )


def stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.show(streaming.summary_by_year(_landed_events(spark, sf_dir)), "taxa_media")


def csv_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes, commas and breaks through export, landing and read; null apart from empty."""
    texts = r.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit(' "'), "text", F.lit('", \n')).alias("text"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(F.col("doc_id") % 3 == 1, F.lit(" a ")).alias("mark"),
    )
    folder = shared_folder(spark, "csv-fidelity")
    export_csv(texts, f"{folder}/csv")
    landed = Table(path=f"{folder}/bronze")
    land_raw(spark, f"{folder}/csv", landed, origin="documents.csv", columns=texts.columns, multi_line=True)
    return read_raw(landed.read(spark)).select("doc_id", F.md5("text").alias("text_md5"), "mark")


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per origin, and how many lack an ingest time."""
    folder = shared_folder(spark, "provenance")
    export_csv(r.fact_raw(spark, sf_dir).select("ano", "id_entity"), f"{folder}/csv")
    landed = Table(path=f"{folder}/bronze")
    land_raw(spark, f"{folder}/csv", landed, origin="fact.csv")
    names = Names()
    return landed.read(spark).groupBy(F.col(names.origin).alias("origem")).agg(
        F.count(F.lit(1)).alias("linhas"), F.count_if(F.col(names.ingested).isNull()).alias("sem_hora")
    )


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers per state whose code is their nation's key plus 11; codes of no state keep null labels."""
    names = Names()
    suppliers = r.table(spark, sf_dir, "supplier").select((F.col("s_nationkey") + 11).cast("string").alias(names.code))
    labelled = op.lookup(suppliers, state_dimension(spark), names.code, literal=True)
    return labelled.groupBy(names.code, *names.labels).agg(F.count(F.lit(1)).alias("fornecedores"))


def extract_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 5000 lines by all columns: a limit that cuts at every size."""
    spec = Extract(("ano", "id", "part_key", "score", "flag"), sample=5000)
    return extract(r.student_raw(spark, sf_dir), spec)


def snake_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = r.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").toDF("Código Nação", "nomeDaNação", "_Região")
    return snake_columns(named)


def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events drained, nothing drained, then the rest: each event once."""
    folder = shared_folder(spark, "stream-incremental")
    events, out = r.event_json(spark, sf_dir), Table(path=f"{folder}/out")
    for even in (True, None, False):
        if even is not None:
            half = events.where((F.crc32(F.col("evento_ts").cast("string")) % 2 == 0) == even)
            half.write.mode("append").json(f"{folder}/in")
        landed = streaming.ingest(spark, f"{folder}/in", out, f"{folder}/checkpoint", files_per_batch=2)
    return landed.select("id_municipio", "ano", "taxa_alfabetizacao", F.unix_micros("evento_ts").alias("evento_us"))


def stream_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON texts of a catalog table, drained into a catalog table after each of two appends."""
    ensure_schema(spark, "stream_tables")
    source, out = (Table(f"stream_tables.{kind}_{uuid.uuid4().hex}") for kind in ("lines", "landed"))
    checkpoint = shared_folder(spark, "stream-from-table")
    lines = r.event_json(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    for even in (True, False):
        append(lines.where((F.crc32("value") % 2 == 0) == even), source, lines.schema)
        landed = streaming.drain(streaming.read_event_table(spark, source), out, checkpoint)
    return landed.select(
        "id_municipio", "ano", "taxa_alfabetizacao", "media_portugues", F.unix_micros("evento_ts").alias("evento_us")
    )


def stream_absorbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order means per customer and year, served by year, and the newest event of each absorbed in two drains.

    A batch that comes again, with other measures, must change nothing.
    """
    ensure_schema(spark, "absorbed")
    folder = shared_folder(spark, "stream-absorbed")
    served = Table(f"absorbed.served_{uuid.uuid4().hex}", f"{folder}/served")
    means = op.yearly_means(r.update_target(spark, sf_dir), "ano", ["id_municipio"], Names().measures)
    publish(means.withColumn("evento_ts", F.lit(None).cast("timestamp")), served)
    events = r.event_json(spark, sf_dir)
    minute = F.substring("evento_ts", 15, 2).cast("int")
    for half in (0, 1):  # neither half is older than the other
        events.where(minute % 2 == half).write.mode("append").json(f"{folder}/in")
        stream = streaming.stamp(streaming.read_events(spark, f"{folder}/in"))
        streaming.absorb(stream, served, f"{folder}/checkpoint").awaitTermination()
    again = streaming.stamp(events).withColumn("taxa_alfabetizacao", F.lit(-1.0))
    streaming.absorb_batch(again, 0, served)
    return r.show(served.read(spark, ["ano", "id_municipio", *Names().measures]), *Names().measures)


def stream_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with text for a number, a bad time, or no JSON at all: nulls, never a lost row."""
    folder = shared_folder(spark, "stream-malformed")
    kind = F.col("event_id") % 4
    line = (
        F.when(kind == 0, F.format_string('{"id_municipio": "%d", "ano": 2020, "taxa_alfabetizacao": "x"}', "user_id"))
        .when(kind == 1, F.format_string('{"id_municipio": "%d", "ano": 2021, "evento_ts": "yesterday"}', "user_id"))
        .when(kind == 2, F.lit("no json"))
        .otherwise(F.format_string('{"id_municipio": "%d", "ano": 2022, "media_portugues": 1.5}', "user_id"))
    )
    r.table(spark, sf_dir, "events").select(line.alias("value")).write.text(f"{folder}/in")
    landed = streaming.ingest(spark, f"{folder}/in", Table(path=f"{folder}/out"), f"{folder}/checkpoint")
    return landed.select("id_municipio", "ano", "taxa_alfabetizacao", "media_portugues", F.unix_micros("evento_ts").alias("evento_us"))


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a report says about values lost by typing, the text written as a raw table first."""
    raw = Table(path=f"{shared_folder(spark, 'load-rejects')}/orders")
    overwrite(_order_text(spark, sf_dir), raw)
    return q.load_rejects({"orders": raw.read(spark)}, {"orders": {"ano": "int", "taxa": "double", "prioridade": "double"}})


def raw_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the right width landed, the others in quarantine as they came."""
    folder = shared_folder(spark, "raw-quarantine")
    r.write_lines(r.broken_lines(spark, sf_dir), f"{folder}/csv")
    landed, quarantine = Table(path=f"{folder}/bronze"), Table(path=f"{folder}/rejected")
    land_raw(spark, f"{folder}/csv", landed, origin="orders.csv", quarantine=quarantine)
    rows = read_raw(landed.read(spark))
    rejected = quarantine.read(spark).select(F.col(REJECTED).alias("linha"))
    return rows.unionByName(rejected, allowMissingColumns=True)


def load_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the load's report says about lines of another width and values of no such type."""
    folder = shared_folder(spark, "load-losses")
    r.write_lines(r.broken_lines(spark, sf_dir), f"{folder}/raw/municipio.csv")
    lake = plans.Lakehouse(spark, root=folder, catalog=False)
    plans.land_all(lake, f"{folder}/raw", {"municipio.csv": "municipio"})
    return plans.lost_by_load(lake)


def health_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of two loads of three tables and of two runs of the checks, from their histories."""
    folder = shared_folder(spark, "health")
    audits, checks = Table(path=f"{folder}/audits"), Table(path=f"{folder}/report")
    names = ("fato", "alunos", "integrado")
    fato, alunos, integrado = (Table(path=f"{folder}/{name}") for name in names)
    for network in (r.REGION_NETWORK, r.NETWORK):
        rows = r.fact_raw(spark, sf_dir).where(F.col("rede") == network)
        done = [overwrite(rows, fato), publish(r.student_raw(spark, sf_dir), alunos)]
        done.append(overwrite(_with_code(r.integrated(spark, sf_dir)), integrado))
        record(spark, [replace(a, table=name) for a, name in zip(done, names)], audits)
        report = _report(integrado.read(spark), r.dim_territory(spark, sf_dir))
        append(q.stamped(report), checks, q.REPORT_SCHEMA)
    return op.health(audits.read(spark), checks.read(spark)).drop("quando")


def catalog_repointed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of catalog tables: a write that breaks off leaves the rows, one year is replaced alone."""
    ensure_schema(spark, "repointed")
    folder = shared_folder(spark, "repointed")
    plain, by_year = (Table(f"repointed.{k}_{uuid.uuid4().hex}", f"{folder}/{k}") for k in ("plain", "by_year"))
    fact = r.entity_fact(spark, sf_dir).select("ano", "id_entity", "taxa")
    for table, write in ((plain, overwrite), (by_year, publish)):
        write(fact.where(F.col("ano") == 1996), table)
        write(fact, table)
        try:
            write(fact.withColumn("taxa", F.raise_error(F.lit("cut off")).cast("double")), table)
        except PySparkException as error:
            if "cut off" not in str(error):
                raise
    doubled = by_year.read(spark).where(F.col("ano") == 1997).withColumn("taxa", F.col("taxa") * 2)
    publish_partitions(doubled, by_year, [1997])
    tables = [t.read(spark, fact.columns).withColumn("tabela", F.lit(k)) for t, k in ((plain, "plain"), (by_year, "by_year"))]
    return r.show(reduce(DataFrame.unionByName, tables), "taxa")


def catalog_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema, bucketed overwrite, append and read by catalog name."""
    ensure_schema(spark, "catalog_load")
    table = Table(f"catalog_load.fact_{uuid.uuid4().hex}")
    fact = r.entity_fact(spark, sf_dir).select("ano", "id_entity", "sigla")
    overwrite(fact, table, bucket_by="id_entity", buckets=4)
    overwrite(fact, table, bucket_by="id_entity", buckets=4)
    counts = table.read(spark).groupBy("ano").agg(F.count(F.lit(1)).alias("linhas"))
    history = Table(f"catalog_load.counts_{uuid.uuid4().hex}")
    for _ in range(2):
        append(counts, history, counts.schema)
    return history.read(spark)


def indicator_from_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = op.indicator_from_scores(r.student_raw(spark, sf_dir), r.STUDENT, cut=50_000)
    return r.show(share, "prop_alfabetizado_amostra")


def region_target_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = r.region_target_wide(spark, sf_dir)
    targets = op.keyed_targets(wide, "sigla", r.TARGET_YEARS, N)
    joined = op.attach_region_target(r.integrated(spark, sf_dir), targets, N)
    return r.show(joined, *INTEGRATED_MEANS, "meta_uf")


def orphan_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of the fact without a row in the base years of the targets."""
    fact = r.fact_raw(spark, sf_dir).select("id_entity")
    return op.missing_from(fact, r.target_wide(spark, sf_dir), "id_entity")


def priority_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = op.target_vs_result(r.integrated(spark, sf_dir), N)
    return r.show(op.priority_list(product, 100, N), "taxa", "meta_ano_corrente", "gap_meta")


def updates_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order means per customer, the last year overlaid by the newest event of the same number."""
    means = op.yearly_means(r.update_target(spark, sf_dir), "ano", ["id_municipio"], Names().measures)
    return r.show(op.apply_updates(means, streaming.stamp(r.event_json(spark, sf_dir))), *Names().measures)


def networks_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per label of the network code their priority starts with; code and label go together."""
    return (
        r.table(spark, sf_dir, "orders")
        .select(decode(F.substring("o_orderpriority", 1, 1)).alias("rede"))
        .groupBy("rede")
        .count()
    )


def quality_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of every check between a run over all rows and one over those with a target."""
    folder = shared_folder(spark, "trend")
    rows, history = _written_integrated(spark, sf_dir, folder), Table(path=f"{folder}/report")
    for checked in (rows, rows.where(F.col("meta_ano_corrente").isNotNull())):
        report = _report(checked, r.dim_territory(spark, sf_dir))
        append(q.stamped(report), history, q.REPORT_SCHEMA)
    return q.quality_trend(history.read(spark)).drop("executado_em")


# table of the layered load and the columns whose checksums are taken
RATES = ("taxa_alfabetizacao", "media_portugues")
LOADED = {
    "bronze": {
        "municipio": ("ano", *RATES),
        "uf": ("ano", *RATES),
        "meta_alfabetizacao_municipio": ("ano", "meta_alfabetizacao_2025"),
        "meta_alfabetizacao_uf": ("ano", "meta_alfabetizacao_2026"),
        "meta_alfabetizacao_brasil": ("ano", "meta_alfabetizacao_2030"),
        "alunos": ("ano", "proficiencia"),
    },
    "silver": {
        "dim_uf": ("codigo_uf",),
        "fato_municipio": ("ano", *RATES),
        "fato_uf": ("ano", *RATES),
        "meta_municipio_long": ("ano_meta", "meta_taxa"),
        "meta_uf_long": ("ano_meta", "meta_taxa"),
        "meta_brasil_long": ("ano_meta", "meta_taxa"),
        "municipio_ano_integrada": ("ano", *RATES, "meta_ano_corrente", "gap_meta", "atingiu_meta"),
        "indicador_alunos_municipio": ("qtd_alunos_amostra", "proficiencia_media", "prop_alfabetizado_amostra"),
    },
    "gold": {
        "indicador_por_municipio": ("ano", *RATES, "gap_meta"),
        "meta_versus_resultado": ("taxa_alfabetizacao", "meta_ano_corrente", "gap_meta", "atingiu_meta"),
        "evolucao_temporal": ("taxa_alfabetizacao", "taxa_ano_anterior", "variacao"),
        "resumo_por_uf": ("ano", "qtd_municipios"),
        "relatorio_qualidade": ("valor",),
    },
}


def layered_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six sources through extraction and all layers; rows and checksums of every table written."""
    root = shared_folder(spark, "layers")
    plans.extract_all(spark, r.load_sources(spark, sf_dir), f"{root}/raw", r.LOAD_EXTRACTS)
    lake = plans.Lakehouse(spark, root=root, catalog=False)
    plans.land_all(lake, f"{root}/raw")
    plans.load_silver(lake)
    plans.load_gold(lake)
    plans.run_quality(lake)

    def checksums(layer: str, name: str, columns: tuple[str, ...]) -> DataFrame:
        sums = (
            F.struct(
                F.lit(c).alias("coluna"),
                F.round(F.sum(F.col(c).cast("decimal(28,8)")).cast("decimal(38,8)"), 2).cast("double").alias("soma"),
            )
            for c in columns
        )
        told = lake.read(layer, name).agg(F.count(F.lit(1)).alias("linhas"), F.array(*sums).alias("somas"))
        return told.select(F.lit(f"{layer}.{name}").alias("tabela"), "linhas", F.inline("somas"))

    parts = [checksums(layer, *item) for layer, tables in LOADED.items() for item in tables.items()]
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    f.__name__: f
    for f in (
        entity_year_fact,
        region_year_fact,
        latest_target_row,
        entity_target_long,
        region_target_long,
        national_target_long,
        integrated,
        latest_indicator,
        target_vs_result,
        evolution,
        region_summary,
        sample_indicator,
        coverage_profile,
        extract_filtered,
        extract_prefix_sample,
        typed_projection,
        cast_rejects,
        raw_landing,
        load_audit,
        partitioned_publish,
        distinct_rows,
        dup_check,
        null_check,
        orphan_rows,
        orphan_codes,
        range_check,
        quality_report,
        alert_count,
        quality_history,
        stream_landed,
        stream_summary,
        csv_fidelity,
        provenance,
        state_lookup,
        extract_sample,
        snake_names,
        stream_incremental,
        stream_malformed,
        load_rejects,
        raw_quarantine,
        load_losses,
        health_view,
        stream_from_table,
        stream_absorbed,
        catalog_repointed,
        catalog_load,
        layered_load,
        indicator_from_scores,
        region_target_attached,
        orphan_entities,
        priority_list,
        updates_applied,
        networks_decoded,
        quality_trend,
    )
}
