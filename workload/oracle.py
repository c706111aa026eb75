"""The same queries as SQL for DuckDB, stated independently of the Spark code."""

from __future__ import annotations

from indicator_engine.sources.territory import STATES

_RELATIONS = {
    "fact_raw": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS ano,
               CASE WHEN c_nationkey < 10 THEN '0' ELSE '' END || CAST(c_nationkey AS VARCHAR)
                 || repeat('0', greatest(5 - length(CAST(c_custkey AS VARCHAR)), 0))
                 || CAST(c_custkey AS VARCHAR) AS id_entity,
               o_orderpriority AS rede, o_totalprice AS taxa, c_acctbal AS media, c_nationkey
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "dim_territory": """
        SELECT CASE WHEN n_nationkey < 10 THEN '0' ELSE '' END || CAST(n_nationkey AS VARCHAR) AS codigo,
               n_name AS sigla, n_name AS nome, r_name AS regiao
        FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE r_name <> 'MIDDLE EAST'""",
    "entity_fact": """
        SELECT d.codigo IS NOT NULL AS resolved, substr(f.id_entity, 1, 2) AS codigo, f.ano, f.id_entity,
               f.taxa, f.media, d.sigla, d.nome, d.regiao
        FROM (SELECT ano, id_entity, avg(taxa) AS taxa, avg(media) AS media
              FROM fact_raw WHERE rede = '3-MEDIUM' GROUP BY ano, id_entity) f
        LEFT JOIN dim_territory d ON d.codigo = substr(f.id_entity, 1, 2)""",
    "base_rows": "SELECT * FROM fact_raw WHERE ano IN (1995, 1996)",
    "target_wide": """
        SELECT ano, id_entity, avg(taxa) AS base, {wide}
        FROM base_rows GROUP BY ano, id_entity""",
    "region_target_wide": """
        SELECT ano, n_name AS sigla, avg(taxa) AS base, {wide}
        FROM base_rows JOIN nation ON c_nationkey = n_nationkey GROUP BY ano, n_name""",
    "national_target_wide": "SELECT ano, avg(taxa) AS base, {wide} FROM base_rows GROUP BY ano",
    "latest_wide": """
        SELECT t.* FROM target_wide t
        JOIN (SELECT id_entity, max(ano) AS ano FROM target_wide GROUP BY id_entity) m
          ON t.id_entity = m.id_entity AND t.ano = m.ano""",
    "latest_region_wide": """
        SELECT t.* FROM region_target_wide t
        JOIN (SELECT sigla, max(ano) AS ano FROM region_target_wide GROUP BY sigla) m
          ON t.sigla = m.sigla AND t.ano = m.ano""",
    "latest_national_wide": """
        SELECT * FROM national_target_wide WHERE ano = (SELECT max(ano) FROM national_target_wide)""",
    "entity_targets": """{long_entity}""",
    "integrated": """
        SELECT f.ano, f.id_entity, f.sigla, f.nome, f.regiao, f.taxa, f.media,
               m.meta_taxa AS meta_ano_corrente, f.taxa - m.meta_taxa AS gap_meta,
               CASE WHEN f.taxa - m.meta_taxa >= 0 THEN 1 WHEN f.taxa - m.meta_taxa < 0 THEN 0 END AS atingiu_meta
        FROM entity_fact f
        LEFT JOIN entity_targets m ON f.id_entity = m.id_entity AND f.ano = m.ano_meta""",
    "student_raw": """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(l_suppkey AS VARCHAR) AS id,
               CAST(l_partkey AS VARCHAR) AS part_key, l_extendedprice AS score, l_returnflag AS flag
        FROM lineitem""",
    "report": """{report}""",
}

_GROWTH = {1996: "1.05", 1997: "1.1", 1998: "1.15", 1999: "1.2", 2000: "1.25", 2001: "1.3"}


def _wide() -> str:
    columns = []
    for year, growth in _GROWTH.items():
        value = f"avg(taxa) * CAST('{growth}' AS DOUBLE)"
        if year == 1998:
            value = f"CASE WHEN max(media) < 0 THEN NULL ELSE {value} END"
        columns.append(f"{value} AS meta_{year}")
    return ", ".join(columns)


def _long(source: str, keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}CAST({year} AS INTEGER) AS ano_meta, meta_{year} AS meta_taxa FROM {source}"
        for year in _GROWTH
    )


def _row(test: str, table: str, metric: str, value: str, ok: str, detail: str, source: str) -> str:
    return f"""SELECT '{test}' AS teste, '{table}' AS tabela, '{metric}' AS metrica,
        CAST({value} AS DOUBLE) AS valor,
        CASE WHEN {ok} THEN 'ok' ELSE 'alerta' END AS status, '{detail}' AS detalhe FROM {source}"""


def _nulls(column: str) -> str:
    return f"100.0 * (count(*) - count({column})) / count(*)"


def _missing(column: str, ceiling: str) -> str:
    share = _nulls(column)
    return _row(
        "ausentes", "integrated", f"pct_nulo_{column}", f"round({share}, 2)",
        f"{share} <= {ceiling}", f"teto={ceiling}%", "integrated",
    )


_DUPLICATES = "count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table}))"


def _duplicates(table: str, keys: str) -> str:
    surplus = _DUPLICATES.format(keys=keys, table=table)
    return _row("duplicidade", table, "linhas_duplicadas", surplus, f"{surplus} = 0", f"chave=({keys})", table)


def _counted(test: str, table: str, metric: str, condition: str, detail: str) -> str:
    n = f"count(CASE WHEN {condition} THEN 1 END)"
    return _row(test, table, metric, n, f"{n} = 0", detail, table)


_UNRESOLVED = _counted(
    "chave_relacionamento", "integrated", "municipios_sem_uf", "sigla IS NULL",
    "sigla nao resolvida pelo codigo IBGE",
)
_UNKNOWN = """(SELECT DISTINCT substr(id_entity, 1, 2) AS codigo FROM integrated
               EXCEPT SELECT codigo FROM dim_territory)"""
_REPORT = " UNION ALL ".join(
    (
        _duplicates("integrated", "ano, id_entity"),
        _missing("id_entity", "0.0"),
        _missing("meta_ano_corrente", "10.0"),
        _UNRESOLVED,
        _counted("consistencia", "integrated", "taxa_fora_da_faixa", "taxa < 0 OR taxa > 400000", "taxa na faixa"),
        _row("chave_relacionamento", "integrated", "siglas_fora_da_dim", "count(*)", "count(*) = 0", "", _UNKNOWN),
    )
)


def _relations(*wanted: str) -> str:
    filled = {
        "wide": _wide(),
        "long_entity": _long("latest_wide", "id_entity, "),
        "report": _REPORT,
    }
    return "WITH " + ",\n".join(f"{name} AS ({_RELATIONS[name].format(**filled)})" for name in wanted)


_FACT = ("fact_raw", "dim_territory", "entity_fact")
_TARGETS = ("base_rows", "target_wide", "latest_wide", "entity_targets")
_ALL = (*_FACT, *_TARGETS, "integrated")


def _shown(column: str, alias: str | None = None) -> str:
    return f"CAST(round(CAST({column} AS DECIMAL(28,8)), 4) AS DOUBLE) AS {alias or column}"


def _columns(plain: str, *means: str) -> str:
    return ", ".join([plain, *(_shown(m) for m in means)])


_INTEGRATED_ROW = _columns(
    "ano, id_entity, sigla, nome, regiao, atingiu_meta", "taxa", "media", "meta_ano_corrente", "gap_meta"
)
_WIDE_ROW = _columns("ano", "base", *(f"meta_{y}" for y in _GROWTH))

def _loaded() -> str:
    """Rows and checksum of every table of the layered load: years moved by 28, rates divided by 5000."""
    years = {y: f"meta_{y} / 5000.0" for y in _GROWTH} | {2002: "base / 5000.0"}

    def long(source: str, keys: str) -> str:
        return " UNION ALL ".join(
            f"SELECT {keys}{y + 28} AS ano_meta, {value} AS meta_taxa FROM {source}" for y, value in years.items()
        )

    codes = ", ".join(f"'{c}'" for c in (11, 12, 13, 14, 15, 16, 17, 21, 22, 23, 24))
    raw_rows = {
        "municipio": ("fact_raw", ("ano", "taxa", "media")),
        "uf": ("fact_raw", ("ano", "taxa", "media")),
        "metas": ("target_wide", ("ano", *(f"meta_{y}" for y in _GROWTH), "base")),
        "metas_uf": ("region_target_wide", ("ano", *(f"meta_{y}" for y in _GROWTH), "base")),
        "metas_br": ("national_target_wide", ("ano", *(f"meta_{y}" for y in _GROWTH), "base")),
        "alunos": ("student_raw", ("ano", "score")),
    }
    typed = " UNION ALL ".join(
        f"SELECT '{t}' AS t, '{c}' AS c, CAST({c} AS VARCHAR) AS v FROM {source}"
        for t, (source, columns) in raw_rows.items()
        for c in columns
    )
    aluno = """(SELECT count(*) AS n, avg(score) AS score, avg(CASE WHEN flag IN ('R', 'A') THEN 1 ELSE 0 END) AS share
                FROM student_raw GROUP BY ano, id)"""
    region = """(SELECT ano + 28 AS ano, avg(taxa / 5000.0) AS taxa, avg(media) AS media
                 FROM fact_raw JOIN nation ON c_nationkey = n_nationkey WHERE rede = '5-LOW' GROUP BY ano, n_name)"""
    raw = "(SELECT ano + 28 AS ano, taxa / 5000.0 AS taxa, media FROM fact_raw WHERE rede = '{}')"
    rates = {"taxa_alfabetizacao": "taxa", "media_portugues": "media"}
    own_rates = {"ano": "ano", **rates}
    joined = {"meta_ano_corrente": "meta_taxa", "gap_meta": "gap", "atingiu_meta": "CASE WHEN gap >= 0 THEN 1 WHEN gap < 0 THEN 0 END"}
    long_row = {"ano_meta": "ano_meta", "meta_taxa": "meta_taxa"}
    states = ", ".join(f"('{code}')" for code, *_ in STATES)
    parts = {
        "bronze.municipio": (raw.format("3-MEDIUM"), own_rates),
        "bronze.uf": (raw.format("5-LOW"), own_rates),
        "bronze.meta_alfabetizacao_municipio": (
            "target_wide", {"ano": "ano + 28", "meta_alfabetizacao_2025": years[1997]},
        ),
        "bronze.meta_alfabetizacao_uf": (
            "region_target_wide", {"ano": "ano + 28", "meta_alfabetizacao_2026": years[1998]},
        ),
        "bronze.meta_alfabetizacao_brasil": (
            "national_target_wide", {"ano": "ano + 28", "meta_alfabetizacao_2030": years[2002]},
        ),
        "bronze.alunos": ("student_raw", {"ano": "ano + 28", "proficiencia": "score"}),
        "silver.dim_uf": (f"(SELECT CAST(column0 AS INTEGER) AS codigo FROM (VALUES {states}) t(column0))", {"codigo_uf": "codigo"}),
        "silver.fato_municipio": ("fato", own_rates),
        "silver.fato_uf": (region, own_rates),
        "silver.meta_municipio_long": ("metas", long_row),
        "silver.meta_uf_long": (f"({long('latest_region_wide', '')})", long_row),
        "silver.meta_brasil_long": (f"({long('latest_national_wide', '')})", long_row),
        "silver.municipio_ano_integrada": ("base", own_rates | joined),
        "silver.indicador_alunos_municipio": (
            aluno, {"qtd_alunos_amostra": "n", "proficiencia_media": "score", "prop_alfabetizado_amostra": "share"},
        ),
        "gold.indicador_por_municipio": (
            "(SELECT * FROM base QUALIFY row_number() OVER (PARTITION BY id_entity ORDER BY ano DESC) = 1)",
            own_rates | {"gap_meta": "gap"},
        ),
        "gold.meta_versus_resultado": (
            "(SELECT * FROM base WHERE gap IS NOT NULL)", {"taxa_alfabetizacao": "taxa"} | joined,
        ),
        "gold.evolucao_temporal": (
            "(SELECT taxa, lag(taxa) OVER (PARTITION BY id_entity ORDER BY ano) AS antes FROM base)",
            {"taxa_alfabetizacao": "taxa", "taxa_ano_anterior": "antes", "variacao": "taxa - antes"},
        ),
        "gold.resumo_por_uf": (
            "(SELECT ano, count(*) AS n FROM base GROUP BY ano, codigo)", {"ano": "ano", "qtd_municipios": "n"},
        ),
        "gold.relatorio_qualidade": (
            f"""(SELECT unnest([
                  count(*) - count(DISTINCT (ano, id_entity)),
                  round({_nulls("id_entity")}, 2), round({_nulls("taxa")}, 2), count(*) - count(codigo),
                  count(CASE WHEN codigo NOT IN ({codes}) THEN 1 END), count(CASE WHEN taxa < 0 OR taxa > 100 THEN 1 END)
                ]) AS valor FROM base
                UNION ALL SELECT count(CASE WHEN TRY_CAST(v AS DOUBLE) IS NULL AND v IS NOT NULL THEN 1 END)
                FROM ({typed}) GROUP BY t, c
                UNION ALL SELECT 0 FROM range(6))""",  # no line of the six exports has another width
            {"valor": "valor"},
        ),
    }
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS tabela, count(*) AS linhas, '{column}' AS coluna,
                   CAST(round(sum(CAST({value} AS DECIMAL(28,8))), 2) AS DOUBLE) AS soma FROM {source}"""
        for name, (source, columns) in parts.items()
        for column, value in columns.items()
    )
    wanted = _relations(
        "fact_raw", "base_rows", "target_wide", "latest_wide", "region_target_wide", "latest_region_wide",
        "national_target_wide", "latest_national_wide", "student_raw",
    )
    return f"""{wanted},
        fato AS (SELECT ano + 28 AS ano, id_entity, avg(taxa / 5000.0) AS taxa, avg(media) AS media,
                        CASE WHEN substr(id_entity, 1, 2) IN ({codes}) THEN substr(id_entity, 1, 2) END AS codigo
                 FROM fact_raw WHERE rede = '3-MEDIUM' GROUP BY ano, id_entity),
        metas AS ({long("latest_wide", "id_entity, ")}),
        base AS (SELECT f.*, m.meta_taxa, f.taxa - m.meta_taxa AS gap FROM fato f
                 LEFT JOIN metas m ON f.id_entity = m.id_entity AND f.ano = m.ano_meta)
        {rows}"""


_YEAR = "CAST(year(ts) - user_id % 3 AS INTEGER)"
_UPDATED = f"""
        WITH fact AS (SELECT CAST(year(o_orderdate) + 23 AS INTEGER) AS ano, CAST(o_custkey AS VARCHAR) AS id_municipio,
                             avg(o_totalprice) AS taxa, avg(o_totalprice * 2) AS media
                      FROM orders GROUP BY 1, 2),
             newest AS (SELECT CAST(user_id AS VARCHAR) AS id_municipio, {_YEAR} AS ano, arg_max(value, ts) AS taxa,
                               arg_max(struct_pack(m := CASE WHEN event_id % 2 = 0 THEN value * 2 END), ts).m AS media
                        FROM events GROUP BY 1, 2)"""

_BROKEN = """
        WITH lines AS (
          SELECT o_orderkey % 7 AS kind, CAST(year(o_orderdate) AS VARCHAR) || CASE o_orderstatus WHEN 'P' THEN '.0' ELSE '' END AS ano,
                 CAST(o_custkey AS VARCHAR) AS id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS v, o_orderstatus
          FROM orders)"""

ORACLE = {
    "entity_year_fact": f"""{_relations(*_FACT)}
        SELECT {_columns("codigo, ano, id_entity, sigla, nome, regiao", "taxa", "media")} FROM entity_fact""",
    "region_year_fact": f"""{_relations("fact_raw")}
        SELECT ano, n_name AS sigla, {_shown("avg(taxa)", "taxa")}, {_shown("avg(media)", "media")}
        FROM fact_raw JOIN nation ON c_nationkey = n_nationkey
        WHERE rede = '5-LOW' GROUP BY ano, n_name""",
    "latest_target_row": f"""{_relations("fact_raw", "base_rows", "target_wide", "latest_wide")}
        SELECT id_entity, {_WIDE_ROW} FROM latest_wide""",
    "entity_target_long": f"""{_relations("fact_raw", *_TARGETS)}
        SELECT {_columns("id_entity, ano_meta", "meta_taxa")} FROM entity_targets""",
    "region_target_long": f"""{_relations("fact_raw", "base_rows", "region_target_wide", "latest_region_wide")}
        SELECT {_columns("sigla, ano_meta", "meta_taxa")} FROM ({_long("latest_region_wide", "sigla, ")})""",
    "national_target_long": f"""{_relations("fact_raw", "base_rows", "national_target_wide", "latest_national_wide")}
        SELECT {_columns("ano_meta", "meta_taxa")} FROM ({_long("latest_national_wide", "")})""",
    "integrated": f"{_relations(*_ALL)} SELECT DISTINCT {_INTEGRATED_ROW} FROM integrated",
    "latest_indicator": f"""{_relations(*_ALL)}
        SELECT {_INTEGRATED_ROW} FROM integrated i
        WHERE ano = (SELECT max(ano) FROM integrated x WHERE x.id_entity = i.id_entity)""",
    "target_vs_result": f"""{_relations(*_ALL)}
        SELECT {_columns("ano, id_entity, sigla, regiao, atingiu_meta", "taxa", "meta_ano_corrente", "gap_meta")}
        FROM integrated WHERE meta_ano_corrente IS NOT NULL""",
    "evolution": f"""{_relations(*_ALL)}
        SELECT {_columns("ano, id_entity, sigla", "taxa")}, {_shown("prev", "taxa_ano_anterior")},
               {_shown("taxa - prev", "variacao")}
        FROM (SELECT *, lag(taxa) OVER (PARTITION BY id_entity ORDER BY ano) AS prev FROM integrated)""",
    "region_summary": f"""{_relations(*_ALL)}
        SELECT ano, sigla, regiao, count(*) AS qtd_municipios,
               CAST(round(CAST(avg(taxa) AS DECIMAL(28,8)), 2) AS DOUBLE) AS taxa_media,
               CAST(round(CAST(avg(atingiu_meta) AS DECIMAL(28,8)), 3) AS DOUBLE) AS prop_municipios_na_meta
        FROM integrated GROUP BY ano, sigla, regiao""",
    "sample_indicator": f"""{_relations("student_raw")}
        SELECT ano, id, count(*) AS qtd_alunos_amostra, {_shown("avg(score)", "proficiencia_media")},
               {_shown("avg(CASE WHEN flag IN ('R', 'A') THEN 1 ELSE 0 END)", "prop_alfabetizado_amostra")}
        FROM student_raw GROUP BY ano, id""",
    "coverage_profile": f"""{_relations("fact_raw")}
        SELECT rede, ano, count(*) AS "count" FROM fact_raw GROUP BY rede, ano""",
    "extract_filtered": f"""{_relations("fact_raw")}
        SELECT ano, id_entity, rede, taxa, media FROM fact_raw WHERE rede = '3-MEDIUM'""",
    "extract_prefix_sample": f"""{_relations("student_raw")}
        SELECT ano, id, part_key, score, flag FROM student_raw WHERE part_key LIKE '35%'
        ORDER BY ano, id, part_key, score, flag LIMIT 20000""",
    "typed_projection": """
        SELECT CAST(o_orderkey AS VARCHAR) AS pedido,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS ano,
               o_totalprice AS taxa, CAST(NULL AS DOUBLE) AS prioridade, o_orderstatus AS situacao,
               CAST(CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 ELSE 0 END AS INTEGER) AS flag
        FROM orders""",
    "cast_rejects": _counted("tipagem", "orders", "rejeitados_ano", "o_orderstatus = 'P'", "tipo=int")
    + " UNION ALL "
    + _counted("tipagem", "orders", "rejeitados_taxa", "FALSE", "tipo=double"),
    "raw_landing": f"""{_relations("fact_raw")}
        SELECT CAST(ano AS VARCHAR) AS ano, id_entity, rede,
               CAST(CAST(taxa AS DECIMAL(18,2)) AS VARCHAR) AS taxa,
               CAST(CAST(media AS DECIMAL(18,2)) AS VARCHAR) AS media
        FROM fact_raw""",
    "load_audit": f"""{_relations("fact_raw")}
        SELECT 'fato' AS tabela, count(*) AS linhas
        FROM (SELECT DISTINCT ano, id_entity FROM fact_raw WHERE rede = '3-MEDIUM')
        UNION ALL SELECT 'alunos', count(*) FROM lineitem""",
    "partitioned_publish": f"{_relations(*_ALL)} SELECT DISTINCT {_INTEGRATED_ROW} FROM integrated",
    "distinct_rows": f"{_relations('student_raw')} SELECT DISTINCT ano, id, flag FROM student_raw",
    "dup_check": _duplicates("lineitem", "l_orderkey, l_linenumber"),
    "null_check": f"""{_relations(*_ALL)}
        {_missing("id_entity", "0.0")} UNION ALL {_missing("sigla", "10.0")}
        UNION ALL {_missing("meta_ano_corrente", "25.0")}""",
    "orphan_rows": f"{_relations(*_ALL)} {_UNRESOLVED}",
    "orphan_codes": f"""{_relations("fact_raw", "dim_territory")}
        SELECT DISTINCT substr(id_entity, 1, 2) AS codigo FROM fact_raw
        WHERE substr(id_entity, 1, 2) NOT IN (SELECT codigo FROM dim_territory)""",
    "range_check": _counted(
        "consistencia", "customer", "saldo_fora_da_faixa", "c_acctbal < 0 OR c_acctbal > 10000",
        "saldo em [0,10000]",
    ),
    "quality_report": f"{_relations(*_ALL, 'report')} SELECT * FROM report",
    "alert_count": f"""{_relations(*_ALL, "report")}
        SELECT count(*) AS alertas FROM report WHERE status = 'alerta'""",
    "quality_history": f"""{_relations(*_ALL, "report")}
        SELECT * FROM report UNION ALL SELECT * FROM report""",
    "stream_landed": """
        SELECT CAST(user_id AS VARCHAR) AS id_municipio, CAST(year(ts) - user_id % 3 AS INTEGER) AS ano,
               value AS taxa_alfabetizacao, CASE WHEN event_id % 2 = 0 THEN value * 2 END AS media_portugues, epoch_us(ts) AS evento_us
        FROM events""",
    "stream_from_table": """
        SELECT CAST(user_id AS VARCHAR) AS id_municipio, CAST(year(ts) - user_id % 3 AS INTEGER) AS ano,
               value AS taxa_alfabetizacao, CASE WHEN event_id % 2 = 0 THEN value * 2 END AS media_portugues, epoch_us(ts) AS evento_us
        FROM events""",
    "stream_summary": f"""
        SELECT CAST(year(ts) - user_id % 3 AS INTEGER) AS ano, count(*) AS eventos, {_shown("avg(value)", "taxa_media")}
        FROM events GROUP BY 1""",
    "csv_fidelity": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(' "' || text || '", ' || chr(10)) AS text_md5,
               CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN ' a ' END AS mark
        FROM documents""",
    "provenance": "SELECT 'fact.csv' AS origem, count(*) AS linhas, 0::BIGINT AS sem_hora FROM orders",
    "state_lookup": f"""
        WITH estados(codigo_uf, sigla_uf, nome_uf, regiao) AS (VALUES {", ".join(map(str, STATES))})
        SELECT CAST(s_nationkey + 11 AS VARCHAR) AS codigo_uf, sigla_uf, nome_uf, regiao, count(*) AS fornecedores
        FROM supplier LEFT JOIN estados ON codigo_uf = CAST(s_nationkey + 11 AS VARCHAR) GROUP BY ALL""",
    "extract_sample": f"""{_relations("student_raw")}
        SELECT ano, id, part_key, score, flag FROM student_raw ORDER BY ano, id, part_key, score, flag LIMIT 5000""",
    "snake_names": """
        SELECT n_nationkey AS codigo_nacao, n_name AS nome_da_nacao, n_regionkey AS _regiao
        FROM nation""",
    "stream_incremental": """
        SELECT CAST(user_id AS VARCHAR) AS id_municipio, CAST(year(ts) - user_id % 3 AS INTEGER) AS ano,
               value AS taxa_alfabetizacao, epoch_us(ts) AS evento_us
        FROM events""",
    "stream_malformed": """
        SELECT CASE WHEN event_id % 4 <> 2 THEN CAST(user_id AS VARCHAR) END AS id_municipio,
               CAST(CASE event_id % 4 WHEN 0 THEN 2020 WHEN 1 THEN 2021 WHEN 3 THEN 2022 END AS INTEGER) AS ano,
               CAST(NULL AS DOUBLE) AS taxa_alfabetizacao,
               CAST(CASE WHEN event_id % 4 = 3 THEN 1.5 END AS DOUBLE) AS media_portugues,
               CAST(NULL AS BIGINT) AS evento_us
        FROM events""",
    "load_rejects": " UNION ALL ".join(
        _counted("tipagem", "orders", f"rejeitados_{column}", lost, f"tipo={kind}")
        for column, lost, kind in (
            ("ano", "o_orderstatus = 'P'", "int"),
            ("taxa", "FALSE", "double"),
            ("prioridade", "TRUE", "double"),
        )
    ),
    "raw_quarantine": f"""{_BROKEN}
        SELECT CASE WHEN kind > 2 THEN ano END AS ano, CASE WHEN kind > 2 THEN id END AS id_municipio,
               CASE WHEN kind > 2 THEN v END AS taxa_alfabetizacao, CASE WHEN kind > 2 THEN v END AS media_portugues,
               CASE kind WHEN 0 THEN concat_ws(',', ano, id) WHEN 1 THEN concat_ws(',', ano, id, v, v, 'x')
                         WHEN 2 THEN ano || ',"' || concat_ws(',', id, v, v) END AS linha
        FROM lines""",
    "load_losses": f"""{_BROKEN}, good AS (SELECT * FROM lines WHERE kind > 2), bad AS (SELECT * FROM lines WHERE kind <= 2)
        """
    + " UNION ALL ".join(
        _row("tipagem", "municipio", f"rejeitados_{column}", n, f"{n} = 0", f"tipo={kind}", "good")
        for column, n, kind in (
            ("ano", "count(CASE WHEN o_orderstatus = 'P' THEN 1 END)", "int"),
            ("taxa_alfabetizacao", "count(CASE WHEN try_cast(v AS DOUBLE) IS NULL THEN 1 END)", "double"),
            ("media_portugues", "count(CASE WHEN try_cast(v AS DOUBLE) IS NULL THEN 1 END)", "double"),
        )
    )
    + " UNION ALL "
    + _row("carga", "municipio", "linhas_rejeitadas", "count(*)", "count(*) = 0", "largura diferente do cabecalho", "bad"),
    "health_view": f"""{_relations(*_ALL, "report")}
        SELECT 'carga' AS sinal, 'fato' AS alvo, CAST(count(*) AS DOUBLE) AS valor, 'ok' AS status
        FROM fact_raw WHERE rede = '3-MEDIUM'
        UNION ALL SELECT 'carga', 'alunos', CAST(count(*) AS DOUBLE), 'ok' FROM lineitem
        UNION ALL SELECT 'carga', 'integrado', CAST(count(*) AS DOUBLE), 'ok' FROM integrated
        UNION ALL SELECT 'qualidade', tabela || '.' || metrica, valor, status FROM report""",
    "catalog_repointed": f"""{_relations(*_FACT)}
        SELECT ano, id_entity, {_shown("taxa")}, 'plain' AS tabela FROM entity_fact
        UNION ALL
        SELECT ano, id_entity, {_shown("CASE ano WHEN 1997 THEN 2 * taxa ELSE taxa END", "taxa")}, 'by_year' FROM entity_fact""",
    "catalog_load": f"""{_relations("fact_raw")},
        counts AS (SELECT ano, count(DISTINCT id_entity) AS linhas FROM fact_raw WHERE rede = '3-MEDIUM' GROUP BY ano)
        SELECT * FROM counts UNION ALL SELECT * FROM counts""",
    "layered_load": _loaded(),
    "indicator_from_scores": f"""{_relations("student_raw")}
        SELECT ano, id, {_shown("avg(CASE WHEN score >= 50000 THEN 1 ELSE 0 END)", "prop_alfabetizado_amostra")}
        FROM student_raw GROUP BY ano, id""",
    "region_target_attached": f"""{_relations(*_ALL, "region_target_wide", "latest_region_wide")},
        uf AS ({_long("latest_region_wide", "sigla, ")})
        SELECT ano, id_entity, i.sigla, nome, regiao, atingiu_meta, {_shown("taxa")}, {_shown("media")},
               {_shown("meta_ano_corrente")}, {_shown("gap_meta")}, {_shown("meta_taxa", "meta_uf")}
        FROM integrated i LEFT JOIN uf ON uf.sigla = i.sigla AND uf.ano_meta = i.ano""",
    "orphan_entities": f"""{_relations("fact_raw", "base_rows")}
        SELECT id_entity FROM fact_raw EXCEPT SELECT id_entity FROM base_rows""",
    "priority_list": f"""{_relations(*_ALL)}
        SELECT {_columns("ano, id_entity, sigla, regiao, atingiu_meta", "taxa", "meta_ano_corrente", "gap_meta")}
        FROM (SELECT * FROM integrated WHERE gap_meta IS NOT NULL ORDER BY gap_meta, ano, id_entity LIMIT 100)""",
    "updates_applied": f"""{_UPDATED}
        SELECT f.ano, f.id_municipio, {_shown("coalesce(n.taxa, f.taxa)", "taxa_alfabetizacao")},
               {_shown("coalesce(n.media, f.media)", "media_portugues")}
        FROM fact f LEFT JOIN newest n ON n.id_municipio = f.id_municipio AND n.ano = f.ano""",
    "stream_absorbed": f"""{_UPDATED},
        -- a measure that the newest event lacks keeps what the event before it set, if that came in an earlier drain
        halves AS (SELECT CAST(user_id AS VARCHAR) AS id_municipio, {_YEAR} AS ano, ts, value,
                          CASE WHEN event_id % 2 = 0 THEN value * 2 END AS media, minute(ts) % 2 + 1 AS drained
                   FROM events),
        latest AS (SELECT id_municipio, ano, drained, max(ts) AS ts, arg_max(value, ts) AS taxa,
                          arg_max(struct_pack(m := media), ts).m AS media
                   FROM halves GROUP BY ALL),
        merged AS (SELECT coalesce(a.id_municipio, b.id_municipio) AS id_municipio, coalesce(a.ano, b.ano) AS ano,
                          CASE WHEN b.ts >= a.ts OR a.ts IS NULL THEN b.taxa ELSE a.taxa END AS taxa,
                          CASE WHEN b.ts >= a.ts OR a.ts IS NULL THEN coalesce(b.media, a.media) ELSE a.media END AS media
                   FROM (SELECT * FROM latest WHERE drained = 1) a
                   FULL JOIN (SELECT * FROM latest WHERE drained = 2) b USING (id_municipio, ano))
        SELECT coalesce(f.ano, n.ano) AS ano, coalesce(f.id_municipio, n.id_municipio) AS id_municipio,
               {_shown("coalesce(n.taxa, f.taxa)", "taxa_alfabetizacao")},
               {_shown("coalesce(n.media, f.media)", "media_portugues")}
        FROM fact f FULL JOIN merged n ON n.id_municipio = f.id_municipio AND n.ano = f.ano""",
    "networks_decoded": """
        SELECT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Federal' WHEN '2' THEN 'Estadual'
                    WHEN '3' THEN 'Municipal' WHEN '4' THEN 'Privada'
                    WHEN '5' THEN 'Pública (Estadual e Municipal)' END AS rede, count(*) AS "count"
        FROM orders GROUP BY 1""",
    "quality_trend": f"""{_relations(*_ALL, "report")},
        narrowed AS ({_REPORT.replace("FROM integrated", "FROM (SELECT * FROM integrated WHERE meta_ano_corrente IS NOT NULL)")})
        SELECT tabela, metrica, status, valor, CAST(NULL AS DOUBLE) AS variacao FROM report
        UNION ALL
        SELECT n.tabela, n.metrica, n.status, n.valor, n.valor - r.valor
        FROM narrowed n JOIN report r ON r.metrica = n.metrica""",
}
