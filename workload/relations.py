"""The driver's tables in the shapes the operators work on.

Orders joined to their customer play the raw entity table, nations the
territory, line items the micro-data.  Each relation is a plain lazy DataFrame.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_engine.functions import pad_key
from indicator_engine.names import Names
from indicator_engine.operators import entity_year_fact, integrate, keyed_targets
from indicator_engine.sources import Extract

NAMES = Names(
    entity="id_entity",
    code="codigo",
    region="sigla",
    region_name="nome",
    macro="regiao",
    rate="taxa",
    score="media",
    target_prefix="meta_",
    flag_text="flag",
    raw_score="score",
)
STUDENT = Names(entity="id", flag_text="flag", raw_score="score")

NETWORK = "3-MEDIUM"
REGION_NETWORK = "5-LOW"
BASE_YEARS = (1995, 1996)
TARGET_YEARS = tuple(range(1996, 2002))
NULL_TARGET_YEAR = 1998
GROWTH = {year: round(1 + 0.05 * (year - 1995), 2) for year in TARGET_YEARS}
TRUE_TEXTS = ("r", "a")
ABSENT_REGION = "MIDDLE EAST"

EXACT = 8

# the layered load runs on its own years and on rates of 0 to 100
YEAR_SHIFT = 28
LOAD_YEARS = tuple(range(2024, 2031))
RATE_SCALE = 5000.0


def show(df: DataFrame, *columns: str) -> DataFrame:
    """Means as both engines can state them: four digits, free of addition order."""
    exact = "CAST(round(CAST(`{0}` AS decimal(28,%d)), 4) AS double) AS `{0}`" % EXACT
    return df.selectExpr(*((exact if c in columns else "`{0}`").format(c) for c in df.columns))


# declared, so that opening a table starts no job to infer its columns
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def entity_key() -> Column:
    return F.concat(pad_key("c_nationkey", 2), pad_key("c_custkey", 5))


def fact_raw(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    if orders is None:
        orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    keyed = customer.withColumn("id_entity", entity_key())
    return orders.join(keyed, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "year(o_orderdate) AS ano",
        "id_entity",
        "o_orderpriority AS rede",
        "o_totalprice AS taxa",
        "c_acctbal AS media",
        "c_nationkey",
    )


def network_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact in the network the targets are set for."""
    return fact_raw(spark, sf_dir).where(F.col("rede") == NETWORK)


def dim_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations but those of one region, so that some entities stay unresolved."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("r_name") != ABSENT_REGION)
        .select(
            pad_key("n_nationkey", 2).alias("codigo"),
            F.col("n_name").alias("sigla"),
            F.col("n_name").alias("nome"),
            F.col("r_name").alias("regiao"),
        )
    )


def _with_nation(spark: SparkSession, sf_dir: str, fact: DataFrame) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("sigla"))
    return fact.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


def region_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = fact_raw(spark, sf_dir).where(F.col("rede") == REGION_NETWORK)
    return _with_nation(spark, sf_dir, low)


def _base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows of the base years; the range on the stored date reaches the scan."""
    first, last = min(BASE_YEARS), max(BASE_YEARS)
    day = F.col("o_orderdate")
    orders = table(spark, sf_dir, "orders").where(
        (day >= F.lit(f"{first}-01-01").cast("timestamp_ntz"))
        & (day < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz"))
    )
    return fact_raw(spark, sf_dir, orders)


def _wide(rows: DataFrame, *keys: str) -> DataFrame:
    base = rows.groupBy("ano", *keys).agg(F.avg("taxa").alias("base"), F.max("media").alias("_top"))
    targets = []
    for year, growth in GROWTH.items():
        target = f"base * {growth}D"
        if year == NULL_TARGET_YEAR:
            target = f"if(_top < 0, NULL, {target})"
        targets.append(f"{target} AS {NAMES.target_column(year)}")
    return base.selectExpr("ano", *keys, "base", *targets)


def _moved(wide: DataFrame, *keys: str) -> DataFrame:
    """Wide targets in the columns, years and scale of the layered load."""
    targets = []
    for year in LOAD_YEARS:
        own = year - YEAR_SHIFT
        value = NAMES.target_column(own) if own in GROWTH else "base"
        targets.append(f"{value} / {RATE_SCALE}D AS {Names().target_column(year)}")
    return wide.selectExpr(f"ano + {YEAR_SHIFT} AS ano", *keys, *targets)


_MEASURES = ("taxa_alfabetizacao", "media_portugues")
_LOAD_TARGETS = tuple(Names().target_column(y) for y in LOAD_YEARS)

LOAD_EXTRACTS = {
    "municipio": Extract(("ano", "id_municipio", "rede", *_MEASURES), equals=("rede", NETWORK)),
    "uf": Extract(("ano", "sigla_uf", "rede", *_MEASURES), equals=("rede", REGION_NETWORK)),
    "meta_alfabetizacao_municipio": Extract(("ano", "id_municipio", *_LOAD_TARGETS)),
    "meta_alfabetizacao_uf": Extract(("ano", "sigla_uf", *_LOAD_TARGETS)),
    "meta_alfabetizacao_brasil": Extract(("ano", *_LOAD_TARGETS)),
    "alunos": Extract(("ano", "id_municipio", "alfabetizado", "proficiencia")),
}


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The wide source of every raw entity of the layered load, in its column names."""
    fact = _with_nation(spark, sf_dir, fact_raw(spark, sf_dir)).selectExpr(
        f"ano + {YEAR_SHIFT} AS ano",
        "id_entity AS id_municipio",
        "sigla AS sigla_uf",
        "rede",
        f"taxa / {RATE_SCALE}D AS taxa_alfabetizacao",
        "media AS media_portugues",
    )
    return {
        "municipio": fact,
        "uf": fact,
        "meta_alfabetizacao_municipio": _moved(target_wide(spark, sf_dir), "id_entity AS id_municipio"),
        "meta_alfabetizacao_uf": _moved(region_target_wide(spark, sf_dir), "sigla AS sigla_uf"),
        "meta_alfabetizacao_brasil": _moved(national_target_wide(spark, sf_dir)),
        "alunos": student_raw(spark, sf_dir).selectExpr(
            f"ano + {YEAR_SHIFT} AS ano",
            "id AS id_municipio",
            "if(flag IN ('R', 'A'), 'Sim', '0') AS alfabetizado",
            "score AS proficiencia",
        ),
    }


def target_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(_base_rows(spark, sf_dir), "id_entity")


def region_target_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(_with_nation(spark, sf_dir, _base_rows(spark, sf_dir)), "sigla")


def national_target_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(_base_rows(spark, sf_dir))


def entity_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_year_fact(network_fact(spark, sf_dir), dim_territory(spark, sf_dir), NAMES)


def entity_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_targets(target_wide(spark, sf_dir), NAMES.entity, TARGET_YEARS, NAMES)


def integrated(spark: SparkSession, sf_dir: str, *, unique_inputs: bool = True) -> DataFrame:
    return integrate(
        entity_fact(spark, sf_dir), entity_targets(spark, sf_dir), NAMES, unique_inputs=unique_inputs
    )


def student_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("ano"),
        F.col("l_suppkey").cast("string").alias("id"),
        F.col("l_partkey").cast("string").alias("part_key"),
        F.col("l_extendedprice").alias("score"),
        F.col("l_returnflag").alias("flag"),
    )


def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of three years in the fields of the stream schema; time as ISO text with offset.

    Every other event lacks the second measure.
    """
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id_municipio"),
        (F.year(ts) - F.col("user_id") % 3).cast("int").alias("ano"),
        F.col("value").alias("taxa_alfabetizacao"),
        F.when(F.col("event_id") % 2 == 0, F.col("value") * 2).alias("media_portugues"),
        F.concat(F.regexp_replace(ts.cast("string"), " ", "T"), F.lit("+00:00")).alias("evento_ts"),
    )


def update_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a fact whose last year is that of the events."""
    return table(spark, sf_dir, "orders").selectExpr(
        "year(o_orderdate) + 23 AS ano",
        "CAST(o_custkey AS string) AS id_municipio",
        "o_totalprice AS taxa_alfabetizacao",
        "o_totalprice * 2 AS media_portugues",
    )


LINE_HEADER = "ano,id_municipio,taxa_alfabetizacao,media_portugues"


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of a CSV file; of seven one is short, one long, one has an open quote.

    Orders in status P write their year as ``1998.0``, which is no integer.
    """
    year = F.year("o_orderdate").cast("string")
    year = F.when(F.col("o_orderstatus") == "P", F.concat(year, F.lit(".0"))).otherwise(year)
    key, price = F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    kind = F.col("o_orderkey") % 7
    line = (
        F.when(kind == 0, F.concat_ws(",", year, key))
        .when(kind == 1, F.concat_ws(",", year, key, price, price, F.lit("x")))
        .when(kind == 2, F.concat(year, F.lit(',"'), key, F.lit(","), price, F.lit(","), price))
        .otherwise(F.concat_ws(",", year, key, price, price))
    )
    return table(spark, sf_dir, "orders").select(line.alias(LINE_HEADER))


def write_lines(lines: DataFrame, path: str) -> None:
    """Text lines below a header, as they are: no value of theirs is quoted."""
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
