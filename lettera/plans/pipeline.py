"""The whole run: bronze to silver to gold, and the refresh after new goals.

Every table is written before it is read by the next step.  That cuts the lineage at table
borders, and lets a run that lost executors go on from files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lettera.model import (
    COUNTRY,
    MUNICIPALITY,
    REQUIRED_GOALS,
    REQUIRED_MUNICIPALITY,
    REQUIRED_PUPILS,
    REQUIRED_STATE,
    SCOPE_COUNTRY,
    STATE,
    IndicatorModel,
    Level,
)
from lettera.operators import quality
from lettera.operators.quality import require_columns
from lettera.operators.rollup import additive_parts
from lettera.plans import gold, silver
from lettera.sources.readers import scan, snapshot
from lettera.sources.writers import register_tables, replace_partitions, write_partitioned
from lettera.streaming.goal_events import (
    read_received,
    streamed_goals,
    with_streamed_goals,
)

# Gold tables known to the catalog; the feature table is left to its own readers.
CATALOG_TABLES = tuple(
    f"{kind}_{scope}"
    for kind in ("indicador", "metas_vs_resultado", "evolucao_temporal")
    for scope in ("municipio", "uf", "brasil")
)


@dataclass(frozen=True)
class Layers:
    """Folders of the three layers, and of the goals received as events, if any."""

    bronze: str
    silver: str
    gold: str
    received_goals: str | None = None


def build_silver(spark: SparkSession, layers: Layers, model: IndicatorModel) -> None:
    """The silver tables, and the checks of their rows, which are taken while they are written."""
    def source(table: str) -> DataFrame:
        return scan(spark, f"{layers.bronze}/{table}")

    dictionary, localities = source("dicionario"), source("municipio_ibge")
    tables = {
        "alunos": (
            silver.silver_pupils(source("alunos"), dictionary, localities),
            quality.write_checks("nome_municipio", silver.PUPIL_CODES),
        ),
        "municipio": (
            silver.silver_municipality(source("municipio"), dictionary, localities),
            quality.write_checks("nome_municipio", silver.SUMMARY_CODES),
        ),
        "uf": (
            silver.silver_state(source("uf"), dictionary),
            quality.write_checks(codes=silver.SUMMARY_CODES),
        ),
    }
    found = []
    for table, (rows, checks) in tables.items():
        taken = Observation()
        write_partitioned(
            rows, f"{layers.silver}/{table}", ["ano"], rebalance=False,
            measure=(taken, [c.alias(name) for name, c in checks.items()]),
        )
        found += [(table, name, taken.get.get(name, 0)) for name in checks]
    # A row per check: some twenty, whatever the tables hold.
    spark.createDataFrame(found, "tabela string, verificacao string, valor bigint").write.mode(
        "overwrite"
    ).parquet(f"{layers.silver}/verificacoes")
    build_silver_goals(spark, layers, model)


def _goals(
    spark: SparkSession, layers: Layers, model: IndicatorModel, scopes: Sequence[str] | None = None
) -> DataFrame:
    """Goals of all scopes as loaded, with the received ones in the place of the country's.

    ``scopes`` leaves out the others, before goals are compared.
    """
    states, municipalities, country = (
        scan(spark, f"{layers.bronze}/meta_alfabetizacao_{scope}")
        for scope in ("uf", "municipio", "brasil")
    )
    goals = silver.silver_goals(states, municipalities, country, model)
    if scopes is not None:
        goals = goals.where(F.col("escopo").isin(*scopes))
    if not layers.received_goals:
        return goals
    streamed = streamed_goals(read_received(spark, layers.received_goals), model)
    if scopes is not None:
        streamed = streamed.where(F.col("escopo").isin(*scopes))
    return silver.stamped_goals(with_streamed_goals(goals, streamed))


def build_silver_goals(spark: SparkSession, layers: Layers, model: IndicatorModel) -> None:
    write_partitioned(
        _goals(spark, layers, model), f"{layers.silver}/meta_alfabetizacao", ["escopo"]
    )


def rebuild_goal_scopes(
    spark: SparkSession, layers: Layers, model: IndicatorModel, scopes: Sequence[str]
) -> None:
    """Write the goals of some scopes anew; the others keep their files."""
    replace_partitions(
        _goals(spark, layers, model, scopes), f"{layers.silver}/meta_alfabetizacao", "escopo",
        scopes,
    )


def build_parts(spark: SparkSession, layers: Layers) -> None:
    """Read the pupil records once and keep their additive parts for every level."""
    pupils = require_columns(
        "alunos", scan(spark, f"{layers.silver}/alunos"), REQUIRED_PUPILS
    )
    additive_parts(pupils).write.mode("overwrite").parquet(f"{layers.silver}/partes_alunos")


def build_goal_dependent(spark: SparkSession, layers: Layers, model: IndicatorModel) -> None:
    """Indicators, goal comparisons and evolutions of the three levels."""
    states = require_columns("uf", scan(spark, f"{layers.silver}/uf"), REQUIRED_STATE)
    places = require_columns(
        "municipio", scan(spark, f"{layers.silver}/municipio"), REQUIRED_MUNICIPALITY
    )
    goals = require_columns(
        "meta_alfabetizacao", scan(spark, f"{layers.silver}/meta_alfabetizacao"),
        REQUIRED_GOALS,
    )
    parts = scan(spark, f"{layers.silver}/partes_alunos")

    def store(kind: str, level: Level, df: DataFrame) -> DataFrame:
        path = f"{layers.gold}/{kind}_{level.scope}"
        # A year of states or of the country is a handful of rows; municipalities may be many.
        return write_partitioned(df, path, ["ano"], one_file=level.few_rows, rebalance=False)

    def store_level(level: Level, indicator: DataFrame) -> DataFrame:
        written = store("indicador", level, indicator)
        store("metas_vs_resultado", level, gold.goal_comparison(written, goals, level))
        store("evolucao_temporal", level, gold.evolution(written, goals, level, model))
        return written

    country = store_level(COUNTRY, gold.indicator_country(parts, goals, model))
    state = store_level(STATE, gold.indicator_state(states, parts, goals, country, model))
    store_level(
        MUNICIPALITY,
        gold.indicator_municipality(places, parts, goals, state, country, model),
    )


def build_features(spark: SparkSession, layers: Layers, model: IndicatorModel) -> None:
    pupils = scan(spark, f"{layers.silver}/alunos")
    places = scan(spark, f"{layers.silver}/municipio")
    features = gold.pupil_features(pupils, places, model)
    write_partitioned(features, f"{layers.gold}/ml_aluno", ["ano"], rebalance=False)


def quality_tables(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    """What to look at after a run.

    Row counts by the key that each table is judged by; for the silver tables also the facts
    without a place and the codes without a description; for goals the unknown networks.

    The checks of single rows were taken while the tables were written.  Counts by place and
    year come from the parts of the pupils, which name both.  Of the pupils themselves only the
    ids are read, once, to count the different ones.
    """
    def silver_table(name: str) -> DataFrame:
        return scan(spark, f"{layers.silver}/{name}")

    checks, parts = silver_table("verificacoes"), silver_table("partes_alunos")
    goals = silver_table("meta_alfabetizacao")
    places = quality.count_distinct(parts, ["sigla_uf", "id_municipio"])
    ids = quality.count_distinct(silver_table("alunos"), ["id_aluno"])
    distinct = [f"distintos_{c}" for c in ("sigla_uf", "id_municipio", "id_aluno")]
    found = {
        "alunos_por_uf_e_ano": (
            parts.groupBy("sigla_uf", F.col("ano_referencia").alias("ano"))
            .agg(F.sum("registros").alias("registros")).orderBy("sigla_uf", "ano")
        ),
        "alunos_distintos": places.unionByName(ids, allowMissingColumns=True).agg(
            *(F.max(c).alias(c) for c in distinct)
        ),
        "alunos_sem_municipio": quality.unmatched_of(checks, "alunos"),
        "alunos_sem_de_para": quality.unmapped_of(checks, "alunos"),
        "municipio_sem_municipio": quality.unmatched_of(checks, "municipio"),
        "municipio_sem_de_para": quality.unmapped_of(checks, "municipio"),
        "uf_sem_de_para": quality.unmapped_of(checks, "uf"),
        "metas_por_escopo_e_ano": quality.count_by_key(goals, ["escopo", "ano_publicacao"]),
        "metas_redes": quality.distinct_rows(goals, ["escopo", "rede", "rede_descricao"]),
        "metas_sem_rede": quality.unmapped_texts(goals),
        "ml_aluno": quality.count_by_key(
            scan(spark, f"{layers.gold}/ml_aluno"), ["dataset_split", "ano"]
        ),
    }
    for table in CATALOG_TABLES:
        key = "escopo_meta" if table.startswith("metas") else "ano"
        found[table] = quality.count_by_key(scan(spark, f"{layers.gold}/{table}"), [key])
    return found


def register_gold(spark: SparkSession, layers: Layers, database: str) -> list[str]:
    return register_tables(
        spark, database, {t: f"{layers.gold}/{t}" for t in CATALOG_TABLES}, layers.gold
    )


def run_pipeline(
    spark: SparkSession, layers: Layers, model: IndicatorModel, database: str | None = None
) -> None:
    """Everything, from the copied sources to the catalogued gold tables."""
    build_silver(spark, layers, model)
    build_parts(spark, layers)
    build_goal_dependent(spark, layers, model)
    build_features(spark, layers, model)
    if database:
        register_gold(spark, layers, database)


def refresh_after_goals(spark: SparkSession, layers: Layers, model: IndicatorModel) -> None:
    """What new goals of any scope change: the goal table and all gold tables that read it.

    Pupil records and their parts stay as they are, and so does the feature table.
    """
    build_silver_goals(spark, layers, model)
    build_goal_dependent(spark, layers, model)


def refresh_after_batch(
    spark: SparkSession, layers: Layers, model: IndicatorModel, batch: int
) -> list[int]:
    """Bring gold up to date after one micro-batch of received goals; the years it rewrote.

    Received goals are the country's, and a goal counts in the year it was published in.  So of
    the goal table only the country's folder is written anew, and of gold the folders of the
    published years in those tables that read the country's goals: its indicator, its evolution
    and the comparisons of all levels.  Everything else keeps its files.  A batch that is
    processed again writes the same folders again.
    """
    received = read_received(spark, layers.received_goals).where(F.col("lote") == batch)
    parts = scan(spark, f"{layers.silver}/partes_alunos")
    places = scan(spark, f"{layers.silver}/municipio")
    states = scan(spark, f"{layers.silver}/uf")
    # Only years that have results can change; of those there are as many as exams were held.
    held = parts.select(F.col("ano_referencia").alias("ano")).unionByName(
        places.select("ano")
    ).unionByName(states.select("ano")).distinct()
    years = sorted(r["ano"] for r in held.join(received.select("ano"), "ano", "left_semi").collect())
    rebuild_goal_scopes(spark, layers, model, [SCOPE_COUNTRY])
    if not years:
        return years
    goals = scan(spark, f"{layers.silver}/meta_alfabetizacao")

    def renew(kind: str, level: Level, df: DataFrame) -> None:
        replace_partitions(
            df, f"{layers.gold}/{kind}_{level.scope}", "ano", years,
            one_file=level.few_rows, rebalance=False,
        )

    of_years = parts.where(F.col("ano_referencia").isin(*years))
    renew("indicador", COUNTRY, gold.indicator_country(of_years, goals, model))
    for level in (COUNTRY, STATE, MUNICIPALITY):
        indicator = scan(spark, f"{layers.gold}/indicador_{level.scope}")
        renew(
            "metas_vs_resultado", level,
            gold.goal_comparison(indicator.where(F.col("ano").isin(*years)), goals, level),
        )
    whole = scan(spark, f"{layers.gold}/indicador_{SCOPE_COUNTRY}")
    renew("evolucao_temporal", COUNTRY, gold.evolution(whole, goals, COUNTRY, model))
    return years


def load_bronze(
    sources: Mapping[str, DataFrame], layers: Layers
) -> None:
    """Copy the sources into bronze, one folder each."""
    snapshot(sources.__getitem__, sources, layers.bronze)
