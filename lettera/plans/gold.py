"""Gold tables: indicators, goals against results, change over time, pupil features.

Each function takes silver tables and returns one gold table.  Levels are built from the top
down, because a level is compared with the ones above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.functions import murmur_bucket
from lettera.model import (
    COUNTRY,
    MUNICIPALITY,
    ORIGIN_COMPUTED,
    ORIGIN_PUBLISHED,
    STATE,
    IndicatorModel,
    Level,
)
from lettera.operators.compare import attach_reference_rate, attach_volume
from lettera.operators.features import attach_year_before, split_label
from lettera.operators.goals import (
    attach_final_goal,
    attach_goal_of_year,
    goals_against_results,
)
from lettera.operators.rollup import pupil_volume, roll_up
from lettera.operators.timeline import with_changes

YEAR_GRADE = ["ano_referencia", "serie"]

PUBLISHED_COLUMNS = [
    "ano_referencia", "serie", "serie_descricao", "rede", "rede_descricao",
    "taxa_alfabetizacao", "media_portugues",
]

FEATURE_COLUMNS = [
    "id_aluno", "id_escola", "id_municipio", "nome_municipio", "sigla_uf",
    "ano_referencia", "serie", "rede", "rede_descricao", "caderno", "presenca",
    "preenchimento_caderno", "proficiencia", "peso_aluno",
    "taxa_alfabetizacao_municipio_ano_anterior",
    "media_portugues_municipio_ano_anterior", "dataset_split", "alfabetizado",
]


def finished(df: DataFrame, level: Level) -> DataFrame:
    """Level, partition year and time stamp, which every indicator carries."""
    return df.withColumns({
        "nivel_geografico": F.lit(level.scope),
        "ano": F.col("ano_referencia"),
        "processed_at": F.current_timestamp(),
    })


def _published(
    silver: DataFrame, parts: DataFrame, goals: DataFrame, level: Level, model: IndicatorModel
) -> DataFrame:
    """Published rate with pupil volume and the goal of the year."""
    df = silver.select(
        *level.id_columns, *PUBLISHED_COLUMNS,
        F.lit(ORIGIN_PUBLISHED).alias("origem_indicador"),
    )
    df = attach_volume(df, pupil_volume(parts, [*level.keys, *YEAR_GRADE], model), level)
    return attach_goal_of_year(df, goals, level)


def indicator_country(parts: DataFrame, goals: DataFrame, model: IndicatorModel) -> DataFrame:
    """National rate, computed from pupil records because none is published per cut."""
    df = roll_up(parts, [*YEAR_GRADE, "serie_descricao"], model).select(
        *YEAR_GRADE, "serie_descricao", "rede", "rede_descricao",
        F.col("taxa_alfabetizacao_calculada").alias("taxa_alfabetizacao"),
        "qtd_alunos",
        F.lit(ORIGIN_COMPUTED).alias("origem_indicador"),
    )
    return finished(attach_goal_of_year(df, goals, COUNTRY), COUNTRY)


def indicator_state(
    silver: DataFrame,
    parts: DataFrame,
    goals: DataFrame,
    country: DataFrame,
    model: IndicatorModel,
) -> DataFrame:
    df = _published(silver, parts, goals, STATE, model)
    return finished(_against_country(df, country), STATE)


def indicator_municipality(
    silver: DataFrame,
    parts: DataFrame,
    goals: DataFrame,
    states: DataFrame,
    country: DataFrame,
    model: IndicatorModel,
) -> DataFrame:
    """``states`` and ``country`` are best given as written tables, of which Spark knows the size."""
    df = _published(silver, parts, goals, MUNICIPALITY, model)
    df = attach_reference_rate(df, states, ["sigla_uf"], "uf")
    return finished(_against_country(df, country), MUNICIPALITY)


def _against_country(df: DataFrame, country: DataFrame) -> DataFrame:
    return attach_reference_rate(df, country, [], "brasil")


def goal_comparison(indicator: DataFrame, goals: DataFrame, level: Level) -> DataFrame:
    df = goals_against_results(indicator, goals, level, COUNTRY)
    return df.withColumn("processed_at", F.current_timestamp())


def evolution(
    indicator: DataFrame, goals: DataFrame, level: Level, model: IndicatorModel
) -> DataFrame:
    df = with_changes(indicator, [*level.keys, "rede", "serie"])
    df = df.withColumn("processed_at", F.current_timestamp())
    return attach_final_goal(df, goals, level, model.final_goal_year)


def pupil_features(
    pupils: DataFrame,
    published: DataFrame,
    model: IndicatorModel,
    *,
    bucket=murmur_bucket,
) -> DataFrame:
    """Pupils with a known target, last year's context and their part of the split."""
    known = pupils.where(F.col("alfabetizado").isNotNull())
    df = attach_year_before(known, published)
    label = split_label(F.col("id_aluno"), model.splits, bucket)
    return (
        df.withColumn("dataset_split", label)
        .select(*FEATURE_COLUMNS)
        .withColumns({"ano": F.col("ano_referencia"), "processed_at": F.current_timestamp()})
    )
