"""Silver tables: cleaned, typed, decoded and enriched sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.functions import normalized_state
from lettera.model import COUNTRY, MUNICIPALITY, STATE, IndicatorModel
from lettera.operators.clean import drop_duplicate_rows, normalize_ids, typed
from lettera.operators.goals import union_goals
from lettera.operators.lookup import decode, enrich

# Coded column -> its description.
SUMMARY_CODES = {"rede": "rede_descricao", "serie": "serie_descricao"}
PUPIL_CODES = SUMMARY_CODES | {
    "presenca": "presenca_descricao",
    "preenchimento_caderno": "preenchimento_caderno_descricao",
    "alfabetizado": "alfabetizado_descricao",
}


def _stamped(df: DataFrame) -> DataFrame:
    """Add the reference year, which partitioning by ``ano`` leaves in the rows, and the time."""
    return df.withColumns({
        "ano_referencia": F.col("ano"),
        "processed_at": F.current_timestamp(),
    })


def _with_place(df: DataFrame, localities: DataFrame) -> DataFrame:
    placed = enrich(
        df,
        localities,
        "id_municipio",
        ["nome_municipio", "sigla_uf"],
    )
    return placed.withColumn("sigla_uf", normalized_state(F.col("sigla_uf")))


def silver_state(source: DataFrame, dictionary: DataFrame) -> DataFrame:
    df = normalize_ids(drop_duplicate_rows(source), states=["sigla_uf"])
    df = typed(df, ["ano", "serie", "rede"], ["taxa_alfabetizacao", "media_portugues"])
    return _stamped(decode(df, dictionary, "uf", SUMMARY_CODES))


def silver_municipality(
    source: DataFrame, dictionary: DataFrame, localities: DataFrame
) -> DataFrame:
    df = normalize_ids(drop_duplicate_rows(source), ids=["id_municipio"])
    df = typed(df, ["ano", "serie", "rede"], ["taxa_alfabetizacao", "media_portugues"])
    df = _with_place(df, localities)
    return _stamped(decode(df, dictionary, "municipio", SUMMARY_CODES))


def silver_pupils(
    source: DataFrame, dictionary: DataFrame, localities: DataFrame
) -> DataFrame:
    df = normalize_ids(
        drop_duplicate_rows(source), ids=["id_municipio", "id_escola", "id_aluno"]
    )
    df = typed(
        df,
        ["ano", "serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado"],
        ["proficiencia", "peso_aluno"],
    )
    df = _with_place(df, localities)
    return _stamped(decode(df, dictionary, "alunos", PUPIL_CODES))


def silver_goals(
    states: DataFrame,
    municipalities: DataFrame,
    country: DataFrame,
    model: IndicatorModel,
) -> DataFrame:
    goals = union_goals(
        [(states, STATE), (municipalities, MUNICIPALITY), (country, COUNTRY)], model
    )
    return stamped_goals(goals)


def stamped_goals(goals: DataFrame) -> DataFrame:
    return goals.withColumn("processed_at", F.current_timestamp())
