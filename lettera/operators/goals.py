"""Goals: from wide yearly columns to long rows, and joining them to results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettera.functions import code_of, normalized_id, normalized_state, percent, to_double, to_int
from lettera.model import (
    COUNTRY_KEY,
    GOAL_PREFIX,
    SCOPE_COUNTRY,
    IndicatorModel,
    Level,
)
from lettera.operators.clean import one_per_key

GOAL_KEY = ("escopo", "chave", "rede", "rede_descricao", "ano_publicacao", "ano_meta")


def place_key(level: Level) -> Column:
    """Key of a goal row: state code, municipality id, or the constant of the country."""
    if level.key is None:
        return F.lit(COUNTRY_KEY)
    if level.key == "sigla_uf":
        return normalized_state(F.col(level.key))
    return normalized_id(F.col(level.key))


def unpivot_goals(df: DataFrame, level: Level, model: IndicatorModel) -> DataFrame:
    """One row per goal year instead of one column; a missing goal is a missing row.

    Goal-year columns that the table lacks are left out, further ones are ignored.
    """
    years = [y for y in model.goal_years if f"{GOAL_PREFIX}{y}" in df.columns]
    text = {c for c, kind in df.dtypes if kind == "string"}
    ids = ["escopo", "chave", "rede", "rede_descricao", "ano_publicacao"]
    wide = df.select(
        F.lit(level.scope).alias("escopo"),
        place_key(level).alias("chave"),
        code_of(F.col("rede"), model.network_codes).alias("rede"),
        normalized_id(F.col("rede")).alias("rede_descricao"),
        to_int(F.col("ano"), "ano" in text).alias("ano_publicacao"),
        *[
            to_double(F.col(c), c in text).alias(str(y))
            for y in years for c in [f"{GOAL_PREFIX}{y}"]
        ],
    )
    return (
        wide.unpivot(ids, [str(y) for y in years], "ano_meta", "meta_alfabetizacao")
        .where(F.col("meta_alfabetizacao").isNotNull())
        .withColumn("ano_meta", F.col("ano_meta").cast("int"))
    )


def union_goals(blocks: list[tuple[DataFrame, Level]], model: IndicatorModel) -> DataFrame:
    """Long goals of several levels in one table, one row per natural key.

    The network belongs to the key: two networks of one place are two goals.
    """
    longs = [unpivot_goals(df, level, model) for df, level in blocks]
    united = longs[0]
    for long in longs[1:]:
        united = united.unionByName(long)
    return one_per_key(united, GOAL_KEY)


def goals_of(goals: DataFrame, scope: str) -> DataFrame:
    return goals.where(F.col("escopo") == scope)


def _join_by_place(
    df: DataFrame, goals: DataFrame, level: Level, years: dict[str, str], how: str
) -> DataFrame:
    """Join goal columns by network, place and the year columns given (``{ours: theirs}``).

    No hint in either case.  Goals of places meet on a key that holds one cut of one place.
    Goals of the country have at most one row per mapped network, revision and goal year, by
    their natural key; Spark sees so few bytes in their own folder and broadcasts them.
    """
    on = ["rede", *years]
    side = goals.withColumnsRenamed({theirs: ours for ours, theirs in years.items()})
    if level.key:
        on.append(level.key)
        side = side.withColumnRenamed("chave", level.key)
    else:
        mapped = F.col("rede").isNotNull() & (F.col("chave") == COUNTRY_KEY)
        side = side.where(mapped).drop("chave")
    return df.join(side, on, how).select(
        *df.columns, *[c for c in side.columns if c not in on]
    )


def attach_goal_of_year(df: DataFrame, goals: DataFrame, level: Level) -> DataFrame:
    """Goal for the observed year, from the revision published in that same year."""
    side = (
        goals_of(goals, level.scope)
        .where(F.col("ano_publicacao") == F.col("ano_meta"))
        .select(
            "chave", "rede", "ano_meta",
            F.col("meta_alfabetizacao").alias("meta_alfabetizacao_do_ano"),
        )
    )
    joined = _join_by_place(df, side, level, {"ano_referencia": "ano_meta"}, "left")
    return joined.withColumn(
        "gap_meta_do_ano_pp",
        F.col("taxa_alfabetizacao") - F.col("meta_alfabetizacao_do_ano"),
    )


def attach_final_goal(
    df: DataFrame, goals: DataFrame, level: Level, final_year: int
) -> DataFrame:
    """Goal of the final year in the revision in force; the gap is goal minus result."""
    side = (
        goals_of(goals, level.scope)
        .where(F.col("ano_meta") == final_year)
        .select(
            "chave", "rede", "ano_publicacao",
            F.col("meta_alfabetizacao").alias("meta_alfabetizacao_final"),
        )
    )
    joined = _join_by_place(df, side, level, {"ano_referencia": "ano_publicacao"}, "left")
    return joined.withColumn(
        "gap_para_meta_final_pp",
        F.col("meta_alfabetizacao_final") - F.col("taxa_alfabetizacao"),
    )


def goals_against_results(
    indicator: DataFrame, goals: DataFrame, level: Level, country: Level
) -> DataFrame:
    """Every result with every goal in force for it: of its own place and of the country.

    Two equi-joins and a union.  A single join with the two cases as alternatives could only
    hash on (network, year) and would compare all places of a year with each other.
    """
    results = indicator.where(F.col("taxa_alfabetizacao").isNotNull())
    in_force = {"ano_referencia": "ano_publicacao"}
    parts = []
    for scope_level in [level] if level.scope == SCOPE_COUNTRY else [level, country]:
        side = goals_of(goals, scope_level.scope).select(
            "chave", "rede", "ano_publicacao", F.col("escopo").alias("escopo_meta"),
            "ano_meta", "meta_alfabetizacao",
        )
        parts.append(_join_by_place(results, side, scope_level, in_force, "inner"))
    united = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    rate, goal = F.col("taxa_alfabetizacao"), F.col("meta_alfabetizacao")
    return united.select(
        "nivel_geografico",
        *level.id_columns,
        F.col("ano_referencia").alias("ano_observacao"),
        "serie", "serie_descricao", "rede", "rede_descricao", "taxa_alfabetizacao",
        "qtd_alunos", "origem_indicador", "escopo_meta", "ano_meta", "meta_alfabetizacao",
        (rate - goal).alias("gap_pp"),
        percent(rate, goal).alias("percentual_da_meta"),
        (rate >= goal).alias("atingiu_meta"),
        (F.col("ano_meta") <= F.col("ano_referencia")).alias("meta_ja_vencida"),
        F.col("ano_referencia").alias("ano"),
    )
