"""Analytical questions over the gold tables.

Every report filters on the partition year first, so only that year's files are read.
Windows here run over one row per state, a number fixed by the list of states.  Questions 7 to 9
ask for a whole national table (comparison, indicator, evolution) and need no report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettera.model import SCOPE_MUNICIPALITY, SCOPE_STATE

MUNICIPAL = "Municipal"

RESULT_COLUMNS = [
    "ano", "sigla_uf", "nome_municipio", "rede_descricao", "taxa_alfabetizacao",
    "meta_alfabetizacao", "gap_pp", "atingiu_meta", "ano_meta",
]


def _tenth(c: Column | str) -> Column:
    return F.round(c, 1)


def _share(part: Column, whole: Column) -> Column:
    """Percentage as a double; NULL for an empty whole."""
    return F.try_divide(F.lit(100.0).cast("double") * part, whole.cast("double"))


def result_against_goal(comparison: DataFrame, year: int) -> DataFrame:
    """Question 1: result and goal of the year, for each municipality."""
    return comparison.where(
        (F.col("ano") == year)
        & (F.col("ano_meta") == year)
        & (F.col("rede_descricao") == MUNICIPAL)
    ).select(*RESULT_COLUMNS)


def goal_reached(comparison: DataFrame, year: int) -> DataFrame:
    """Question 2: municipalities that reached the goal of the year, best first."""
    return (
        result_against_goal(comparison, year)
        .where("atingiu_meta")
        .orderBy(F.desc_nulls_last("gap_pp"), "sigla_uf", "nome_municipio")
    )


def distance_by_goal_year(comparison: DataFrame, year: int) -> DataFrame:
    """Question 3: how far this year's results are from the goal of every later year."""
    chosen = comparison.where(
        (F.col("ano") == year)
        & (F.col("escopo_meta") == SCOPE_MUNICIPALITY)
        & (F.col("rede_descricao") == MUNICIPAL)
    )
    reached = F.count_if("atingiu_meta")
    return (
        chosen.groupBy("ano_meta")
        .agg(
            F.count(F.lit(1)).alias("municipios"),
            reached.alias("ja_alcancam_a_meta"),
            _tenth(_share(reached, F.count(F.lit(1)))).alias("percentual_que_alcanca"),
            _tenth(F.avg("meta_alfabetizacao")).alias("meta_media"),
            _tenth(F.avg("taxa_alfabetizacao")).alias("taxa_media_observada"),
            _tenth(F.avg("gap_pp")).alias("gap_medio_pp"),
            _tenth(F.percentile_approx("gap_pp", 0.5)).alias("gap_mediano_pp"),
        )
        .orderBy("ano_meta")
    )


def state_ranking(comparison: DataFrame, year: int, final_year: int) -> DataFrame:
    """Question 4: states ordered by their distance to the final goal."""
    state = Window.partitionBy("sigla_uf")
    final_gap = F.max(F.when(F.col("ano_meta") == final_year, F.col("gap_pp"))).over(state)
    return (
        comparison.where((F.col("ano") == year) & (F.col("escopo_meta") == SCOPE_STATE))
        .withColumns({
            "_final": final_gap,
            "degraus_alcancados": F.count_if("atingiu_meta").over(state),
        })
        .select(
            "sigla_uf", "ano_meta",
            *[
                _tenth(c).alias(c)
                for c in (
                    "taxa_alfabetizacao", "meta_alfabetizacao", "gap_pp",
                    "percentual_da_meta",
                )
            ],
            "atingiu_meta", "meta_ja_vencida", "degraus_alcancados",
            _tenth("_final").alias("gap_2030_pp"),
        )
        .orderBy(
            F.desc_nulls_last("gap_2030_pp"), F.desc("degraus_alcancados"),
            F.asc_nulls_last("sigla_uf"), "ano_meta",
        )
    )


def running_share(df: DataFrame, value: str, tie_break: str) -> tuple[Column, Column]:
    """Share of the grand total, and the share summed from the largest value down.

    For tables of one row per state: the windows see all rows at once.
    """
    everything = Window.partitionBy()
    ranked = Window.orderBy(F.desc(value), F.asc_nulls_last(tie_break)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = F.sum(value).over(everything)
    return _share(F.col(value), total), _share(F.sum(value).over(ranked), total)


def states_below_goal(comparison: DataFrame, year: int) -> DataFrame:
    """Question 5: which states hold the municipalities below the goal of the year."""
    missed = ~F.col("atingiu_meta")
    by_state = (
        comparison.where(
            (F.col("ano") == year)
            & (F.col("escopo_meta") == SCOPE_MUNICIPALITY)
            & (F.col("ano_meta") == year)
        )
        .groupBy("sigla_uf")
        .agg(
            F.count(F.lit(1)).alias("municipios_com_meta"),
            F.count_if(missed).alias("municipios_abaixo"),
            F.avg(F.when(missed, F.col("gap_pp"))).alias("_gap_abaixo"),
            F.min("gap_pp").alias("_pior_gap"),
        )
        .withColumn(
            "_percentual", _share(F.col("municipios_abaixo"), F.col("municipios_com_meta"))
        )
    )
    share, cumulative = running_share(by_state, "municipios_abaixo", "sigla_uf")
    return (
        by_state.withColumns({"_share": share, "_cumulative": cumulative})
        .select(
            "sigla_uf", "municipios_com_meta", "municipios_abaixo",
            _tenth("_percentual").alias("percentual_abaixo"),
            _tenth("_share").alias("percentual_do_total"),
            _tenth("_cumulative").alias("acumulado_nacional"),
            _tenth("_gap_abaixo").alias("gap_medio_dos_abaixo"),
            _tenth("_pior_gap").alias("pior_gap_pp"),
        )
        .orderBy(
            F.desc("municipios_abaixo"), F.desc("percentual_abaixo"),
            F.asc_nulls_last("sigla_uf"),
        )
    )


def spread_between_and_within_states(indicator: DataFrame, year: int) -> DataFrame:
    """Question 6: differences between states, and between municipalities of one state."""
    to_country, to_state = F.col("diferenca_pp_vs_brasil"), F.col("diferenca_pp_vs_uf")
    above = F.count_if(to_country > 0)
    by_state = (
        indicator.where(
            (F.col("ano") == year)
            & (F.col("rede_descricao") == MUNICIPAL)
            & F.col("taxa_alfabetizacao").isNotNull()
        )
        .groupBy("sigla_uf", "serie", "serie_descricao")
        .agg(
            F.count(F.lit(1)).alias("municipios"),
            F.count(to_country).alias("municipios_comparaveis"),
            F.avg("taxa_alfabetizacao").alias("_rate"),
            F.avg(to_country).alias("_mean"),
            F.percentile_approx(to_country, 0.5).alias("_median"),
            above.alias("municipios_acima_do_brasil"),
            _share(above, F.count(to_country)).alias("_above_share"),
            F.stddev(to_state).alias("_deviation"),
            F.percentile_approx(to_state, [0.1, 0.9]).alias("_tails"),
        )
        .withColumns({"_p10": F.col("_tails")[0], "_p90": F.col("_tails")[1]})
        .withColumn("_width", F.col("_p90") - F.col("_p10"))
    )
    grade = Window.partitionBy("serie")
    return (
        by_state.withColumns({
            "_between": F.max("_mean").over(grade) - F.min("_mean").over(grade),
            "_within": F.avg("_width").over(grade),
        })
        .orderBy("serie", F.desc_nulls_last(_tenth("_mean")), F.asc_nulls_last("sigla_uf"))
        .select(
            "sigla_uf", "municipios", "municipios_comparaveis",
            _tenth("_rate").alias("taxa_media_municipal"),
            _tenth("_mean").alias("media_vs_brasil_pp"),
            _tenth("_median").alias("mediana_vs_brasil_pp"),
            "municipios_acima_do_brasil",
            _tenth("_above_share").alias("percentual_acima_do_brasil"),
            _tenth("_deviation").alias("desvio_interno_pp"),
            _tenth("_p10").alias("p10_vs_uf_pp"),
            _tenth("_p90").alias("p90_vs_uf_pp"),
            _tenth("_width").alias("amplitude_p10_p90_pp"),
            _tenth("_between").alias("amplitude_entre_ufs_pp"),
            _tenth("_within").alias("amplitude_interna_media_pp"),
        )
    )
