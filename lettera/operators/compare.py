"""Comparison columns: pupil volume, parent level, country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.model import Level
from lettera.operators.clean import one_per_key
from lettera.operators.joins import HOT_FACTOR, left_lookup

CUT = ("ano_referencia", "serie", "rede")


def attach_volume(df: DataFrame, volume: DataFrame, level: Level) -> DataFrame:
    """Pupil count by place, year, grade and network.

    Both sides have one row per cut of a place, so neither has a hot key.  No hint: Spark
    knows the size of both once they are aggregated.
    """
    return df.join(volume, [*level.keys, *CUT], "left").select(*df.columns, "qtd_alunos")


def attach_reference_rate(
    df: DataFrame, reference: DataFrame, places: Sequence[str], suffix: str, *,
    split_hot: bool = False, hot_factor: float = HOT_FACTOR,
) -> DataFrame:
    """Rate of a coarser level on the same cut, and the difference to it.

    Many rows share one reference, a third of them perhaps: a large state.  Cuts that the
    reference holds twice (two descriptions of one grade) count once, so rows never multiply.
    """
    on = [*places, *CUT]
    rate = f"taxa_alfabetizacao_{suffix}"
    side = one_per_key(reference.select(*on, F.col("taxa_alfabetizacao").alias(rate)), on)
    return left_lookup(df, side, on, split_hot=split_hot, hot_factor=hot_factor).select(
        *df.columns,
        rate,
        (F.col("taxa_alfabetizacao") - F.col(rate)).alias(f"diferenca_pp_vs_{suffix}"),
    )
