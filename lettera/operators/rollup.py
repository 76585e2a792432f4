"""Roll-up of pupil records through additive parts.

A mean is a quotient of two sums, and sums of groups add up to the sums of larger groups.  So
pupil records are read once, for the smallest groups; each level above adds up what is below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.functions import weighted_rate
from lettera.model import IndicatorModel

# What a group's mean is made of, in the order that ``weighted_rate`` takes.
PARTS = ("peso_alfabetizado", "peso_conhecido", "alfabetizados", "qtd_alunos")

FINEST_GRAIN = (
    "sigla_uf", "id_municipio", "ano_referencia", "serie", "serie_descricao", "rede",
)


def additive_parts(pupils: DataFrame, keys: Sequence[str] = FINEST_GRAIN) -> DataFrame:
    """``PARTS`` of each group: sum(w x), sum(w), sum(x) and n over pupils whose flag x is known.

    ``registros`` counts all its records, for the quality tables.  What one pupil adds is a
    projection, so the parts are plain sums, which tasks begin before the shuffle; a group of
    any size leaves a task as one row.
    """
    x, w = F.col("alfabetizado").cast("double"), F.col("peso_aluno")
    adds = (x * w, F.when(x.isNotNull(), w), x, x.isNotNull().cast("int"))
    each = pupils.select(*keys, *(add.alias(name) for name, add in zip(PARTS, adds, strict=True)))
    return each.groupBy(*keys).agg(
        *(F.sum(name).alias(name) for name in PARTS), F.count(F.lit(1)).alias("registros")
    )


def into_network_groups(
    df: DataFrame, model: IndicatorModel, network: str = "rede"
) -> DataFrame:
    """Repeat each row once per network group it counts towards.

    The membership list is short and constant, so it is a literal in the projection: no join
    and no pass per group.  Rows of a network outside every group disappear.
    """
    members = [
        x
        for member, groups in sorted(model.memberships().items())
        for x in (F.lit(member), F.array(*[F.lit(g) for g in groups]))
    ]
    groups = F.element_at(F.create_map(*members), F.col(network))
    return df.withColumn(network, F.explode(groups))


def network_label(model: IndicatorModel, network: str = "rede"):
    pairs = [x for code, label in model.labels().items() for x in (F.lit(code), F.lit(label))]
    return F.element_at(F.create_map(*pairs), F.col(network))


def roll_up(parts: DataFrame, keys: Sequence[str], model: IndicatorModel) -> DataFrame:
    """Sum the parts per key and network group and compute the rate again."""
    summed = (
        into_network_groups(parts, model)
        .groupBy(*keys, "rede")
        .agg(*[F.sum(c).alias(c) for c in PARTS])
    )
    return summed.select(
        *keys,
        "rede",
        network_label(model).alias("rede_descricao"),
        weighted_rate(*[F.col(c) for c in PARTS]).alias("taxa_alfabetizacao_calculada"),
        "qtd_alunos",
    )


def pupil_volume(parts: DataFrame, keys: Sequence[str], model: IndicatorModel) -> DataFrame:
    """Number of pupils per key and network group."""
    return (
        into_network_groups(parts.select(*keys, "rede", "qtd_alunos"), model)
        .groupBy(*keys, "rede")
        .agg(F.sum("qtd_alunos").alias("qtd_alunos"))
    )
