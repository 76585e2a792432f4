"""Feature table at pupil grain: context of the year before and a reproducible split."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettera.functions import labelled_bucket, murmur_bucket
from lettera.operators.clean import one_per_key
from lettera.operators.joins import HOT_FACTOR, left_lookup

CONTEXT_KEY = ("id_municipio", "ano_referencia", "rede", "serie")


def year_before_context(published: DataFrame) -> DataFrame:
    """Published figures, moved one year ahead so that they meet the following year.

    Figures of the same year are computed from the very pupils to be predicted.
    """
    return published.select(
        "id_municipio", "rede", "serie",
        (F.col("ano_referencia") + 1).alias("ano_referencia"),
        F.col("taxa_alfabetizacao").alias("taxa_alfabetizacao_municipio_ano_anterior"),
        F.col("media_portugues").alias("media_portugues_municipio_ano_anterior"),
    )


def attach_year_before(
    pupils: DataFrame, published: DataFrame, *, split_hot: bool = False,
    hot_factor: float = HOT_FACTOR,
) -> DataFrame:
    """Add the context to each pupil, once.

    The key names place, year, network and grade.  Should a key have been published twice, the
    same one of its rows is always taken, so pupils are never repeated.
    """
    context = one_per_key(year_before_context(published), CONTEXT_KEY)
    return left_lookup(
        pupils, context, CONTEXT_KEY, split_hot=split_hot, hot_factor=hot_factor
    )


def split_label(
    pupil_id: Column, shares: Iterable[tuple[str, int]], bucket=murmur_bucket
) -> Column:
    """Part of the data a pupil belongs to: the same in every run."""
    return labelled_bucket(bucket(pupil_id), shares)
