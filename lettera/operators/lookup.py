"""Lookups: code dictionaries and the locality dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.functions import normalized_id
from lettera.model import UNMAPPED
from lettera.operators.clean import one_per_key
from lettera.operators.joins import HOT_FACTOR, left_lookup


def dictionary_entries(dictionary: DataFrame, table: str, column: str) -> DataFrame:
    """``(chave, valor)`` of one column of one table, one row per code."""
    return one_per_key(
        dictionary.where((F.col("id_tabela") == table) & (F.col("nome_coluna") == column))
        .select(
            normalized_id(F.col("chave")).alias("chave"),
            normalized_id(F.col("valor")).alias("valor"),
        ),
        ["chave"],
    )


def decode(
    df: DataFrame,
    dictionary: DataFrame,
    table: str,
    columns: Mapping[str, str],
    *,
    split_hot: bool = False,
    default: str = UNMAPPED,
) -> DataFrame:
    """Add the description of each coded column (``{column: description column}``)."""
    for column, description in columns.items():
        entries = dictionary_entries(dictionary, table, column).select(
            F.col("chave").alias("_code"), F.col("valor").alias(description)
        )
        df = left_lookup(
            df.withColumn("_code", normalized_id(F.col(column))),
            entries,
            ["_code"],
            split_hot=split_hot,
        ).drop("_code")
        df = df.withColumn(description, F.coalesce(F.col(description), F.lit(default)))
    return df


def enrich(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[str],
    *,
    split_hot: bool = False,
    hot_factor: float = HOT_FACTOR,
) -> DataFrame:
    """Add attributes of a dimension without ever multiplying or losing fact rows."""
    side = one_per_key(
        dimension.select(normalized_id(F.col(key)).alias(key), *attributes), [key]
    )
    return left_lookup(fact, side, [key], split_hot=split_hot, hot_factor=hot_factor)
