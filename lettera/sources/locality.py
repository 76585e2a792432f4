"""Locality service: nested JSON of municipalities to a flat dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettera.functions import normalized_id

LOCALITY_SCHEMA = (
    "id bigint, nome string, "
    "microrregiao struct<mesorregiao: struct<UF: struct<sigla: string>>>"
)


def read_localities(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """Raw localities from one JSON array (``one_document``) or from JSON lines."""
    return spark.read.schema(LOCALITY_SCHEMA).option("multiLine", one_document).json(path)


def flatten_localities(raw: DataFrame) -> DataFrame:
    """``(id_municipio, nome_municipio, sigla_uf)``."""
    return raw.select(
        normalized_id(F.col("id")).alias("id_municipio"),
        F.col("nome").alias("nome_municipio"),
        F.col("microrregiao.mesorregiao.UF.sigla").alias("sigla_uf"),
    )
