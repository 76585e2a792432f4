"""Data-quality results as DataFrames, and the column contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettera.model import UNMAPPED


def require_columns(name: str, df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail before any work starts when a table lacks columns."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(
            f"table {name} lacks the columns {missing}; it has {sorted(df.columns)}"
        )
    return df


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def contract_gaps(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per column that a table lacks, with the number of rows that lack it."""
    found = [
        df.agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("registros")).select(
            "tabela",
            F.explode(F.array(*map(F.lit, missing_columns(df, required))).cast("array<string>"))
            .alias("coluna"),
            "registros",
        )
        for name, (df, required) in tables.items()
    ]
    return reduce(DataFrame.unionByName, found).orderBy("tabela", "coluna")


def count_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("registros")).orderBy(*keys)


def profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, with the number of missing values of every other column."""
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("registros"),
            *[F.count_if(F.col(c).isNull()).alias(f"nulos_{c}") for c in others],
        )
        .orderBy(*keys)
    )


def count_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of different values of each column, in one row.

    Each column is grouped for itself: a task collapses its values before the shuffle, and a
    stored table is read one column at a time, all in all once.  Counting several columns in
    one aggregate would repeat every row once per column instead.
    """
    counts = [
        df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(c).alias("n")).select(
            *(F.when(F.lit(other == c), F.col("n")).alias(f"distintos_{other}") for other in columns)
        )
        for c in columns
    ]
    names = [f"distintos_{c}" for c in columns]
    return reduce(DataFrame.unionByName, counts).agg(*(F.max(n).alias(n) for n in names))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def unmatched_rows(df: DataFrame, attribute: str) -> DataFrame:
    """How many rows found no partner in the dimension that delivers ``attribute``."""
    return df.agg(
        F.count(F.lit(1)).alias("registros"),
        F.count_if(F.col(attribute).isNull()).alias("sem_correspondencia"),
    )


def unmapped_codes(
    df: DataFrame, columns: Mapping[str, str], default: str = UNMAPPED
) -> DataFrame:
    """Rows without a dictionary entry, per coded column: one pass for all columns."""
    counts = df.agg(*[
        F.count_if(F.col(description) == default).alias(column)
        for column, description in columns.items()
    ])
    return counts.unpivot([], list(columns), "coluna", "sem_de_para")


def write_checks(
    attribute: str | None = None, codes: Mapping[str, str] | None = None, default: str = UNMAPPED
) -> dict[str, Column]:
    """The row checks as plain aggregates, to be taken while a table is written.

    All rows; with ``attribute``, the rows that found no partner in the dimension that delivers
    it; with ``codes``, those without a dictionary entry per coded column.
    """
    checks = {"registros": F.count(F.lit(1))}
    if attribute:
        checks["sem_correspondencia"] = F.count_if(F.col(attribute).isNull())
    for column, description in (codes or {}).items():
        checks[f"sem_de_para_{column}"] = F.count_if(F.col(description) == default)
    return checks


def unmatched_of(checks: DataFrame, table: str) -> DataFrame:
    """What :func:`unmatched_rows` would find, from the checks of the write."""
    return checks.where(F.col("tabela") == table).agg(*(
        F.max(F.when(F.col("verificacao") == name, F.col("valor"))).alias(name)
        for name in ("registros", "sem_correspondencia")
    ))


def unmapped_of(checks: DataFrame, table: str) -> DataFrame:
    """What :func:`unmapped_codes` would find, from the checks of the write."""
    prefix = "sem_de_para_"
    return checks.where(
        (F.col("tabela") == table) & F.col("verificacao").startswith(prefix)
    ).select(
        F.substring("verificacao", len(prefix) + 1, 1000).alias("coluna"),
        F.col("valor").alias("sem_de_para"),
    )


def unmapped_texts(goals: DataFrame) -> DataFrame:
    """Network texts of the goals that have no code, with their number of rows."""
    return (
        goals.where(F.col("rede").isNull())
        .groupBy("rede_descricao")
        .agg(F.count(F.lit(1)).alias("registros"))
        .orderBy("rede_descricao")
    )


def key_quality(df: DataFrame, key: str, attributes: Sequence[str] = ()) -> DataFrame:
    """Rows, different keys and missing values of a dimension."""
    return df.agg(
        F.count(F.lit(1)).alias("registros"),
        F.countDistinct(key).alias("chaves_distintas"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulos_{c}") for c in [key, *attributes]],
    )


def label_share(df: DataFrame, label: str) -> DataFrame:
    """Rows and relative frequency of each label.

    The grand total is taken over the already counted labels, not over the rows.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("registros"))
    total = counts.agg(F.sum("registros")).scalar()
    return counts.withColumn("fracao", F.col("registros") / total)
