"""Writing partitioned tables and registering them in the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    *,
    one_file: bool = False,
    rebalance: bool = True,
    replace: str = "static",
    measure: tuple[Observation, Sequence[Column]] | None = None,
) -> DataFrame:
    """Overwrite a Snappy Parquet table, one folder per partition value, and read it back.

    ``one_file`` gives one file per partition value, for small report tables: one task writes
    each value.  Otherwise rows are rebalanced by partition value, where Spark cuts a value
    that is too large for one task into several files and merges small ones.

    ``rebalance=False`` is for large tables whose rows come out of a shuffle already, dealt by a key
    other than the partitions: the tasks that hold them write them, each a file per value it has,
    and the whole table is not shuffled once more.

    ``replace="dynamic"`` leaves partition values alone that the new data does not contain.

    ``measure`` takes aggregates of the rows while they are written.  They are taken after the
    rows were arranged, in the writing tasks: what a task counts is counted once there, even if
    executors are lost, whereas a task before a shuffle may run and count again.
    """
    arranged = df
    if one_file:
        arranged = df.repartition(*partitions)
    elif rebalance:
        arranged = df.hint("rebalance", *partitions)
    if measure:
        arranged = arranged.observe(measure[0], *measure[1])
    (
        arranged.write.mode("overwrite")
        .option("partitionOverwriteMode", replace)
        .option("compression", "snappy")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, column: str, values: Sequence[str | int], *,
    one_file: bool = False, rebalance: bool = True,
) -> None:
    """Give a table new rows for some values of its partition column; other values keep their files.

    Rows of ``df`` with another value are left out.  A value without rows is emptied: what the
    table held for it goes, which a dynamic overwrite alone would leave.
    """
    unfit = [v for v in values if not str(v).replace("_", "").replace("-", "").isalnum()]
    if unfit:
        raise ValueError(f"not a plain partition value: {unfit}")
    if not values:
        return
    counted = Observation()
    rows = df.where(F.col(column).isin(*values))
    write_partitioned(
        rows, path, [column], one_file=one_file, rebalance=rebalance, replace="dynamic",
        measure=(counted, [F.count_if(F.col(column) == v).alias(str(v)) for v in values]),
    )
    for value in values:
        if not counted.get.get(str(value)):
            rows.where("false").drop(column).write.mode("overwrite").option(
                "compression", "snappy"
            ).parquet(f"{path}/{column}={value}")


def register_tables(
    spark: SparkSession, database: str, tables: Mapping[str, str], root: str
) -> list[str]:
    """Make written tables known to SQL under ``database``; data stays where it is.

    Registering again refreshes columns and partitions.  Only the entry is replaced: the
    tables are external, so dropping one touches no file.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root}'")
    names = []
    for table, path in tables.items():
        name = f"`{database}`.`{table}`"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(f"{database}.{table}", path=path, source="parquet")
        if spark.table(name).schema and _is_partitioned(spark, name):
            spark.catalog.recoverPartitions(f"{database}.{table}")
        names.append(f"{database}.{table}")
    return names


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    plain = name.replace("`", "")
    return any(c.isPartition for c in spark.catalog.listColumns(plain))
