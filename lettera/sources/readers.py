"""Reading tables, and copying them into the bronze layer."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Parquet dataset or single file.

    Only the columns asked for are read; a condition on a partition column leaves whole
    folders unread.
    """
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def first_rows(df: DataFrame, n: int = 5000) -> DataFrame:
    """The first block of n rows: a quick look, not a random sample."""
    return df.limit(n)


def describe_columns(df: DataFrame) -> DataFrame:
    """Name, type and nullability of each column, in order."""
    return df.sparkSession.createDataFrame(
        [
            (i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)
        ],
        "posicao int, coluna string, tipo string, aceita_nulo boolean",
    )


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Every file below a folder: dataset (first path step), path, size, time of change.

    File contents are not read: the columns that hold them are never selected.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    # The first occurrence of the whole root: folders below may repeat its last step.
    below = F.element_at(F.split(F.col("path"), _quoted(_plain_path(root) + "/"), 2), -1)
    return files.select(
        F.element_at(F.split(below, "/"), 1).alias("conjunto"),
        "path",
        "length",
        "modificationTime",
    )


def layer_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Datasets of a layer with their number of files and bytes."""
    return (
        list_objects(spark, root)
        .groupBy("conjunto")
        .agg(F.count(F.lit(1)).alias("arquivos"), F.sum("length").alias("bytes"))
        .orderBy("conjunto")
    )


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of rows of each dataset; answered from file footers."""
    counts = [
        df.agg(F.lit(name).alias("conjunto"), F.count(F.lit(1)).alias("registros"))
        for name, df in tables.items()
    ]
    united = counts[0]
    for part in counts[1:]:
        united = united.unionByName(part)
    return united.orderBy("conjunto")


def snapshot(
    read: Callable[[str], DataFrame], tables: Iterable[str], bronze: str
) -> list[str]:
    """Copy whole tables, as they are, into one folder each.

    ``read`` turns a table name into a DataFrame: a warehouse connection, files, anything
    Spark reads.  Each copy is written in parallel by the tasks that read it.
    """
    paths = []
    for table in tables:
        path = f"{bronze.rstrip('/')}/{table}"
        read(table).write.mode("overwrite").option("compression", "snappy").parquet(path)
        paths.append(path)
    return paths


def _plain_path(root: str) -> str:
    """A folder without its scheme and without a slash at the end."""
    return root.split(":", 1)[-1].rstrip("/").replace("//", "/")


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"
