"""Session for local runs, and the folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "lettera", **extra: str) -> SparkSession:
    """A local session as the tests and the benchmark use it.

    Many different queries run in it, so it keeps more generated code than usual; and most of
    its large groupings are deduplications of nearly unique rows, for which the small first
    hash map only gets in the way.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.codegen.aggregate.map.twolevel.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="lettera-")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new, empty folder that every executor can reach.

    A cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local session may
    do without it: there all tasks share one disk, and a temporary folder is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def as_written_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write once, read back: cuts the lineage and survives the loss of executors.

    Used where one result feeds several branches, so that none of them runs it again.
    """
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
