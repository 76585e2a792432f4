"""Helpers that the operators share: shared tables, bound expressions, whole rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session may do without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master.startswith("local[") or master == "local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="lettera-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Elements of an array that one fold takes, characters of a piece of a text.
FOLDED, PIECE = 256, 4096


def before(values: Column, combine: Callable[[Column, Column], Column], first: Column) -> Column:
    """For each element of an array of whole numbers, ``combine`` over all elements before it.

    A fold that collects copies what it has at every step, so elements are folded in blocks, and
    the blocks' results once more: arrays of a hundred thousand elements take no longer per
    element than short ones.
    """
    def fold(xs: Column) -> Column:
        start = F.struct(first.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(xs, start, lambda a, x: F.struct(
            combine(a["at"], x).cast("int").alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")
        ))

    def blocks(xs: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / FOLDED).cast("int")),
            lambda b: fold(F.slice(xs, b * FOLDED + 1, F.lit(FOLDED))),
        )

    def joined(f: Column) -> Column:
        return F.flatten(F.zip_with(
            f, fold(F.transform(f, lambda x: x["at"]))["out"],
            lambda x, base: F.transform(x["out"], lambda v: combine(base, v).cast("int")),
        ))

    none = F.array().cast("array<int>")
    return let(values, lambda xs: F.when(F.size(xs) > 0, let(blocks(xs), joined)).otherwise(none))


def pieces_of(text: Column) -> Column:
    """A text in pieces of ``PIECE`` characters, for :func:`cut`; an empty text is one piece."""
    return let(text, lambda t: F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.length(t) - 1, F.lit(0)) / PIECE).cast("int")),
        lambda i: F.substring(t, i * PIECE + 1, F.lit(PIECE)),
    ))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` (exclusive) of a text in pieces, whose beginning isn't read."""
    a, b = (F.floor(x / PIECE).cast("int") for x in (start, end))
    within = F.substring(F.get(pieces, a), start % PIECE + 1, end - start)
    across = F.concat(
        F.substring(F.get(pieces, a), start % PIECE + 1, F.lit(PIECE)),
        F.array_join(F.slice(pieces, a + 2, F.greatest(b - a - 1, F.lit(0))), ""),
        F.substring(F.coalesce(F.get(pieces, b), F.lit("")), F.lit(1), end % PIECE),
    )
    return F.when(end <= start, "").when(a == b, within).otherwise(across)


def text_of(column: str = "text") -> Column:
    """A text column with nulls as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def rows_of(df: DataFrame, *columns: Column) -> DataFrame:
    """``row`` with all of ``df``'s columns, beside derived ones that no column can clash with."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *columns)


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], schema: str,
    rows: int = 2000,
) -> DataFrame:
    """``work`` over the Arrow batches of each partition; it yields a row as a dictionary."""
    import pyspark.sql.types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full: list[dict] = []
        for out in work(batches):
            full.append(out)
            if len(full) >= rows:
                yield pa.RecordBatch.from_pylist(full, schema=fields)
                full = []
        if full:
            yield pa.RecordBatch.from_pylist(full, schema=fields)
        # A worker outlives its task: what the pool keeps would weigh on the next stages.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    """The values of a text column, one at a time."""
    return (x.as_py() or "" for x in batch.column(batch.schema.get_field_index(column)))

