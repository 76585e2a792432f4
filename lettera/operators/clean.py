"""Cleaning: identifiers, types, duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettera.functions import normalized_id, normalized_state, to_double, to_int


def normalize_ids(
    df: DataFrame, ids: Sequence[str] = (), states: Sequence[str] = ()
) -> DataFrame:
    """Trim identifiers and bring state codes to upper case."""
    return df.withColumns(
        {c: normalized_id(F.col(c)) for c in ids}
        | {c: normalized_state(F.col(c)) for c in states}
    )


def typed(
    df: DataFrame, ints: Sequence[str] = (), doubles: Sequence[str] = ()
) -> DataFrame:
    """Cast columns; a value that cannot be read becomes NULL instead of an error."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(
        {c: to_int(F.col(c), c in text) for c in ints}
        | {c: to_double(F.col(c), c in text) for c in doubles}
    )


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of every group of fully equal rows.

    The copies are collapsed in each task before the shuffle, so a row that occurs very
    often does not gather anywhere.
    """
    return df.dropDuplicates()


def one_per_key(
    df: DataFrame,
    keys: Sequence[str],
    prefer: Sequence[str] = (),
    latest: bool = False,
) -> DataFrame:
    """Keep one row per key, always the same one.

    The survivor has the smallest (``latest``: the largest) ``prefer`` columns, then the
    smallest (largest) remaining columns; a known value goes before a missing one.  It is an
    aggregate and not a window: the candidates of a key shrink to one per task before they
    are shuffled.

    Where the first preference is a number or a time, its best value per key is found first, by
    a plain hashed aggregate, and only rows that have it are compared as a whole.  That reads
    the rows twice, the first time only keys and preference; give it stored tables.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if len(others) == 1:
        # A plain minimum or maximum of a number is hashed, that of a struct is sorted.
        pick = F.max(others[0]) if latest else F.min(others[0])
        return df.groupBy(*keys).agg(pick.alias(others[0])).select(*df.columns)

    ranked = [*prefer, *(c for c in others if c not in prefer)]
    if prefer and isinstance(df.schema[prefer[0]].dataType, HASHED):
        df = _with_best(df, keys, prefer[0], latest)
    if latest:
        survivor = F.max(F.struct(*ranked))
    else:
        missing_last = [x for c in ranked for x in (F.col(c).isNull().alias(f"_{c}"), c)]
        survivor = F.min(F.struct(*missing_last))
    # The set, always empty, makes Spark keep the rows of a key as objects in a hash map; for
    # the struct alone it would sort all rows by key, before the shuffle and after.
    hashed = F.collect_set(F.lit(None).cast("int")).alias("_hashed")
    return (
        df.groupBy(*keys)
        .agg(survivor.alias("_row"), hashed)
        .where(F.size("_hashed") == 0)
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])
    )


# Types whose maximum and minimum Spark keeps in place in a hash map.
HASHED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _with_best(df: DataFrame, keys: list[str], rank: str, latest: bool) -> DataFrame:
    """The rows that have the best ``rank`` of their key, if any is known.

    Rows meet the best value on key and value at once, so the rows of a frequent key are
    shuffled, if at all, by their different values.
    """
    best = (F.max(rank) if latest else F.min(rank)).alias("_best")
    of_key = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(best)
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(of_key, reduce(and_, same, F.col(rank).eqNullSafe(F.col("_best"))), "left_semi")
