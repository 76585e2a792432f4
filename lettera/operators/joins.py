"""Left joins that hold for small and large sides and for hot keys.

No side is forced to be broadcast: Spark compares its bytes with the session's thresholds, by
statistics before the run and by what was shuffled during it, and adaptive execution splits the
skewed partitions of the fact.  So the fact is read once, whatever the size of the side.

Where hot keys are known to be beyond that, ``split_hot`` takes them apart: the rows of a few keys
far above the mean meet their few side rows by broadcast and are then dealt evenly, the others
are shuffled by key.  Both ways return the same rows.  The second reads the fact twice (its keys
to count them, then its rows) and the side twice; give it stored tables, not long computations.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.session import as_written_table

# A hot key holds more than this multiple of the mean rows per key ...
HOT_FACTOR = 10.0
# ... and more than this share of the fact, so at most 100,000 keys can be hot.
HOT_SHARE = 1e-5
# Rows that meet no side row in the shuffle are dealt to so many parts.
DEALT = 1 << 20


def left_lookup(
    fact: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    *,
    split_hot: bool = False,
    hot_factor: float = HOT_FACTOR,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Left join of a fact with a side that has one row per key."""
    on = list(on)
    if split_hot:
        return _split_hot_keys(fact, side, on, hot_keys(fact, on, hot_factor, hot_share))
    extra = [c for c in side.columns if c not in on]
    return fact.join(side, on, "left").select(*fact.columns, *extra)


def hot_keys(
    fact: DataFrame,
    on: Sequence[str],
    hot_factor: float = HOT_FACTOR,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Keys far above the mean number of rows, among the rows that have a complete key.

    The mean follows the data; the share bounds the number of keys by ``1 / hot_share``,
    whatever the size of the fact.
    """
    complete = reduce(and_, [F.col(c).isNotNull() for c in on])
    per_key = fact.where(complete).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    threshold = per_key.agg(
        F.greatest(F.avg("_n") * F.lit(hot_factor), F.sum("_n") * F.lit(hot_share))
    ).scalar()
    return per_key.where(F.col("_n") > threshold).select(*on)


def _split_hot_keys(
    fact: DataFrame, side: DataFrame, on: list[str], keys: DataFrame
) -> DataFrame:
    """One join of the fact, in which hot rows have their columns already and are dealt evenly.

    A row of a hot key, or without a key, takes part in the shuffle with an empty key and one
    of many numbers, so that it meets no side row and no task gets more of them than another.
    """
    extra = [c for c in side.columns if c not in on]
    keys = as_written_table(keys, "hot-keys")
    hot_rows = side.join(F.broadcast(keys), on, "left_semi")
    hot_side = keys.join(hot_rows, on, "left").select(
        *on, F.struct(*extra).alias("_found"), F.lit(True).alias("_hot")
    )
    # A row with a missing key matches nothing, so it need not look for a partner either.
    settled = F.col("_hot").isNotNull() | reduce(or_, [F.col(c).isNull() for c in on])
    marked = fact.join(F.broadcast(hot_side), on, "left").select(
        *fact.columns, "_found", "_hot",
        *(F.when(~settled, F.col(c)).alias(f"_on_{c}") for c in on),
        F.when(settled, F.monotonically_increasing_id() % DEALT).otherwise(0).alias("_deal"),
    )
    # Its number is 0 for every key, written so that it stays a column to shuffle by.
    rest = side.select(
        *(F.col(c).alias(f"_on_{c}") for c in on),
        F.pmod(F.hash(*on), F.lit(1)).cast("bigint").alias("_deal"),
        *(F.col(c).alias(f"_side_{c}") for c in extra),
    )
    joined = marked.join(rest, [*(f"_on_{c}" for c in on), "_deal"], "left")
    return joined.select(*fact.columns, *(
        F.when(F.col("_hot"), F.col(f"_found.{c}")).otherwise(F.col(f"_side_{c}")).alias(c)
        for c in extra
    ))
