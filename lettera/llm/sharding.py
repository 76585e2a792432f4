"""Shards of bounded bytes by extendible hashing.

A directory is indexed by the leading bits of a row's hash.  A bucket is a prefix; only a bucket
whose bytes exceed the limit is split on its next bit, so its depth is the least at which it
fits.  All of it is DataFrame work: one sum per fine cell of the hash space, the directory from
those sums, and one equi-join of the rows with the directory.  Buckets that are still too large
at the resolution of a round go on to the next one with more bits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import stored

#: Bits of the key's hash, and as many again of the row's number for rows whose hashes are equal.
KEY_BITS = 60
#: Bits that a round looks at beyond those that an even spread would need.
SPARE_BITS = 5


def key_hash(key: Column) -> Column:
    """60 bits of the MD5 of a key's text; a null key counts as the empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, KEY_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def assign_shards(df: DataFrame, key: Column, size: Column, limit: int) -> DataFrame:
    """``df`` with its shard: ``shard`` (the prefix's bits, "" for the root), ``depth``,
    ``shard_bytes`` and ``oversized``.

    ``size`` is a row's bytes, null counting as 0; ``limit`` is the most bytes of a shard.  Rows
    of equal key hash (repeated rows, null keys) go on to be split by the bits of their number
    once all of the key's bits are used, so no key is too frequent.  Only a single row above the
    limit keeps a shard above it, alone, marked ``oversized``.  An empty table has no shards.
    Columns of ``df`` of any name stay; the new ones stand beside the struct ``row``.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    rows = stored(
        df.select(
            F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
            key_hash(key).alias("hash"),
            F.coalesce(size.cast("long"), F.lit(0)).alias("bytes"),
            key_hash(F.monotonically_increasing_id()).alias("tie"),
        ),
        "shards-rows",
    )
    done, used = None, 0
    while True:
        total = rows.agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).first()
        if not total["n"]:
            break
        step = 0 if total["b"] <= limit else math.ceil(math.log2(total["b"] / limit)) + SPARE_BITS
        at = min(2 * KEY_BITS, used + max(step, SPARE_BITS))
        if used < KEY_BITS < at:
            at = KEY_BITS
        cells = _directory(rows, used, at, limit)
        placed = rows.withColumn("cell", _prefix(at)).join(cells, "cell", "left")
        fits = placed.filter(F.col("depth").isNotNull()).drop("cell")
        done = fits if done is None else done.unionByName(fits)
        if at == 2 * KEY_BITS or cells.filter(F.col("depth").isNull()).isEmpty():
            break
        rows = stored(placed.filter(F.col("depth").isNull()).select(*rows.columns), "shards-rest")
        used = at
    if done is None:
        done = rows.select(
            "row", F.lit("").alias("shard"), F.lit(0).alias("depth"),
            F.lit(0).cast("long").alias("shard_bytes"), F.lit(False).alias("oversized"), "bytes",
        )
    return done.select("row", "shard", "depth", "shard_bytes", "oversized", "bytes")


def _bits() -> Column:
    """All bits of a row as a text of 0s and 1s."""
    return F.concat(
        F.lpad(F.conv(F.col("hash").cast("string"), 10, 2), KEY_BITS, "0"),
        F.lpad(F.conv(F.col("tie").cast("string"), 10, 2), KEY_BITS, "0"),
    )


def _prefix(bits: int) -> Column:
    return F.substring(_bits(), 1, bits) if bits else F.lit("")


def _directory(rows: DataFrame, used: int, at: int, limit: int) -> DataFrame:
    """For each cell of ``at`` bits the bucket it belongs to; without one if it is too large."""
    cells = stored(
        rows.groupBy(_prefix(at).alias("cell"))
        .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows")),
        "shards-cells",
    )
    above = cells.select(
        "cell", "bytes", "rows",
        F.explode(F.sequence(F.lit(used), F.lit(at))).alias("depth"),
    ).withColumn("shard", F.expr("substring(cell, 1, depth)"))
    # A lone row is a bucket of its own whatever its size: no bit can split it.
    buckets = (
        above.groupBy("shard", "depth")
        .agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("rows"))
        .filter((F.col("shard_bytes") <= limit) | (F.col("rows") == 1) | (F.col("depth") == 2 * KEY_BITS))
    )
    chosen = (
        above.select("cell", "shard", "depth").join(buckets.drop("rows"), ["shard", "depth"])
        .groupBy("cell")
        .agg(F.min(F.struct("depth", "shard", "shard_bytes")).alias("s"))
    )
    return stored(
        cells.select("cell").join(chosen, "cell", "left")
        .select(
            "cell", "s.depth", "s.shard", "s.shard_bytes",
            (F.col("s.shard_bytes") > limit).alias("oversized"),
        ),
        "shards-directory",
    )
