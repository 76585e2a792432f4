"""Column expressions shared by the operators.

All of them are built-in JVM expressions: they stay inside whole-stage code generation and
they hold under ANSI mode, where a plain cast or a division by zero would fail the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# A whole number written with decimals, such as "3.0" or "-7.".
_DECIMAL_TEXT = r"^\s*[+-]?[0-9]+\.[0-9]*\s*$"

# What every text that a cast can read looks like, and few others do.  A cast that fails costs an
# exception, some twenty times a cast that succeeds, so other texts are left out before it.
_MAY_BE_INT = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
_MAY_BE_DOUBLE = r"^[\x00-\x20]*[+-]?(?:[0-9.]|[nN][aA][nN]|[iI][nN][fF])"


def normalized_id(c: Column) -> Column:
    """Identifier as trimmed text."""
    return F.trim(c.cast("string"))


def normalized_state(c: Column) -> Column:
    """State code as trimmed upper-case text."""
    return F.upper(F.trim(c))


def to_int(c: Column, is_text: bool = True) -> Column:
    """Integer, or NULL when the value cannot be read as one; decimals are cut off.

    The decimal form is tried only where the direct cast gave nothing.
    """
    if not is_text:
        return c.try_cast("int")
    direct = F.when(c.rlike(_MAY_BE_INT), c.try_cast("int"))
    decimal = F.when(c.rlike(_DECIMAL_TEXT), c.try_cast("double").try_cast("int"))
    return F.coalesce(direct, decimal)


def to_double(c: Column, is_text: bool = True) -> Column:
    """Double, or NULL when the value cannot be read as one."""
    cast = c.try_cast("double")
    return F.when(c.rlike(_MAY_BE_DOUBLE), cast) if is_text else cast


def code_of(c: Column, codes: Mapping[str, int]) -> Column:
    """Code of a trimmed text; NULL for a text outside the mapping."""
    pairs = chain.from_iterable((F.lit(text), F.lit(code)) for text, code in codes.items())
    return F.element_at(F.create_map(*pairs), F.trim(c))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; NULL when the divisor is zero or missing."""
    return F.try_divide(F.lit(100.0) * part, whole)


def weighted_rate(
    weighted_sum: Column, weight_sum: Column, simple_sum: Column, n: Column
) -> Column:
    """Weighted mean in percent, or the simple mean where weights are missing or zero."""
    return F.coalesce(percent(weighted_sum, weight_sum), percent(simple_sum, n))


def guarded_percent_change(now: Column, before: Column) -> Column:
    """Percent change against a positive earlier value; NULL otherwise."""
    return F.when(before > 0, F.lit(100.0) * (now - before) / before)


def murmur_bucket(c: Column, buckets: int = 100) -> Column:
    """Stable bucket of a value from Spark's own hash (Murmur3, seed 42)."""
    return F.pmod(F.hash(c), F.lit(buckets))


def portable_bucket(c: Column, buckets: int = 100) -> Column:
    """Stable bucket that any engine with MD5 can reproduce."""
    head = F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(buckets)).cast("int")


def labelled_bucket(bucket: Column, shares: Iterable[tuple[str, int]]) -> Column:
    """Label of the consecutive share of buckets that a bucket number falls into."""
    upper, label = 0, None
    for name, share in shares:
        upper += share
        below = bucket < F.lit(upper)
        label = F.when(below, F.lit(name)) if label is None else label.when(below, F.lit(name))
    return label
