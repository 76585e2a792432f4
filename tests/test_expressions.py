import time

import pytest
from pyspark.sql import functions as F

from lettera.functions import (
    code_of,
    guarded_percent_change,
    labelled_bucket,
    murmur_bucket,
    percent,
    to_double,
    to_int,
    weighted_rate,
)


def values(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_text_to_numbers(rows):
    texts = ["3", " 3 ", "3.0", "3.7", "-2.9", "7.", "x", None, "1e3", "99999999999", ""]
    df = rows([(t,) for t in texts], "a string")
    assert values(df, to_int(F.col("a"))) == [3, 3, 3, 3, -2, 7, None, None, None, None, None]
    assert values(df, to_double(F.col("a")))[:5] == [3.0, 3.0, 3.0, 3.7, -2.9]


ODD = [
    "7", "+7", "-7", "-0", " 7\t", "\n7", "7\n", "\x007\x7f", "\x1f7", "7.", ".5", "-.5", ".", "+", "",
    " ", "1 2", "7-", "--7", "1,5", "1_0", "1e3", "1E-2", "1d", "1.5F", "0x10", "0x1p3", "NaN", "nan",
    " NaN ", "-NaN", "inf", "+inf", "-INF", " Infinity ", "-infinity", "infinit", "N", "A", "I", "nada",
    "\u00a07", "7\u00a0", "\u30007", "\uff17", "\u0667", "7\u0085", "\x857", "2147483647", "2147483648",
    "-2147483648", "99999999999", "1e400", "\n+7.25 ", None,
]


def test_texts_left_out_are_those_that_no_cast_reads(rows):
    """The guards before the casts change no value, on odd texts and bare characters."""
    texts = [*ODD, *map(chr, range(256)), *(f"{chr(c)}7" for c in range(256)),
             *(f"7{chr(c)}" for c in range(256))]
    df = rows([(t,) for t in texts], "a string")
    plain = F.coalesce(
        F.col("a").try_cast("int"),
        F.when(F.col("a").rlike(r"^\s*[+-]?[0-9]+\.[0-9]*\s*$"),
               F.col("a").try_cast("double").try_cast("int")),
    )
    assert list(map(repr, values(df, to_int(F.col("a"))))) == list(map(repr, values(df, plain)))
    assert list(map(repr, values(df, to_double(F.col("a"))))) == list(
        map(repr, values(df, F.col("a").try_cast("double")))
    )


@pytest.mark.parametrize("number", [to_int, to_double])
def test_unreadable_texts_cost_no_exception(spark, number):
    """Decimals and words take no more than some times what whole numbers take."""
    def seconds(text):
        df = spark.range(0, 1_000_000, 1, 4).select(text.alias("a")).select(number(F.col("a")))
        best = []
        for _ in range(3):
            begin = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - begin)
        return min(best)

    whole = seconds(F.col("id").cast("string"))
    assert seconds(F.concat(F.lit("x"), "id")) < 5 * whole + 0.2
    assert seconds(F.concat("id", F.lit(".5"))) < 5 * whole + 0.2


def test_numbers_stay_numbers(rows):
    df = rows([(4, 2.9), (None, None)], "a int, b double")
    assert values(df, to_int(F.col("a"), False)) == [4, None]
    assert values(df, to_int(F.col("b"), False)) == [2, None]


def test_code_of_text(rows):
    df = rows([(" Municipal ",), ("Pública",), ("Outra",), (None,)], "a string")
    assert values(df, code_of(F.col("a"), {"Pública": 5, "Municipal": 3})) == [3, 5, None, None]


@pytest.mark.parametrize(
    "parts, rate",
    [
        ((30.0, 60.0, 1.0, 4), 50.0),
        ((None, None, 1.0, 4), 25.0),
        ((0.0, 0.0, 3.0, 4), 75.0),
        ((None, None, None, 0), None),
    ],
)
def test_weighted_rate_falls_back_to_the_simple_mean(rows, parts, rate):
    df = rows([parts], "a double, b double, c double, d bigint")
    assert values(df, weighted_rate(*[F.col(c) for c in "abcd"])) == [rate]


def test_percent_of_a_zero_goal_is_missing(rows):
    df = rows([(50.0, 0.0), (50.0, 80.0), (None, 80.0)], "a double, b double")
    assert values(df, percent(F.col("a"), F.col("b"))) == [None, 62.5, None]


def test_percent_change_needs_a_positive_start(rows):
    df = rows([(50.0, 40.0), (50.0, 0.0), (50.0, None), (50.0, -1.0)], "a double, b double")
    change = guarded_percent_change(F.col("a"), F.col("b"))
    assert values(df, change) == [25.0, None, None, None]


def test_labels_cover_all_buckets(spark):
    shares = (("treino", 70), ("validacao", 15), ("teste", 15))
    df = spark.range(100).select(labelled_bucket(F.col("id"), shares).alias("label"))
    counts = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    assert counts == {"treino": 70, "validacao": 15, "teste": 15}


def test_bucket_does_not_depend_on_partitions(spark):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    bucket = murmur_bucket(F.col("id")).alias("b")
    one = ids.coalesce(1).select("id", bucket)
    many = ids.repartition(16).select("id", bucket)
    assert one.exceptAll(many).count() == 0
    # The same function as the built-in hash, with a non-negative remainder.
    assert ids.where(bucket != F.expr("pmod(hash(id), 100)")).count() == 0
