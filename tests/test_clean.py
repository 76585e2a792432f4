from pyspark.sql import Row

from lettera.operators.clean import (
    drop_duplicate_rows,
    normalize_ids,
    one_per_key,
    typed,
)
from tests.conftest import as_set


def test_ids_and_states(rows):
    df = rows([(7, " rs "), (8, None)], "id int, uf string")
    assert as_set(normalize_ids(df, ["id"], ["uf"])) == {("7", "RS"), ("8", None)}


def test_typed_knows_the_source_type(rows):
    df = rows([("3.0", 2, "x", 1.5)], "a string, b int, c string, d float")
    out = typed(df, ["a", "b"], ["c", "d"])
    assert out.dtypes == [("a", "int"), ("b", "int"), ("c", "double"), ("d", "double")]
    assert as_set(out) == {(3, 2, None, 1.5)}


def test_full_copies_go_and_nulls_count_as_equal(rows):
    df = rows([(1, None), (1, None), (1, "a")], "a int, b string")
    assert sorted(map(str, as_set(drop_duplicate_rows(df)))) == ["(1, 'a')", "(1, None)"]
    assert drop_duplicate_rows(df).count() == 2


def test_survivor_is_always_the_same(rows):
    data = [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "c"), (None, 5, "n"), (None, 4, "m")]
    df = rows(data, "key string, n int, s string")
    for partitions in (1, 3, 8):
        spread = df.repartition(partitions)
        assert as_set(one_per_key(spread, ["key"])) == {("k", 1, "c"), (None, 4, "m")}
        latest = one_per_key(spread, ["key"], prefer=["s"], latest=True)
        assert as_set(latest) == {("k", 1, "z"), (None, 5, "n")}
        assert latest.columns == df.columns


def test_known_values_go_before_missing_ones(rows):
    one = rows([("k", None), ("k", 2.0), ("k", 3.0), ("m", None)], "key string, v double")
    assert as_set(one_per_key(one, ["key"])) == {("k", 2.0), ("m", None)}
    assert as_set(one_per_key(one, ["key"], latest=True)) == {("k", 3.0), ("m", None)}
    two = rows([("k", None, 1), ("k", "b", None), ("k", "b", 5)], "key string, s string, n int")
    assert as_set(one_per_key(two, ["key"])) == {("k", "b", 5)}
    assert as_set(one_per_key(two, ["key"], latest=True)) == {("k", "b", 5)}


def test_a_group_of_copies_is_reduced_before_the_shuffle(spark):
    """A third of the rows share one key: the plan holds a partial aggregate, no window."""
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    out = one_per_key(df, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert out.count() == 20_001 and out.where("k = 0").first()["v"] == 0


def test_survivors_are_hashed(spark, rows, tmp_path):
    """Neither by a known preference nor by whole rows is a table sorted to find survivors."""
    df = rows([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z")], "k string, n int, t string")
    for options in ({"prefer": ["n"], "latest": True}, {"prefer": ["n"]}, {"prefer": ["t"]}, {}):
        plan = one_per_key(df, ["k"], **options)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_survivors_with_gaps_and_ties(rows):
    """The same survivor by either way, with missing keys, missing and equal preferences."""
    data = [
        ("a", 2.0, "x", 1), ("a", 2.0, "y", None), ("a", None, "z", 9), ("a", 1.0, "w", 5),
        (None, None, "q", 1), (None, None, "p", 2), ("n", float("nan"), "b", 1), ("n", 3.0, "a", 1),
        ("d", 1.0, "s", 1), ("d", 1.0, "s", 1),
    ]
    df = rows(data, "k string, n double, t string, v int")
    latest = one_per_key(df, ["k"], prefer=["n"], latest=True)
    assert sorted(map(str, latest.collect())) == sorted(map(str, [
        Row(k="a", n=2.0, t="y", v=None), Row(k=None, n=None, t="q", v=1),
        Row(k="n", n=float("nan"), t="b", v=1), Row(k="d", n=1.0, t="s", v=1),
    ]))
    first = one_per_key(df, ["k"], prefer=["n"])
    assert as_set(first, "k", "t") == {("a", "w"), (None, "p"), ("n", "a"), ("d", "s")}
    assert one_per_key(df.where("false"), ["k"], prefer=["n"]).count() == 0
