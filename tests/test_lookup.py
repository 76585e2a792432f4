import pytest
from pyspark.sql import functions as F

from lettera.operators.joins import hot_keys, left_lookup
from lettera.operators.lookup import decode, dictionary_entries, enrich
from tests.conftest import as_set

DICTIONARY = [
    ("uf", "rede", " 3 ", "Municipal"),
    ("uf", "rede", "3", "Zzz"),
    ("uf", "rede", "2", " Estadual"),
    ("uf", "serie", "2", "2º ano"),
    ("alunos", "rede", "4", "Privada"),
]


@pytest.fixture
def dictionary(rows):
    return rows(DICTIONARY, "id_tabela string, nome_coluna string, chave string, valor string")


def test_entries_of_one_column(dictionary):
    found = as_set(dictionary_entries(dictionary, "uf", "rede"))
    assert found == {("3", "Municipal"), ("2", "Estadual")}


@pytest.mark.parametrize("split", [True, False])
def test_decode_keeps_every_row(rows, dictionary, split):
    df = rows([(1, 3, 2), (2, 2, 9), (3, 4, None), (4, None, 2)], "id int, rede int, serie int")
    out = decode(
        df, dictionary, "uf", {"rede": "r", "serie": "s"}, split_hot=split
    )
    no = "Nao informado"
    assert out.columns == ["id", "rede", "serie", "r", "s"]
    assert as_set(out, "id", "r", "s") == {
        (1, "Municipal", "2º ano"), (2, "Estadual", no), (3, no, no), (4, no, "2º ano"),
    }


@pytest.mark.parametrize("split", [True, False])
def test_enrich_neither_multiplies_nor_drops(rows, split):
    places = rows(
        [(" 1", "B", "rs"), ("1 ", "A", "rs"), ("2", "C", "sp")],
        "id string, nome string, uf string",
    )
    df = rows([("1", 10), ("1", 11), ("2", 12), ("3", 13), (None, 14)], "id string, v int")
    out = enrich(df, places, "id", ["nome", "uf"], split_hot=split)
    assert as_set(out, "v", "nome") == {
        (10, "A"), (11, "A"), (12, "C"), (13, None), (14, None),
    }


def skewed(spark, n=30_000):
    """A third of the rows on one key, a third without a key, the rest spread out."""
    return spark.range(n).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE CONCAT('k', id % 5000) END AS k",
        "id AS v",
    )


@pytest.mark.parametrize("hot_share", [0.2, 1e-3, 1e-9, 0.9])
def test_hot_keys_give_the_same_rows(spark, hot_share):
    fact = skewed(spark)
    side = spark.range(4000).selectExpr("CONCAT('k', id) AS k", "id AS a").unionByName(
        spark.sql("SELECT 'hot' AS k, 7L AS a")
    )
    expected = fact.join(side, ["k"], "left").select("k", "v", "a")
    out = left_lookup(fact, side, ["k"], split_hot=True, hot_factor=0.0, hot_share=hot_share)
    assert out.columns == ["k", "v", "a"]
    assert out.count() == fact.count()
    assert out.exceptAll(expected).count() == 0


def test_hot_key_without_partner_stays(spark):
    fact = skewed(spark, 300)
    side = spark.sql("SELECT 'absent' AS k, 1 AS a")
    out = left_lookup(fact, side, ["k"], split_hot=True, hot_factor=0.0, hot_share=0.2)
    assert out.count() == 300 and out.where("a IS NOT NULL").count() == 0


def test_two_keys(spark):
    fact = skewed(spark, 3000).withColumn("y", F.col("v") % 2)
    side = spark.sql("SELECT 'hot' AS k, 1L AS y, 9 AS a")
    out = left_lookup(fact, side, ["k", "y"], split_hot=True, hot_factor=0.0, hot_share=0.1)
    assert out.where("a = 9").count() == fact.where("k = 'hot' AND y = 1").count()
    assert out.count() == 3000


def test_only_hot_keys_are_taken_out_of_the_shuffle(spark):
    fact = skewed(spark)
    assert as_set(hot_keys(fact, ["k"], 0.0, 0.2)) == {("hot",)}
    assert hot_keys(fact, ["k"], 0.0, 1e-9).count() == fact.select("k").distinct().count() - 1

    side = spark.range(4000).selectExpr("CONCAT('k', id) AS k", "id AS a")
    out = left_lookup(fact, side, ["k"], split_hot=True, hot_factor=0.0, hot_share=0.2)
    # A hot row meets its side row by broadcast; in the shuffle it has no key and a number.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_hot" in plan and "rightHint=(strategy=broadcast)" in plan
    dealt = out.where("k = 'hot'")
    assert dealt.count() == fact.where("k = 'hot'").count() and dealt.where("a <> 7").count() == 0


def test_hot_keys_cost_one_more_read(spark, tmp_path):
    """One read to count the keys, one to join: no branch of its own for hot rows."""
    skewed(spark, 3000).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    side = spark.range(4000).selectExpr("CONCAT('k', id) AS k", "id AS a")
    out = left_lookup(fact, side, ["k"], split_hot=True, hot_factor=0.0, hot_share=0.2)
    scans = out._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/fact")
    keys = hot_keys(fact, ["k"])
    keys.collect()
    counted = keys._jdf.queryExecution().executedPlan().toString()
    counted = counted.split("== Initial Plan ==")[0]
    reused = counted.count("ReusedExchange")
    assert scans == 1 and counted.count(f"{tmp_path}/fact") - reused <= 1


def test_rows_without_partner_are_dealt_evenly(spark):
    fact = skewed(spark)
    side = spark.range(4000).selectExpr("CONCAT('k', id) AS k", "id AS a")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = left_lookup(fact, side, ["k"], split_hot=True, hot_factor=0.0, hot_share=0.2)
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 1.2 * sum(sizes) / len(sizes)


def test_both_ways_hold_rows(spark):
    fact = skewed(spark)
    side = spark.range(4000).selectExpr("CONCAT('k', id) AS k", "id AS a")
    assert as_set(hot_keys(fact, ["k"]), "k") == {("hot",)}
    out = left_lookup(fact, side, ["k"], split_hot=True)
    hot = fact.where("k = 'hot'").count()
    cold = fact.where("k <> 'hot'").count()
    assert hot > 0 and cold > 0
    assert out.where("k = 'hot'").count() == hot and out.where("k <> 'hot'").count() == cold


def test_even_keys_are_not_hot(spark):
    fact = spark.range(1000).selectExpr("CAST(id % 100 AS STRING) AS k")
    assert hot_keys(fact, ["k"]).count() == 0


def test_fact_is_read_once_without_hints(spark, tmp_path):
    skewed(spark, 300).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    side = spark.range(10).selectExpr("CONCAT('k', id) AS k", "id AS a")
    plan = left_lookup(fact, side, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and "Hint" not in plan
