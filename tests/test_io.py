import json

import pytest
from pyspark.sql import functions as F

from lettera.session import as_written_table, scratch_folder
from lettera.sources.locality import flatten_localities, read_localities
from lettera.sources.readers import (
    describe_columns,
    first_rows,
    layer_inventory,
    list_objects,
    scan,
    snapshot,
)
from lettera.sources.writers import register_tables, write_partitioned
from tests.conftest import as_set


@pytest.fixture
def table(spark):
    return spark.range(1000).selectExpr(
        "id", "CAST(IF(id % 3 = 0, 2024, 2020 + id % 4) AS INT) AS ano", "id * 2 AS v"
    )


def test_scan_reads_only_what_is_asked_for(spark, table, tmp_path):
    write_partitioned(table, str(tmp_path / "t"), ["ano"])
    df = scan(spark, str(tmp_path / "t"), ["v"], F.col("ano") == 2024)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<v:bigint>" in plan
    assert "PartitionFilters: [isnotnull(ano" in plan
    assert df.count() == table.where("ano = 2024").count()


def test_one_file_per_year(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(table.repartition(8), path, ["ano"], one_file=True)
    files = list_objects(spark, path).where("path LIKE '%.parquet'").groupBy("conjunto").count()
    assert {r["count"] for r in files.collect()} == {1}
    assert as_set(files.select("conjunto")) == {(f"ano={y}",) for y in range(2020, 2025)}


def test_large_years_may_take_several_files(spark, tmp_path):
    """A year that holds most rows is cut up instead of gathered in one task."""
    path = str(tmp_path / "t")
    df = spark.range(0, 200_000, 1, 8).selectExpr(
        "uuid() AS a", "IF(id % 10 = 0, 2023, 2024) AS ano"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        write_partitioned(df, path, ["ano"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list_objects(spark, path).where("path LIKE '%.parquet'").groupBy("conjunto").count()
    counts = {r["conjunto"]: r["count"] for r in files.collect()}
    assert counts["ano=2024"] > 1
    assert scan(spark, path).count() == 200_000


def test_dynamic_replacement_keeps_other_years(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(table, path, ["ano"])
    newer = table.where("ano = 2024").withColumn("v", F.lit(0).cast("bigint"))
    write_partitioned(newer, path, ["ano"], replace="dynamic")
    assert scan(spark, path).count() == 1000
    assert as_set(scan(spark, path, ["v"], F.col("ano") == 2024)) == {(0,)}
    write_partitioned(newer, path, ["ano"])
    assert as_set(scan(spark, path, ["ano"])) == {(2024,)}


def test_registered_table_follows_its_files(spark, table, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "t")
    write_partitioned(table, path, ["ano"])
    [name] = register_tables(spark, "reg", {"t": path}, root)
    assert spark.table(name).count() == 1000
    write_partitioned(table.withColumn("extra", F.lit(1)), path, ["ano"])
    register_tables(spark, "reg", {"t": path}, root)
    assert "extra" in spark.table(name).columns
    assert spark.sql("SELECT count(*) FROM reg.t WHERE ano = '2024'").first()[0] == (
        table.where("ano = 2024").count()
    )


def test_snapshot_copies_whole_tables(spark, table, tmp_path):
    sources = {"a": table, "b": table.limit(3)}
    paths = snapshot(sources.__getitem__, sources, str(tmp_path))
    assert [spark.read.parquet(p).count() for p in paths] == [1000, 3]
    assert spark.read.parquet(paths[0]).exceptAll(table).count() == 0


def test_inventory_lists_datasets(spark, table, tmp_path):
    for name in ("x", "y"):
        table.coalesce(1).write.parquet(str(tmp_path / "layer" / name))
    found = layer_inventory(spark, str(tmp_path / "layer")).collect()
    assert [r["conjunto"] for r in found] == ["x", "y"]
    assert all(r["arquivos"] == 1 and r["bytes"] > 1000 for r in found)


def test_describe_and_first_rows(table):
    assert as_set(describe_columns(table), "posicao", "coluna", "tipo") == {
        (0, "id", "bigint"), (1, "ano", "int"), (2, "v", "bigint"),
    }
    assert first_rows(table, 7).count() == 7


@pytest.mark.parametrize("one_document", [True, False])
def test_localities_from_nested_json(spark, tmp_path, one_document):
    def place(i, name, state):
        return {"id": i, "nome": name, "outro": 1,
                "microrregiao": {"nome": "m", "mesorregiao": {"UF": {"id": 1, "sigla": state}}}}

    places = [place(4300109, "Agudo", "RS"), {"id": 5, "nome": "B", "microrregiao": None}]
    text = json.dumps(places, indent=1) if one_document else "\n".join(map(json.dumps, places))
    (tmp_path / "l.json").write_text(text)
    flat = flatten_localities(read_localities(spark, str(tmp_path / "l.json"), one_document))
    assert as_set(flat) == {("4300109", "Agudo", "RS"), ("5", "B", None)}


def test_scratch_is_below_the_checkpoint_folder(spark, table):
    folder = scratch_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != scratch_folder(spark, "x")
    kept = as_written_table(table, "kept")
    assert kept.dtypes == table.dtypes and kept.exceptAll(table).count() == 0


@pytest.mark.parametrize("master", ["local[2]", "yarn"])
def test_only_a_local_session_may_do_without_a_shared_folder(master):
    class Unset:
        def get(self, key, default):
            return default

    class Session:
        conf = Unset()
        sparkContext = type("Context", (), {"master": master})

    if master == "yarn":
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_folder(Session(), "x")
    else:
        assert "/x-" in scratch_folder(Session(), "x")
