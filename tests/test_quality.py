import pytest
from pyspark.sql import Observation

from lettera.operators import quality
from lettera.sources.writers import write_partitioned
from tests.conftest import as_set


@pytest.fixture
def facts(rows):
    return rows(
        [("RS", 2023, "A", "Municipal"), ("RS", 2023, None, "Nao informado"),
         ("SP", 2024, "B", "Municipal"), (None, 2024, None, "Nao informado")],
        "uf string, ano int, nome string, rede_descricao string",
    )


def test_contract_names_what_is_missing(facts):
    assert quality.require_columns("f", facts, ["uf", "ano"]) is facts
    with pytest.raises(ValueError, match=r"table f lacks the columns \['x', 'y'\]"):
        quality.require_columns("f", facts, ["uf", "x", "y"])


def test_profile_counts_rows_and_gaps(facts):
    out = quality.profile(facts.select("ano", "uf", "nome"), ["ano"])
    assert as_set(out) == {(2023, 2, 0, 1), (2024, 2, 1, 1)}


def test_counts(facts):
    assert as_set(quality.count_by_key(facts, ["ano"])) == {(2023, 2), (2024, 2)}
    assert as_set(quality.count_distinct(facts, ["uf", "ano"])) == {(2, 2)}
    assert as_set(quality.distinct_rows(facts, ["ano"])) == {(2023,), (2024,)}


def test_distinct_counts_repeat_no_rows(spark, facts, tmp_path):
    """Gaps and empty tables count nothing; each column of a stored table is read for itself."""
    facts.write.parquet(str(tmp_path / "facts"))
    counted = quality.count_distinct(spark.read.parquet(str(tmp_path / "facts")), ["uf", "nome"])
    assert counted.columns == ["distintos_uf", "distintos_nome"] and as_set(counted) == {(2, 2)}
    plan = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Expand" not in plan
    assert plan.count("ReadSchema: struct<uf:string>") == 1
    assert plan.count("ReadSchema: struct<nome:string>") == 1
    assert as_set(quality.count_distinct(facts.where("false"), ["uf", "ano"])) == {(0, 0)}


def test_contract_gaps_name_every_column(facts):
    found = quality.contract_gaps({
        "a": (facts, ["uf", "x", "y"]), "b": (facts.where("ano = 2023"), ["z"]), "c": (facts, ["uf"]),
    })
    assert as_set(found) == {("a", "x", 4), ("a", "y", 4), ("b", "z", 2)}


def test_checks_of_a_write_equal_those_of_a_read(spark, facts, tmp_path):
    codes = {"rede": "rede_descricao"}
    checks = quality.write_checks("nome", codes)
    taken = Observation()
    write_partitioned(
        facts, str(tmp_path / "t"), ["ano"],
        measure=(taken, [c.alias(name) for name, c in checks.items()]),
    )
    stored = spark.createDataFrame(
        [("f", name, taken.get[name]) for name in checks],
        "tabela string, verificacao string, valor bigint",
    )
    assert as_set(quality.unmatched_of(stored, "f")) == as_set(quality.unmatched_rows(facts, "nome"))
    assert as_set(quality.unmapped_of(stored, "f")) == as_set(quality.unmapped_codes(facts, codes))


def test_unmatched_and_unmapped(facts, rows):
    assert as_set(quality.unmatched_rows(facts, "nome")) == {(4, 2)}
    assert as_set(quality.unmapped_codes(facts, {"rede": "rede_descricao"})) == {("rede", 2)}
    goals = rows([(3, "Municipal"), (None, "X"), (None, "X")], "rede int, rede_descricao string")
    assert as_set(quality.unmapped_texts(goals)) == {("X", 2)}


def test_key_quality(rows):
    df = rows([("1", "a"), ("1", None), (None, "c")], "id string, nome string")
    assert as_set(quality.key_quality(df, "id", ["nome"])) == {(3, 1, 1, 1)}


def test_label_share(facts):
    assert as_set(quality.label_share(facts, "ano")) == {(2023, 2, 0.5), (2024, 2, 0.5)}
