import pytest
from pyspark.sql import functions as F

from lettera.model import IndicatorModel
from lettera.operators.rollup import additive_parts, into_network_groups, pupil_volume, roll_up
from tests.conftest import as_set

MODEL = IndicatorModel()
KEYS = ["uf", "ano", "rede"]


@pytest.fixture
def pupils(rows):
    return rows(
        [
            ("RS", 2024, 2, 1, 2.0), ("RS", 2024, 2, 0, 6.0), ("RS", 2024, 2, None, 9.0),
            ("RS", 2024, 3, 1, None), ("RS", 2024, 3, 0, 1.0), ("RS", 2024, 4, 1, 0.0),
            ("SP", 2024, 3, None, 5.0), ("SP", 2024, 9, 1, 5.0), ("SP", 2024, None, 1, 5.0),
        ],
        "uf string, ano int, rede int, alfabetizado int, peso_aluno double",
    )


def test_parts_ignore_pupils_without_flag(pupils):
    parts = additive_parts(pupils, KEYS).where("uf = 'RS' AND rede = 2")
    # All three records count, two of them with a flag.
    assert as_set(parts.drop(*KEYS)) == {(2.0, 8.0, 1.0, 2, 3)}


def test_networks_overlap(pupils):
    spread = into_network_groups(pupils.where("uf = 'RS'"), MODEL)
    counts = {r["rede"]: r["count"] for r in spread.groupBy("rede").count().collect()}
    assert counts == {0: 6, 5: 5, 2: 3, 3: 2, 4: 1}


def test_rates_are_recomputed_not_averaged(pupils):
    out = roll_up(additive_parts(pupils, KEYS), ["uf"], MODEL)
    rates = {
        (r["uf"], r["rede"]): r["taxa_alfabetizacao_calculada"] for r in out.collect()
    }
    assert rates[("RS", 2)] == 25.0
    assert rates[("RS", 3)] == 0.0
    assert rates[("RS", 4)] == 100.0
    assert rates[("RS", 5)] == pytest.approx(100 * 2 / 9)
    assert rates[("SP", 3)] is None
    # Networks outside every group, or unknown, appear nowhere.
    assert rates[("SP", 0)] is None


def test_levels_and_networks_add_up(workspace):
    parts = workspace.parts
    grain = ["ano_referencia", "serie"]
    state = pupil_volume(parts, ["sigla_uf", *grain], MODEL)
    country = pupil_volume(parts, grain, MODEL)
    summed = state.groupBy(*grain, "rede").agg(F.sum("qtd_alunos").alias("qtd_alunos"))
    assert as_set(summed) == as_set(country.select(*summed.columns))
    by_network = country.groupBy(*grain).pivot("rede", [0, 2, 3, 4, 5]).sum("qtd_alunos")
    assert by_network.where("`2` + `3` <> `5` OR `2` + `3` + `4` <> `0`").count() == 0


def test_empty_key_list_means_the_whole_country(pupils):
    out = roll_up(additive_parts(pupils, KEYS), [], MODEL)
    assert {r["rede"] for r in out.collect()} == {0, 2, 3, 4, 5}


def test_parts_are_summed_before_the_shuffle(pupils):
    plan = additive_parts(pupils, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")
