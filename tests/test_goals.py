import pytest

from lettera.model import COUNTRY, MUNICIPALITY, STATE, IndicatorModel
from lettera.operators.goals import (
    attach_final_goal,
    attach_goal_of_year,
    goals_against_results,
    union_goals,
    unpivot_goals,
)
from tests.conftest import as_set

MODEL = IndicatorModel(goal_years=(2024, 2025, 2030))

LONG = (
    "escopo string, chave string, rede int, rede_descricao string, ano_publicacao int, "
    "ano_meta int, meta_alfabetizacao double"
)
RESULT = (
    "id_municipio string, nome_municipio string, sigla_uf string, ano_referencia int, "
    "serie int, serie_descricao string, rede int, rede_descricao string, "
    "taxa_alfabetizacao double, qtd_alunos bigint, origem_indicador string, "
    "nivel_geografico string"
)


def result(place, year, grade, network, rate):
    return (place, place, "RS", year, grade, "s", network, "r", rate, 1, "o", "municipio")


@pytest.fixture
def goals(rows):
    return rows(
        [
            ("municipio", "1", 3, "Municipal", 2023, 2024, 60.0),
            ("municipio", "1", 3, "Municipal", 2024, 2024, 61.0),
            ("municipio", "1", 3, "Municipal", 2024, 2030, 90.0),
            ("municipio", "1", None, "Outra", 2024, 2024, 1.0),
            ("municipio", "2", 3, "Municipal", 2024, 2025, 0.0),
            ("brasil", "BR", 5, "Pública", 2024, 2024, 70.0),
            ("brasil", "XX", 5, "Pública", 2024, 2024, 99.0),
        ],
        LONG,
    )


@pytest.fixture
def results(rows):
    return rows(
        [
            result("1", 2024, 2, 3, 61.0),
            result("1", 2024, 5, 3, 50.0),
            result("1", 2024, 2, 5, 71.0),
            result("1", 2024, 2, 4, 99.0),
            result("1", 2024, 2, None, 99.0),
            result("2", 2024, 2, 3, 10.0),
            result("2", 2024, 5, 3, None),
            result("3", 2025, 2, 3, 10.0),
        ],
        RESULT,
    )


def test_unpivot_drops_missing_goals_and_foreign_years(rows):
    wide = rows(
        [("2024", " rs ", " Pública", "60", None, 90.0), ("2025", "SP", "Outra", "x", 5.0, None)],
        "ano string, sigla_uf string, rede string, meta_alfabetizacao_2024 string, "
        "meta_alfabetizacao_2025 double, meta_alfabetizacao_2031 double",
    )
    long = unpivot_goals(wide, STATE, MODEL)
    assert as_set(long) == {
        ("uf", "RS", 5, "Pública", 2024, 2024, 60.0),
        ("uf", "SP", None, "Outra", 2025, 2025, 5.0),
    }


def test_union_keeps_networks_apart_and_one_row_per_key(rows):
    schema = "ano int, id_municipio string, rede string, meta_alfabetizacao_2024 double"
    first = rows(
        [(2024, "1", "Municipal", 60.0), (2024, "1 ", "Municipal", 50.0),
         (2024, "1", "Pública", 70.0), (2024, "1", "X", 1.0), (2024, "1", "Y", 1.0)],
        schema,
    )
    country = rows(
        [(2024, "Pública", 80.0)], "ano int, rede string, meta_alfabetizacao_2024 double"
    )
    out = union_goals([(first, MUNICIPALITY), (country, COUNTRY)], MODEL)
    assert as_set(out, "escopo", "chave", "rede_descricao", "meta_alfabetizacao") == {
        ("municipio", "1", "Municipal", 50.0), ("municipio", "1", "Pública", 70.0),
        ("municipio", "1", "X", 1.0), ("municipio", "1", "Y", 1.0),
        ("brasil", "BR", "Pública", 80.0),
    }


def test_goal_of_year_takes_the_revision_of_that_year(results, goals):
    out = attach_goal_of_year(results, goals, MUNICIPALITY)
    assert out.count() == results.count()
    found = as_set(
        out.where("meta_alfabetizacao_do_ano IS NOT NULL"),
        "id_municipio", "serie", "rede", "meta_alfabetizacao_do_ano", "gap_meta_do_ano_pp",
    )
    assert found == {("1", 2, 3, 61.0, 0.0), ("1", 5, 3, 61.0, -11.0)}


def test_goal_of_year_of_the_country_has_no_place(results, goals):
    out = attach_goal_of_year(results, goals, COUNTRY)
    assert out.count() == results.count()
    assert as_set(
        out.where("meta_alfabetizacao_do_ano IS NOT NULL"), "rede", "meta_alfabetizacao_do_ano"
    ) == {(5, 70.0)}


def test_final_goal_has_the_opposite_sign(results, goals):
    out = attach_final_goal(results, goals, MUNICIPALITY, 2030)
    assert out.count() == results.count()
    assert as_set(
        out.where("meta_alfabetizacao_final IS NOT NULL"), "serie", "gap_para_meta_final_pp"
    ) == {(2, 29.0), (5, 40.0)}


def test_results_meet_goals_of_both_scopes(results, goals):
    out = goals_against_results(results, goals, MUNICIPALITY, COUNTRY)
    found = as_set(
        out, "id_municipio", "serie", "rede", "escopo_meta", "ano_meta", "gap_pp",
        "percentual_da_meta", "atingiu_meta", "meta_ja_vencida",
    )
    assert found == {
        ("1", 2, 3, "municipio", 2024, 0.0, 100.0, True, True),
        ("1", 2, 3, "municipio", 2030, -29.0, 100 * 61.0 / 90.0, False, False),
        ("1", 5, 3, "municipio", 2024, -11.0, 100 * 50.0 / 61.0, False, True),
        ("1", 5, 3, "municipio", 2030, -40.0, 100 * 50.0 / 90.0, False, False),
        ("1", 2, 5, "brasil", 2024, 1.0, 100 * 71.0 / 70.0, True, True),
        ("2", 2, 3, "municipio", 2025, 10.0, None, True, False),
    }


def test_two_equi_joins_equal_the_single_condition(results, goals):
    """The join written with alternatives in its condition finds the same pairs."""
    g = goals.withColumnsRenamed({"rede": "g_rede", "rede_descricao": "g_text"})
    either = results.where("taxa_alfabetizacao IS NOT NULL").join(
        g.where("escopo IN ('municipio', 'brasil')"),
        (results.rede == g.g_rede)
        & (results.ano_referencia == g.ano_publicacao)
        & (
            ((g.escopo == "brasil") & (g.chave == "BR"))
            | ((g.escopo != "brasil") & (g.chave == results.id_municipio))
        ),
    )
    mine = goals_against_results(results, goals, MUNICIPALITY, COUNTRY)
    columns = ["id_municipio", "serie", "rede", "ano_meta", "meta_alfabetizacao"]
    assert sorted(map(str, mine.select(*columns).collect())) == sorted(
        map(str, either.select(*columns).collect())
    )
