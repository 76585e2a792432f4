import pytest

from lettera.operators.timeline import with_changes

SCHEMA = "uf string, rede int, serie int, ano_referencia int, taxa_alfabetizacao double"
COLUMNS = [
    "ano_referencia", "ano_anterior", "taxa_ano_anterior", "taxa_primeiro_ano",
    "variacao_pp", "variacao_percentual", "variacao_acumulada_pp",
]


def changes(df, series=("uf", "rede", "serie")):
    out = with_changes(df, list(series)).orderBy("uf", "ano_referencia")
    return [tuple(r) for r in out.select(*COLUMNS).collect()]


def test_previous_year_is_the_previous_observed_one(rows):
    df = rows([("A", 3, 2, 2023, 40.0), ("A", 3, 2, 2025, 50.0)], SCHEMA)
    assert changes(df) == [
        (2023, None, None, 40.0, None, None, 0.0),
        (2025, 2023, 40.0, 40.0, 10.0, 25.0, 10.0),
    ]


def test_first_known_rate_skips_missing_ones(rows):
    df = rows(
        [("A", 3, 2, 2023, None), ("A", 3, 2, 2024, 0.0), ("A", 3, 2, 2025, 30.0)], SCHEMA
    )
    assert changes(df) == [
        (2023, None, None, 0.0, None, None, None),
        (2024, 2023, None, 0.0, None, None, 0.0),
        (2025, 2024, 0.0, 0.0, 30.0, None, 30.0),
    ]


def test_series_do_not_mix(rows):
    df = rows([("A", 3, 2, 2023, 40.0), ("B", 3, 2, 2024, 50.0), ("C", 3, 5, 2024, 1.0)], SCHEMA)
    assert [c[1] for c in changes(df)] == [None, None, None]


@pytest.mark.parametrize("series", [("uf", "rede", "serie"), ("rede", "serie")])
def test_one_shuffle_and_one_sort(rows, series):
    df = rows([("A", 3, 2, 2023, 40.0)], SCHEMA)
    plan = with_changes(df, list(series))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
