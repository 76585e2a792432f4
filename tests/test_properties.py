"""Random small inputs against brute force in plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lettera.model import NETWORK_GROUPS, IndicatorModel
from lettera.operators.clean import one_per_key
from lettera.operators.joins import left_lookup
from lettera.operators.rollup import additive_parts, roll_up
from lettera.operators.timeline import with_changes

few = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
pupil = st.tuples(
    st.sampled_from(["RS", "SP", None]), st.sampled_from([1, 2, 3, 4, 9, None]),
    st.sampled_from([0, 1, None]), st.sampled_from([0.0, 1.0, 2.0, 8.0, None]),
)


@few
@given(st.lists(st.tuples(keys, st.integers(0, 9)), min_size=1, max_size=30),
       st.sets(st.sampled_from(["a", "b", "z"])), st.sampled_from([0.01, 0.3, 0.99]))
def test_lookup(spark, fact_rows, known, hot_share):
    fact = spark.createDataFrame(fact_rows, "k string, v int")
    side = spark.createDataFrame([(k, k * 2) for k in known], "k string, a string")
    expected = sorted(((k, v, k * 2 if k in known else None) for k, v in fact_rows), key=str)
    for split in (True, False):
        out = left_lookup(fact, side, ["k"], split_hot=split, hot_factor=0.0, hot_share=hot_share)
        assert sorted((tuple(r) for r in out.collect()), key=str) == expected


@few
@given(st.lists(pupil, min_size=1, max_size=40))
def test_roll_up(spark, rows):
    pupils = spark.createDataFrame(
        rows, "uf string, rede int, alfabetizado int, peso_aluno double"
    )
    out = roll_up(additive_parts(pupils, ["uf", "rede"]), ["uf"], IndicatorModel())
    found = {(r["uf"], r["rede"]): r["taxa_alfabetizacao_calculada"] for r in out.collect()}

    expected = {}
    for place in {r[0] for r in rows}:
        for code, _, members in NETWORK_GROUPS:
            group = [r for r in rows if r[0] == place and r[1] in members]
            if not group:
                continue
            flagged = [r for r in group if r[2] is not None]
            weighted = [r for r in flagged if r[3] is not None]
            weight = sum(r[3] for r in weighted)
            if weight:
                rate = 100.0 * sum(r[2] * r[3] for r in weighted) / weight
            else:
                rate = 100.0 * sum(r[2] for r in flagged) / len(flagged) if flagged else None
            expected[(place, code)] = rate
    assert found == expected


@few
@given(st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.sampled_from("xyz"))), min_size=1, max_size=25))
def test_one_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k string, n int, s string")
    found = {r["k"]: (r["n"], r["s"]) for r in one_per_key(df, ["k"]).collect()}

    def rank(value):
        return (value is None, value if value is not None else 0)

    expected = {
        k: min(((n, s) for key, n, s in rows if key == k),
               key=lambda r: (rank(r[0]), (r[1] is None, r[1] or "")))
        for k in {r[0] for r in rows}
    }
    assert found == expected


@few
@given(st.dictionaries(
    st.tuples(st.sampled_from(["A", "B"]), st.integers(2020, 2027)),
    st.one_of(st.none(), st.integers(0, 100).map(float)), min_size=1, max_size=14))
def test_changes(spark, rates):
    df = spark.createDataFrame(
        [(p, y, r) for (p, y), r in rates.items()],
        "uf string, ano_referencia int, taxa_alfabetizacao double",
    )
    columns = ["ano_anterior", "taxa_ano_anterior", "taxa_primeiro_ano", "variacao_pp"]
    found = {
        (r["uf"], r["ano_referencia"]): tuple(r[c] for c in columns)
        for r in with_changes(df, ["uf"]).collect()
    }
    expected = {}
    for place in {p for p, _ in rates}:
        years = sorted(y for p, y in rates if p == place)
        known = [rates[place, y] for y in years if rates[place, y] is not None]
        for before, year in zip([None, *years], years):
            now = rates[place, year]
            then = rates.get((place, before))
            change = now - then if now is not None and then is not None else None
            expected[place, year] = (before, then, known[0] if known else None, change)
    assert found == expected
