import pytest
from pyspark.sql import functions as F

from lettera.functions import portable_bucket
from lettera.model import IndicatorModel
from lettera.operators.features import attach_year_before
from lettera.plans.gold import FEATURE_COLUMNS
from tests.conftest import as_set


@pytest.mark.parametrize("split", [True, False])
def test_context_is_last_years_and_of_the_same_grade(rows, split):
    pupils = rows(
        [("p", "1", 2024, 3, 2), ("q", "1", 2025, 3, 2), ("r", "1", 2025, 3, 5),
         ("s", "1", 2025, None, 2), ("t", "9", 2025, 3, 2)],
        "id_aluno string, id_municipio string, ano_referencia int, rede int, serie int",
    )
    published = rows(
        [("1", 2024, 3, 2, 50.0, 700.0), ("1", 2024, 3, 5, 60.0, 710.0),
         ("1", 2024, None, 2, 1.0, 1.0), ("1", 2025, 3, 2, 99.0, 1.0)],
        "id_municipio string, ano_referencia int, rede int, serie int, "
        "taxa_alfabetizacao double, media_portugues double",
    )
    out = attach_year_before(pupils, published, split_hot=split)
    assert out.count() == 5
    assert as_set(out, "id_aluno", "taxa_alfabetizacao_municipio_ano_anterior") == {
        ("p", None), ("q", 50.0), ("r", 60.0), ("s", None), ("t", None),
    }


def test_doubled_published_rows_repeat_no_pupil(rows):
    pupils = rows(
        [("q", "1", 2025, 3, 2)],
        "id_aluno string, id_municipio string, ano_referencia int, rede int, serie int",
    )
    published = rows(
        [("1", 2024, 3, 2, 50.0, 700.0), ("1", 2024, 3, 2, 60.0, 700.0)],
        "id_municipio string, ano_referencia int, rede int, serie int, "
        "taxa_alfabetizacao double, media_portugues double",
    )
    assert attach_year_before(pupils, published).count() == 1


def test_feature_table(workspace):
    features = workspace.features(portable_bucket)
    known = workspace.silver_pupils.where("alfabetizado IS NOT NULL")
    assert features.count() == known.count()
    assert features.columns == [*FEATURE_COLUMNS, "ano", "processed_at"]
    split = features.groupBy("dataset_split").count().collect()
    share = {r["dataset_split"]: r["count"] / features.count() for r in split}
    assert share["treino"] == pytest.approx(0.70, abs=0.03)
    assert share["validacao"] == pytest.approx(0.15, abs=0.03)
    assert share["teste"] == pytest.approx(0.15, abs=0.03)


def test_split_shares_must_fill_all_buckets():
    assert sum(share for _, share in IndicatorModel().splits) == 100


def test_same_pupil_same_part(workspace):
    a = workspace.features(portable_bucket).select("id_aluno", "dataset_split")
    b = workspace.features(portable_bucket).repartition(7).select("id_aluno", "dataset_split")
    assert a.exceptAll(b).count() == 0
    assert a.groupBy("id_aluno").agg(F.countDistinct("dataset_split").alias("n")) \
        .where("n > 1").count() == 0
