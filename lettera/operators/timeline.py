"""Change over time within one series (place, network, grade)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettera.functions import guarded_percent_change


def with_changes(
    df: DataFrame,
    series: Sequence[str],
    year: str = "ano_referencia",
    rate: str = "taxa_alfabetizacao",
) -> DataFrame:
    """Previous observed year, its rate, and the first known rate of the series.

    A series has one row per year, so a window group stays as small as the number of years.
    All three windows share one shuffle and one sort.
    """
    so_far = Window.partitionBy(*series).orderBy(year)
    whole = so_far.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    now, before = F.col(rate), F.col("taxa_ano_anterior")
    return (
        df.withColumns({
            "ano_anterior": F.lag(year).over(so_far),
            "taxa_ano_anterior": F.lag(rate).over(so_far),
            "taxa_primeiro_ano": F.first(rate, ignorenulls=True).over(whole),
        })
        .withColumns({
            "variacao_pp": now - before,
            "variacao_percentual": guarded_percent_change(now, before),
            "variacao_acumulada_pp": now - F.col("taxa_primeiro_ano"),
        })
    )
