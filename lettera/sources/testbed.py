"""The test tables seen as literacy data, so that every operator has an input to run on.

Line items play the pupils, suppliers the municipalities, nations the states.  All sources
come out raw, the way the bronze layer has them: codes as text, identifiers with blanks, one
column per goal year.  Everything is derived from the whole tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettera.functions import weighted_rate
from lettera.model import GOAL_PREFIX, IndicatorModel
from lettera.operators.rollup import PARTS, into_network_groups
from lettera.session import as_written_table

# Years of the test tables in the role of the goal calendar.
CURRENT_YEAR = 2000
FINAL_YEAR = 2002
GOAL_YEARS = tuple(range(1996, FINAL_YEAR + 1))
PUBLICATION_YEARS = (1998, 1999, 2000, 2001)

MODEL = IndicatorModel(goal_years=GOAL_YEARS, final_goal_year=FINAL_YEAR)

LEVELS = range(9)

# Codes of the coded columns; network 4 is left out on purpose.
_DICTIONARY = [
    (table, column, code, text)
    for table in ("alunos", "municipio", "uf")
    for column, code, text in (
        ("rede", "0", "Total"),
        ("rede", " 2", "Estadual"),
        ("rede", "3 ", "Municipal"),
        ("rede", "5", "Pública"),
        ("serie", "2", " 2º ano "),
        ("serie", "5", "5º ano"),
        ("presenca", "1", "Presente"),
        ("presenca", "0", "Ausente"),
        ("preenchimento_caderno", "1", "Preenchido"),
        ("alfabetizado", "1", "Alfabetizado"),
        ("alfabetizado", "0", "Nao alfabetizado"),
    )
]


# Ingredients of a pupil record, as SQL over line items.
_NETWORK = "CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 ELSE 4 END"
_GRADE = "IF(l_linestatus = 'F', 2, 5)"
_FLAG = "IF(l_linenumber <> 7, CAST(l_discount >= 0.05 AS INT), NULL)"
_WEIGHT = "IF(l_suppkey % 10 <> 0, l_quantity, NULL)"
_LEVEL = "LEAST(CAST(ROUND(l_discount * 100) AS INT), 8)"


class Testbed:
    """Bronze tables made from the tables in one folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # -- pupils ------------------------------------------------------------------------

    def pupils(self) -> DataFrame:
        """Bronze ``alunos``."""
        return self.table("lineitem").selectExpr(
            "YEAR(l_shipdate) AS ano",
            "CONCAT(' ', l_suppkey, ' ') AS id_municipio",
            "CONCAT(l_partkey, ' ') AS id_escola",
            "CONCAT_WS('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id_aluno",
            "CAST(l_linenumber AS STRING) AS caderno",
            f"CAST({_GRADE} AS STRING) AS serie",
            f"CONCAT(' ', {_NETWORK}) AS rede",
            "CAST(CAST(l_tax >= 0.01 AS INT) AS STRING) AS presenca",
            "CAST(CAST(l_tax >= 0.04 AS INT) AS STRING) AS preenchimento_caderno",
            f"CAST({_FLAG} AS STRING) AS alfabetizado",
            "l_extendedprice AS proficiencia",
            f"{_WEIGHT} AS peso_aluno",
        )

    # -- published rates ---------------------------------------------------------------

    @cached_property
    def _published_parts(self) -> DataFrame:
        """Sums per supplier, year, grade and single network: the one read of the pupils.

        Written once, because both published tables and their composite networks need it.
        """
        lines = self.table("lineitem").selectExpr(
            "l_suppkey",
            "YEAR(l_shipdate) AS ano",
            f"{_GRADE} AS serie",
            f"{_NETWORK} AS rede",
            f"{_FLAG} AS alfabetizado",
            f"{_WEIGHT} AS peso_aluno",
            "CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS centavos",
            f"{_LEVEL} AS nivel",
        )
        keys = ["l_suppkey", "ano", "serie", "rede"]
        parts = lines.groupBy(*keys).agg(
            F.expr("SUM(alfabetizado * peso_aluno) AS peso_alfabetizado"),
            F.expr("SUM(IF(alfabetizado IS NOT NULL, peso_aluno, NULL)) AS peso_conhecido"),
            F.expr("SUM(CAST(alfabetizado AS DOUBLE)) AS alfabetizados"),
            F.expr("COUNT(alfabetizado) AS qtd_alunos"),
            F.expr("COUNT(*) AS linhas"),
            F.expr("SUM(centavos) AS centavos"),
            *[F.expr(f"COUNT_IF(nivel = {n}) AS nivel_{n}") for n in LEVELS],
        )
        return as_written_table(parts, "published-parts")

    def _published(self, parts: DataFrame, key: str, shown_key: str) -> DataFrame:
        sums = [*PARTS, "linhas", "centavos", *[f"nivel_{n}" for n in LEVELS]]
        summed = (
            into_network_groups(parts, MODEL)
            .groupBy(key, "ano", "serie", "rede")
            .agg(*[F.expr(f"SUM({c}) AS {c}") for c in sums])
        )
        return summed.select(
            "ano",
            F.expr(shown_key),
            F.expr("CAST(serie AS STRING) AS serie"),
            F.expr("CAST(rede AS STRING) AS rede"),
            weighted_rate(*[F.col(c) for c in PARTS]).alias("taxa_alfabetizacao"),
            F.expr("centavos / linhas / 100D AS media_portugues"),
            *[
                F.expr(f"100D * nivel_{n} / linhas AS proporcao_aluno_nivel_{n}")
                for n in LEVELS
            ],
        )

    def published_municipalities(self) -> DataFrame:
        """Bronze ``municipio``."""
        return self._published(
            self._published_parts, "l_suppkey", "CONCAT(l_suppkey, ' ') AS id_municipio"
        )

    def published_states(self) -> DataFrame:
        """Bronze ``uf``."""
        nations = self.table("supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey")
        by_nation = (
            self._published_parts.join(nations, "l_suppkey")
            .join(F.broadcast(self._nation_names()), "s_nationkey")
        )
        return self._published(by_nation, "sigla_uf", "sigla_uf")

    def _nation_names(self) -> DataFrame:
        """Nations are 25 at every scale."""
        return self.table("nation").selectExpr(
            "n_nationkey AS s_nationkey", "CONCAT(' ', LOWER(n_name), ' ') AS sigla_uf"
        )

    # -- dimensions --------------------------------------------------------------------

    def localities(self) -> DataFrame:
        """Bronze ``municipio_ibge``: some municipalities are missing, one is there twice."""
        copies = "EXPLODE(IF(s_suppkey = 1, ARRAY('', ' (copia)'), ARRAY(''))) AS copia"
        return (
            self.table("supplier")
            .where("s_suppkey % 20 <> 19")
            .join(F.broadcast(self._nation_names()), "s_nationkey")
            .selectExpr("s_suppkey", "s_name", "sigla_uf", copies)
            .selectExpr(
                "CONCAT(' ', s_suppkey) AS id_municipio",
                "CONCAT(s_name, copia) AS nome_municipio",
                "sigla_uf",
            )
        )

    def locality_documents(self) -> DataFrame:
        """Localities as nested JSON text."""
        return (
            self.table("supplier")
            .join(
                F.broadcast(self.table("nation")),
                F.col("s_nationkey") == F.col("n_nationkey"),
            )
            .selectExpr(
                "TO_JSON(NAMED_STRUCT('id', s_suppkey, 'nome', s_name, 'microrregiao', "
                "NAMED_STRUCT('mesorregiao', NAMED_STRUCT('UF', "
                "NAMED_STRUCT('sigla', n_name))))) AS value"
            )
        )

    def dictionary(self) -> DataFrame:
        """Bronze ``dicionario``."""
        rows = ", ".join(f"('{t}', '{c}', '{k}', '1', '{v}')" for t, c, k, v in _DICTIONARY)
        return self.spark.sql(
            f"SELECT * FROM VALUES {rows} "
            "AS d(id_tabela, nome_coluna, chave, cobertura_temporal, valor)"
        )

    # -- goals -------------------------------------------------------------------------

    @staticmethod
    def _wide_goals(places: DataFrame, base: str, key: list[str], text: str) -> DataFrame:
        years = ", ".join(str(y) for y in PUBLICATION_YEARS)
        return places.selectExpr(
            "*", f"{base} AS _base", f"EXPLODE(ARRAY({years})) AS ano"
        ).selectExpr(
            "ano",
            *key,
            f"{text} AS rede",
            "CAST(_base AS DOUBLE) AS taxa_alfabetizacao",
            *[
                f"IF(ano <= {y}, CAST(_base + 3 * ({y} - 1995) + (ano - 1998) * 0.5D "
                f"AS DOUBLE), NULL) AS {GOAL_PREFIX}{y}"
                for y in GOAL_YEARS
            ],
            "CAST(_base + 40 AS DOUBLE) AS percentual_participacao",
        )

    def goals_municipalities(self) -> DataFrame:
        """Bronze ``meta_alfabetizacao_municipio``."""
        return self._wide_goals(
            self.table("supplier"),
            "40 + s_suppkey % 15",
            ["CONCAT(' ', s_suppkey) AS id_municipio", "1 AS nivel_alfabetizacao"],
            "IF(s_suppkey % 25 = 24, 'Outra', ' Municipal ')",
        )

    def goals_states(self) -> DataFrame:
        """Bronze ``meta_alfabetizacao_uf``."""
        return self._wide_goals(
            self.table("nation"),
            "40 + n_nationkey % 15",
            ["CONCAT(LOWER(n_name), ' ') AS sigla_uf"],
            "'Pública'",
        )

    def goals_country(self) -> DataFrame:
        """Bronze ``meta_alfabetizacao_brasil``."""
        country = self.table("nation").agg(F.max("n_nationkey").alias("_last"))
        return self._wide_goals(country, "40 + _last % 15", [], "'Pública'")

    # -- events ------------------------------------------------------------------------

    def goal_events(self, events: DataFrame | None = None) -> DataFrame:
        """Events as JSON envelopes of every shape, good and bad (``event_id``, ``value``).

        ``events`` are those of the table, as they are or dealt in another way.
        """
        year = "CAST(1998 + event_id % 4 AS INT)"
        goals = ", ".join(
            f"'{GOAL_PREFIX}{y}', IF({year} < {y}, CAST(value + {y} - 1995 AS STRING), NULL)"
            for y in GOAL_YEARS
        )
        network = (
            "CASE event_type WHEN 'view' THEN ' Municipal' WHEN 'error' THEN 'Outra' "
            "ELSE 'Pública' END"
        )
        goal = (
            f"TO_JSON(MAP_FILTER(MAP('ano', CAST({year} AS STRING), 'rede', {network}, "
            f"'taxa_alfabetizacao', CAST(value AS STRING), {goals}), "
            "(k, v) -> v IS NOT NULL)) AS _goal"
        )
        listed = """CONCAT('{"metas":[', _goal, ']}')"""
        envelope = f"""CASE user_id % 9
            WHEN 0 THEN CONCAT('{{"version":"0","detail":{{"detail":[', _goal, ']}}}}')
            WHEN 1 THEN {listed}
            WHEN 2 THEN CONCAT('{{"metas":', _goal, '}}')
            WHEN 3 THEN _goal
            WHEN 4 THEN CONCAT('{{"version":"0","detail":[', _goal, ']}}')
            WHEN 5 THEN TO_JSON(NAMED_STRUCT('body', {listed}))
            WHEN 6 THEN '{{}}'
            WHEN 7 THEN '{{"metas":"nada"}}'
            ELSE '{{"metas":[]}}' END AS value"""
        return (
            (self.table("events") if events is None else events)
            .selectExpr("event_id", "user_id", goal)
            .selectExpr("event_id", envelope)
        )
