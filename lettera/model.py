"""Names, codes and shapes of the literacy-indicator data model.

The values under "fixed values" have to be spelled exactly like this: they are column
names, codes and labels that appear in the data.  Everything that may differ between
deployments sits in :class:`IndicatorModel`, so that the same operators serve other years,
other networks or other code lists.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values -------------------------------------------------------------------

SCOPE_MUNICIPALITY = "municipio"
SCOPE_STATE = "uf"
SCOPE_COUNTRY = "brasil"

COUNTRY_KEY = "BR"

ORIGIN_PUBLISHED = "inep_publicado"
ORIGIN_COMPUTED = "calculado_microdado"

UNMAPPED = "Nao informado"

GOAL_PREFIX = "meta_alfabetizacao_"

# Text of the network in the goal tables -> code used everywhere else.
NETWORK_CODES = {"Pública": 5, "Municipal": 3}

# Pupil records carry networks 1-4.  Composite networks add their members up; network 1 is
# absent from the pupil records, so network 0 is short of the federal pupils.
NETWORK_GROUPS = (
    (0, "Total (Federal, Estadual, Municipal e Privada)", (1, 2, 3, 4)),
    (5, "Pública (Estadual e Municipal)", (2, 3)),
    (2, "Estadual", (2,)),
    (3, "Municipal", (3,)),
    (4, "Privada", (4,)),
)

# Share of the hundred hash buckets that each part of the feature table gets.
SPLITS = (("treino", 70), ("validacao", 15), ("teste", 15))

# Columns that each silver table must deliver to the gold step.
REQUIRED_STATE = (
    "sigla_uf", "ano_referencia", "serie", "serie_descricao", "rede", "rede_descricao",
    "taxa_alfabetizacao", "media_portugues",
)
REQUIRED_MUNICIPALITY = (
    "id_municipio", "nome_municipio", "sigla_uf", "ano_referencia", "serie",
    "serie_descricao", "rede", "rede_descricao", "taxa_alfabetizacao", "media_portugues",
)
REQUIRED_GOALS = (
    "escopo", "chave", "rede", "ano_publicacao", "ano_meta", "meta_alfabetizacao",
)
REQUIRED_PUPILS = (
    "id_aluno", "id_escola", "id_municipio", "nome_municipio", "sigla_uf",
    "ano_referencia", "serie", "serie_descricao", "rede", "rede_descricao", "caderno",
    "presenca", "preenchimento_caderno", "alfabetizado", "proficiencia", "peso_aluno",
)

# Warehouse tables copied by the snapshot.
SNAPSHOT_TABLES = (
    "municipio", "dicionario", "meta_alfabetizacao_brasil",
    "meta_alfabetizacao_municipio", "meta_alfabetizacao_uf", "alunos", "uf",
)

# ---- shapes -------------------------------------------------------------------------


@dataclass(frozen=True)
class Level:
    """One geographic level of the gold layer.

    ``few_rows`` marks the levels whose report tables are a handful of rows per year (27
    states, one country) and are stored in one file per year.
    """

    scope: str
    key: str | None
    id_columns: tuple[str, ...]
    few_rows: bool

    @property
    def keys(self) -> list[str]:
        return [self.key] if self.key else []


MUNICIPALITY = Level(
    SCOPE_MUNICIPALITY, "id_municipio", ("id_municipio", "nome_municipio", "sigla_uf"), False
)
STATE = Level(SCOPE_STATE, "sigla_uf", ("sigla_uf",), True)
COUNTRY = Level(SCOPE_COUNTRY, None, (), True)


@dataclass(frozen=True)
class IndicatorModel:
    """What may change from one deployment to the next."""

    goal_years: tuple[int, ...] = tuple(range(2024, 2031))
    final_goal_year: int = 2030
    network_codes: dict[str, int] = field(default_factory=lambda: dict(NETWORK_CODES))
    network_groups: tuple = NETWORK_GROUPS
    splits: tuple = SPLITS

    def memberships(self) -> dict[int, list[int]]:
        """Member network -> the networks it counts towards, itself included."""
        found: dict[int, list[int]] = {}
        for code, _, members in self.network_groups:
            for member in members:
                found.setdefault(member, []).append(code)
        return found

    def labels(self) -> dict[int, str]:
        return {code: label for code, label, _ in self.network_groups}
