"""One named query per operator, table and report, each over the whole test tables.

A query takes ``(spark, folder)`` and returns a DataFrame.  Columns that change from run to
run (time stamps) are left out, so that results can be compared.

Gold tables and reports read stored layers, as they do in production: the first of them in a
session runs the pipeline over the folder once, the others find its tables.  The queries of
sources, silver and single operators start from the given tables.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettera.functions import (
    code_of,
    murmur_bucket,
    portable_bucket,
    to_double,
    to_int,
)
from lettera.model import (
    COUNTRY,
    MUNICIPALITY,
    REQUIRED_MUNICIPALITY,
    REQUIRED_PUPILS,
    REQUIRED_STATE,
    SCOPE_STATE,
    SNAPSHOT_TABLES,
    STATE,
    UNMAPPED,
)
from lettera.operators import quality
from lettera.operators.clean import drop_duplicate_rows, normalize_ids, one_per_key, typed
from lettera.operators.compare import attach_reference_rate, attach_volume
from lettera.operators.features import attach_year_before, split_label
from lettera.operators.goals import (
    attach_final_goal,
    attach_goal_of_year,
    goals_against_results,
    union_goals,
    unpivot_goals,
)
from lettera.operators.lookup import decode, enrich
from lettera.operators.rollup import additive_parts, pupil_volume, roll_up
from lettera.operators.timeline import with_changes
from lettera.plans import gold, pipeline, reports, silver
from lettera.session import as_written_table, scratch_folder
from lettera.sources.locality import LOCALITY_SCHEMA, flatten_localities
from lettera.sources.readers import (
    describe_columns,
    first_rows,
    layer_inventory,
    list_objects,
    scan,
    snapshot,
    table_sizes,
)
from lettera.sources.testbed import CURRENT_YEAR, FINAL_YEAR, MODEL, Testbed
from lettera.sources.writers import register_tables, replace_partitions, write_partitioned
from lettera.streaming import goal_events as stream

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

YEAR_GRADE = ["ano_referencia", "serie"]

# Lines of an event file: what a producer gathers before it hands a file over.
EVENTS_PER_FILE = 20_000
# Micro-batches of a run over all events: they grow with the events, their number doesn't.
EVENT_BATCHES = 5

# The stored layers of each folder, by session.
LAKES: dict[tuple[str, str], pipeline.Layers] = {}


class Workspace(Testbed):
    """Silver and gold tables over one folder, built on demand."""

    @cached_property
    def silver_pupils(self) -> DataFrame:
        return silver.silver_pupils(self.pupils(), self.dictionary(), self.localities())

    @cached_property
    def silver_municipality(self) -> DataFrame:
        return silver.silver_municipality(
            self.published_municipalities(), self.dictionary(), self.localities()
        )

    @cached_property
    def silver_state(self) -> DataFrame:
        return silver.silver_state(self.published_states(), self.dictionary())

    @cached_property
    def silver_goals(self) -> DataFrame:
        return silver.silver_goals(
            self.goals_states(), self.goals_municipalities(), self.goals_country(), MODEL
        )

    # -- stored layers -----------------------------------------------------------------

    def sources(self) -> dict[str, DataFrame]:
        return {
            "alunos": self.pupils(), "municipio": self.published_municipalities(),
            "uf": self.published_states(), "dicionario": self.dictionary(),
            "meta_alfabetizacao_brasil": self.goals_country(),
            "meta_alfabetizacao_municipio": self.goals_municipalities(),
            "meta_alfabetizacao_uf": self.goals_states(),
            "municipio_ibge": self.localities(),
        }

    def new_lake(self) -> pipeline.Layers:
        """Empty layers in a folder of their own, with bronze filled."""
        root = scratch_folder(self.spark, "lake")
        layers = pipeline.Layers(f"{root}/bronze", f"{root}/silver", f"{root}/gold")
        pipeline.load_bronze(self.sources(), layers)
        return layers

    def full_lake(self) -> pipeline.Layers:
        """All layers but the feature table, which no question reads."""
        layers = self.new_lake()
        pipeline.build_silver(self.spark, layers, MODEL)
        pipeline.build_parts(self.spark, layers)
        pipeline.build_goal_dependent(self.spark, layers, MODEL)
        return layers

    @property
    def layers(self) -> pipeline.Layers:
        """The one set of stored layers of this folder and session.

        The given tables are taken to stay as they are while the session lasts.
        """
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in LAKES:
            LAKES[key] = self.full_lake()
        return LAKES[key]

    def silver_table(self, name: str) -> DataFrame:
        return scan(self.spark, f"{self.layers.silver}/{name}")

    def gold_table(self, kind: str, level) -> DataFrame:
        return scan(self.spark, f"{self.layers.gold}/{kind}_{level.scope}")

    @property
    def parts(self) -> DataFrame:
        return self.silver_table("partes_alunos")

    @property
    def goals(self) -> DataFrame:
        return self.silver_table("meta_alfabetizacao")

    # -- gold, each table from the stored ones it is made of ----------------------------

    @property
    def country(self) -> DataFrame:
        return gold.indicator_country(self.parts, self.goals, MODEL)

    @property
    def state(self) -> DataFrame:
        return gold.indicator_state(
            self.silver_table("uf"), self.parts, self.goals,
            self.gold_table("indicador", COUNTRY), MODEL,
        )

    @property
    def municipality(self) -> DataFrame:
        return gold.indicator_municipality(
            self.silver_table("municipio"), self.parts, self.goals,
            self.gold_table("indicador", STATE), self.gold_table("indicador", COUNTRY), MODEL,
        )

    def comparison(self, level) -> DataFrame:
        return gold.goal_comparison(self.gold_table("indicador", level), self.goals, level)

    def evolution(self, level) -> DataFrame:
        return gold.evolution(self.gold_table("indicador", level), self.goals, level, MODEL)

    def features(self, bucket) -> DataFrame:
        return gold.pupil_features(
            self.silver_table("alunos"), self.silver_table("municipio"), MODEL, bucket=bucket
        )

    # -- events --------------------------------------------------------------------------

    def drop_events(self, folder: str) -> int:
        """Numbered deliveries, one file each, with the events in the order of their ids.

        One job deals and writes them all; returns how many there are.
        """
        events = self.table("events")
        files = max(1, -(-events.count() // EVENTS_PER_FILE))
        (
            self.goal_events(events.repartitionByRange(files, "event_id"))
            .withColumn("entrega", F.spark_partition_id())
            .sortWithinPartitions("entrega", "event_id").select("value", "entrega")
            .write.partitionBy("entrega").text(folder)
        )
        return files

    def run_events(self, root: str | None = None, refresh=None):
        """The finished run over all events, and the goals it stored below ``root``."""
        root = root or scratch_folder(self.spark, "events")
        received = f"{root}/received"
        files = self.drop_events(f"{root}/incoming")
        run = stream.start_goal_stream(
            stream.read_goal_events(
                self.spark, f"{root}/incoming", files_per_batch=-(-files // EVENT_BATCHES)
            ),
            received, f"{root}/quarantine", f"{root}/checkpoint", refresh,
        )
        run.awaitTermination()
        return run, stream.read_received(self.spark, received)


BUILDERS: dict[str, Callable[[Workspace], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register a function of a workspace under a name."""

    def register(build: Callable[[Workspace], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return BUILDERS[name](Workspace(spark, folder.rstrip("/")))

        BUILDERS[name] = lambda workspace: build(workspace).drop("processed_at")
        QUERIES[name] = run
        return build

    return register


# ---- sources ------------------------------------------------------------------------


@query("scan_parquet")
def _(w):
    return w.table("lineitem")


@query("scan_projected")
def _(w):
    return scan(
        w.spark, f"{w.folder}/lineitem.parquet", ["l_suppkey", "l_returnflag", "l_quantity"]
    )


def _partitioned_pupils(w: Workspace) -> str:
    path = scratch_folder(w.spark, "pupils-by-year")
    pupils = typed(normalize_ids(w.pupils(), ["id_municipio", "id_aluno"]), ["serie", "rede"])
    kept = pupils.select(
        "id_municipio", "id_aluno", "serie", "rede", "peso_aluno", "ano",
        F.col("ano").alias("ano_referencia"),
    )
    write_partitioned(kept, path, ["ano"])
    return path


@query("scan_partition_pruned")
def _(w):
    path = _partitioned_pupils(w)
    return scan(
        w.spark, path, ["ano", "id_municipio", "id_aluno", "peso_aluno"],
        F.col("ano") == CURRENT_YEAR,
    )


@query("head_sample")
def _(w):
    """How many rows the sample has, and how many of them the table does not know."""
    sample = first_rows(w.pupils().select("id_aluno", "id_municipio", "ano"), 5000)
    known = w.pupils().select("id_aluno").distinct().withColumn("conhecido", F.lit(True))
    return sample.join(known, "id_aluno", "left").agg(
        F.count(F.lit(1)).alias("registros"),
        F.count_if(F.col("conhecido").isNull()).alias("fora_da_tabela"),
    )


@query("snapshot_tables")
def _(w):
    bronze = scratch_folder(w.spark, "bronze")
    snapshot(w.sources().__getitem__, SNAPSHOT_TABLES, bronze)
    return table_sizes({t: scan(w.spark, f"{bronze}/{t}") for t in SNAPSHOT_TABLES})


@query("json_flatten")
def _(w):
    raw = w.locality_documents().select(F.from_json("value", LOCALITY_SCHEMA).alias("v"))
    return flatten_localities(raw.select("v.*"))


@query("layer_inventory")
def _(w):
    return table_sizes({t: w.table(t) for t in TABLES})


@query("list_objects")
def _(w):
    """Datasets of the given folder and their files, from the listing alone."""
    found = layer_inventory(w.spark, w.folder)
    names = F.regexp_replace("conjunto", r"\.parquet$", "")
    return found.where(names.isin(*TABLES)).select(
        names.alias("conjunto"), (F.col("bytes") > 0).alias("tem_dados")
    )


@query("describe_columns")
def _(w):
    return describe_columns(w.table("lineitem")).select("posicao", "coluna", "tipo")


# ---- sinks --------------------------------------------------------------------------


@query("write_partitioned")
def _(w):
    return scan(w.spark, _partitioned_pupils(w))


@query("write_single_file")
def _(w):
    path = scratch_folder(w.spark, "one-file")
    write_partitioned(w.silver_state, path, ["ano"], one_file=True)
    files = scan(w.spark, path).select("ano", F.col("_metadata.file_path").alias("f"))
    return files.groupBy("ano").agg(
        F.countDistinct("f").alias("arquivos"), F.count(F.lit(1)).alias("registros")
    )


@query("write_scope")
def _(w):
    """Goals of one scope written anew, a half point up; ``mantido``: from a file that stayed."""
    path = scratch_folder(w.spark, "goals-by-scope")
    goals = write_partitioned(w.silver_goals, path, ["escopo"])

    def file(path):
        """Folder and name: one task gives the files of several folders the same name."""
        return F.substring_index(path, "/", -2).alias("arquivo")

    before = as_written_table(list_objects(w.spark, path).select(file("path")), "files")
    raised = w.silver_goals.withColumn("meta_alfabetizacao", F.col("meta_alfabetizacao") + 0.5)
    replace_partitions(raised, path, "escopo", [SCOPE_STATE])
    return (
        scan(w.spark, path).select(*goals.columns, file("_metadata.file_path"))
        .join(before.withColumn("mantido", F.lit(True)), "arquivo", "left")
        .select(*goals.columns, F.coalesce("mantido", F.lit(False)).alias("mantido"))
    )


@query("register_tables")
def _(w):
    root = scratch_folder(w.spark, "gold")
    write_partitioned(w.country, f"{root}/indicador_brasil", ["ano"], one_file=True)
    database = "lettera_" + root.rsplit("-", 1)[-1]
    [name] = register_tables(
        w.spark, database, {"indicador_brasil": f"{root}/indicador_brasil"}, root
    )
    return w.spark.table(name)


# ---- projections and filters --------------------------------------------------------


@query("normalize_ids")
def _(w):
    places = w.localities().select("id_municipio", "sigla_uf")
    return normalize_ids(places, ids=["id_municipio"], states=["sigla_uf"])


@query("typed_cast")
def _(w):
    mixed = w.table("lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("string").alias("decimal"),
        F.concat(F.lit(" "), F.col("l_linenumber"), F.lit(" ")).alias("com_brancos"),
        F.col("l_discount").cast("string").alias("fracao"),
        F.col("l_returnflag").alias("texto"),
    )
    names = ["decimal", "com_brancos", "fracao", "texto"]
    return mixed.select(
        "l_orderkey", "l_linenumber",
        *[to_int(F.col(c)).alias(f"{c}_int") for c in names],
        *[to_double(F.col(c)).alias(f"{c}_double") for c in names],
    )


@query("code_lookup")
def _(w):
    codes = w.pupils().select("id_aluno", "rede", "serie", "presenca")
    return decode(
        codes, w.dictionary(), "alunos",
        {"rede": "rede_descricao", "serie": "serie_descricao",
         "presenca": "presenca_descricao"},
    )


@query("text_to_code")
def _(w):
    goals = w.goals_municipalities()
    return goals.groupBy("rede", code_of(F.col("rede"), MODEL.network_codes).alias("codigo")) \
        .agg(F.count(F.lit(1)).alias("registros"))


@query("processing_stamp")
def _(w):
    """Of a written table: its rows, their different time stamps, and whether those are of now."""
    begin = datetime.datetime.now(datetime.timezone.utc)
    written = as_written_table(w.silver_state, "uf")
    return written.agg(
        F.count(F.lit(1)).alias("registros"),
        F.count_distinct("processed_at").alias("carimbos"),
        (F.min("processed_at") >= F.lit(begin)).alias("depois_do_inicio"),
        (F.max("processed_at") <= F.current_timestamp()).alias("antes_do_fim"),
    )


@query("filter_not_null")
def _(w):
    pupils = typed(w.pupils(), ["alfabetizado"])
    return pupils.where(F.col("alfabetizado").isNotNull()).select("id_aluno", "alfabetizado")


@query("filter_point")
def _(w):
    return w.silver_state.where(F.col("sigla_uf") == "NATION_7").select(
        "sigla_uf", "ano", "serie", "rede", "rede_descricao", "taxa_alfabetizacao"
    )


@query("split_portable")
def _(w):
    ids = w.pupils().select("id_aluno")
    return ids.select(
        "id_aluno",
        portable_bucket(F.col("id_aluno")).alias("faixa"),
        split_label(F.col("id_aluno"), MODEL.splits, portable_bucket).alias("dataset_split"),
    )


@query("split_murmur")
def _(w):
    ids = w.pupils().select("id_aluno")
    return ids.select(
        "id_aluno",
        murmur_bucket(F.col("id_aluno")).alias("faixa"),
        split_label(F.col("id_aluno"), MODEL.splits).alias("dataset_split"),
    )


# ---- goals --------------------------------------------------------------------------


@query("goal_unpivot")
def _(w):
    return unpivot_goals(w.goals_municipalities(), MUNICIPALITY, MODEL)


@query("goal_long_union")
def _(w):
    return union_goals(
        [(w.goals_states(), STATE), (w.goals_municipalities(), MUNICIPALITY),
         (w.goals_country(), COUNTRY)],
        MODEL,
    )


def _rates(df: DataFrame, level) -> DataFrame:
    return df.select(*level.keys, *YEAR_GRADE, "rede", "taxa_alfabetizacao")


@query("goal_of_year")
def _(w):
    rates = _rates(w.silver_municipality, MUNICIPALITY)
    return attach_goal_of_year(rates, w.silver_goals, MUNICIPALITY)


@query("goal_of_year_total")
def _(w):
    rates = roll_up(w.parts, YEAR_GRADE, MODEL).withColumnRenamed(
        "taxa_alfabetizacao_calculada", "taxa_alfabetizacao"
    )
    return attach_goal_of_year(_rates(rates, COUNTRY), w.silver_goals, COUNTRY)


@query("goal_vs_result")
def _(w):
    """Both scopes at once, on published municipality rates."""
    rates = w.silver_municipality.select(
        "*",
        F.lit(MUNICIPALITY.scope).alias("nivel_geografico"),
        F.lit(None).cast("bigint").alias("qtd_alunos"),
        F.lit("publicado").alias("origem_indicador"),
    )
    return goals_against_results(rates, w.silver_goals, MUNICIPALITY, COUNTRY)


@query("final_goal_gap")
def _(w):
    rates = _rates(w.silver_state, STATE)
    return attach_final_goal(rates, w.silver_goals, STATE, FINAL_YEAR)


# ---- joins --------------------------------------------------------------------------


@query("dim_enrich")
def _(w):
    localities = w.localities()
    pupils = normalize_ids(w.pupils().select("id_aluno", "id_municipio"), ["id_municipio"])
    return enrich(pupils, localities, "id_municipio", ["nome_municipio", "sigla_uf"])


@query("dim_enrich_large")
def _(w):
    """With hot keys apart: places above the mean take one way, the others the other."""
    pupils = normalize_ids(w.pupils().select("id_aluno", "id_municipio"), ["id_municipio"])
    return enrich(
        as_written_table(pupils, "alunos"), as_written_table(w.localities(), "municipio_ibge"),
        "id_municipio", ["nome_municipio", "sigla_uf"], split_hot=True, hot_factor=1.0,
    )


@query("attach_volume")
def _(w):
    volume = pupil_volume(w.parts, ["id_municipio", *YEAR_GRADE], MODEL)
    return attach_volume(_rates(w.silver_municipality, MUNICIPALITY), volume, MUNICIPALITY)


@query("compare_to_parent")
def _(w):
    rates = w.silver_municipality.select(
        "id_municipio", "sigla_uf", *YEAR_GRADE, "rede", "taxa_alfabetizacao"
    )
    states = as_written_table(w.silver_state, "uf")
    return attach_reference_rate(rates, states, ["sigla_uf"], "uf")


@query("compare_to_parent_large")
def _(w):
    """With hot keys apart: cuts of a state above the mean take one way, the others the other."""
    rates = w.silver_municipality.select(
        "id_municipio", "sigla_uf", *YEAR_GRADE, "rede", "taxa_alfabetizacao"
    )
    return attach_reference_rate(
        as_written_table(rates, "municipio"), as_written_table(w.silver_state, "uf"),
        ["sigla_uf"], "uf", split_hot=True, hot_factor=1.0,
    )


@query("compare_to_total")
def _(w):
    return attach_reference_rate(_rates(w.silver_state, STATE), w.country, [], "brasil")


@query("prior_year_context")
def _(w):
    """With hot keys apart: cuts of a place above the mean take one way, the others the other."""
    pupils = typed(normalize_ids(w.pupils(), ["id_aluno", "id_municipio"]), ["rede", "serie"])
    keyed = pupils.select(
        "id_aluno", "id_municipio", F.col("ano").alias("ano_referencia"), "rede", "serie"
    )
    published = as_written_table(w.silver_municipality, "municipio")
    return attach_year_before(
        as_written_table(keyed, "alunos"), published, split_hot=True, hot_factor=1.0
    )


# ---- aggregations -------------------------------------------------------------------


@query("additive_parts")
def _(w):
    return additive_parts(w.silver_pupils)


@query("overlapping_rollup")
def _(w):
    return roll_up(w.parts, ["id_municipio", *YEAR_GRADE], MODEL)


@query("rollup_state")
def _(w):
    return roll_up(w.parts, ["sigla_uf", *YEAR_GRADE], MODEL)


@query("rollup_total")
def _(w):
    return roll_up(w.parts, [*YEAR_GRADE, "serie_descricao"], MODEL)


@query("weighted_rate")
def _(w):
    """Rates of all network groups: weighted where weights exist, simple elsewhere."""
    grain = ["id_municipio", *YEAR_GRADE, "rede"]
    return roll_up(additive_parts(w.silver_pupils, grain), ["id_municipio"], MODEL)


@query("count_by_key")
def _(w):
    return quality.count_by_key(w.silver_pupils, ["sigla_uf", "ano"])


@query("count_distinct")
def _(w):
    return quality.count_distinct(
        w.silver_table("alunos"), ["id_aluno", "id_municipio", "id_escola"]
    )


@query("percentiles")
def _(w):
    rates = w.silver_municipality
    tails = F.percentile_approx("taxa_alfabetizacao", [0.1, 0.5, 0.9])
    return (
        rates.groupBy("sigla_uf", "serie")
        .agg(tails.alias("p"))
        .select(
            "sigla_uf", "serie",
            F.col("p")[0].alias("p10"), F.col("p")[1].alias("p50"),
            F.col("p")[2].alias("p90"),
        )
    )


@query("label_share")
def _(w):
    label = split_label(F.col("id_aluno"), MODEL.splits, portable_bucket)
    return quality.label_share(w.pupils().select(label.alias("dataset_split")), "dataset_split")


# ---- windows ------------------------------------------------------------------------


@query("yoy_change")
def _(w):
    changed = with_changes(_rates(w.silver_municipality, MUNICIPALITY),
                           ["id_municipio", "rede", "serie"])
    return changed.drop("taxa_primeiro_ano", "variacao_acumulada_pp")


@query("yoy_change_total")
def _(w):
    return with_changes(_rates(w.country, COUNTRY), ["rede", "serie"])


@query("cumulative_change")
def _(w):
    changed = with_changes(_rates(w.silver_state, STATE), ["sigla_uf", "rede", "serie"])
    return changed.select(
        "sigla_uf", *YEAR_GRADE, "rede", "taxa_primeiro_ano", "variacao_acumulada_pp"
    )


@query("running_share")
def _(w):
    per_state = (
        w.table("supplier").join(F.broadcast(w.table("nation")),
                                 F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name").agg(F.count(F.lit(1)).alias("municipios"))
    )
    share, cumulative = reports.running_share(per_state, "municipios", "n_name")
    return per_state.select(
        "n_name", "municipios",
        F.round(share, 6).alias("percentual"), F.round(cumulative, 6).alias("acumulado"),
    )


# ---- order, distinct rows -----------------------------------------------------------


@query("top_n")
def _(w):
    """Ten best rates of all years and networks: order and limit become one top-k step."""
    return (
        w.silver_municipality
        .orderBy(F.desc_nulls_last("taxa_alfabetizacao"), "id_municipio", "serie", "ano", "rede")
        .select("id_municipio", "serie", "ano", "rede", "taxa_alfabetizacao")
        .limit(10)
    )


@query("dedup_rows")
def _(w):
    cuts = w.pupils().select("id_municipio", "ano", "serie", "rede", "alfabetizado")
    return drop_duplicate_rows(cuts)


@query("dedup_by_key")
def _(w):
    pupils = w.pupils().select("id_municipio", "ano", "proficiencia", "id_aluno")
    return one_per_key(pupils, ["id_municipio", "ano"], prefer=["proficiencia"], latest=True)


@query("distinct_pairs")
def _(w):
    return quality.distinct_rows(w.silver_goals, ["escopo", "rede", "rede_descricao"])


# ---- data quality -------------------------------------------------------------------


@query("profile")
def _(w):
    columns = ["sigla_uf", "ano", "nome_municipio", "alfabetizado", "peso_aluno"]
    return quality.profile(w.silver_pupils.select(*columns), ["sigla_uf", "ano"])


@query("unmatched_rows")
def _(w):
    return quality.unmatched_rows(w.silver_pupils, "nome_municipio")


@query("unmapped_codes")
def _(w):
    return quality.unmapped_codes(w.silver_pupils, silver.PUPIL_CODES, UNMAPPED)


@query("write_checks")
def _(w):
    """The checks of single rows, as they were taken while the silver tables were written."""
    return w.silver_table("verificacoes")


@query("column_contract")
def _(w):
    """What raw tables lack of the columns that the gold step asks for."""
    return quality.contract_gaps({
        "alunos": (w.pupils(), REQUIRED_PUPILS),
        "municipio": (w.published_municipalities(), REQUIRED_MUNICIPALITY),
        "uf": (w.silver_state, REQUIRED_STATE),
    })


@query("unmapped_texts")
def _(w):
    return quality.unmapped_texts(w.silver_goals)


@query("key_quality")
def _(w):
    localities = normalize_ids(w.localities(), ids=["id_municipio"])
    return quality.key_quality(localities, "id_municipio", ["nome_municipio", "sigla_uf"])


# ---- events -------------------------------------------------------------------------


@query("event_unwrap")
def _(w):
    items = stream.goal_items(w.goal_events()).where(F.col("motivo").isNull())
    return items.select(
        "event_id", "ordem", "ano", "rede",
        to_double(F.element_at("item", F.lit("taxa_alfabetizacao")))
        .alias("taxa_alfabetizacao"),
    )


@query("event_quarantine")
def _(w):
    return stream.quarantined(stream.goal_items(w.goal_events())).select(
        "event_id", "motivo", "value"
    )


@query("goal_map_explode")
def _(w):
    return stream.goal_years_of(
        stream.accepted(stream.goal_items(w.goal_events()))
    ).select("event_id", "ano", "rede", "ano_meta", "meta_alfabetizacao")


@query("latest_goal")
def _(w):
    """Of the stored goals of each year and network, the last that the stream took in."""
    _, received = w.run_events()
    item = F.from_json("item", "map<string,string>")
    return stream.latest_goals(received).select(
        "ano", "rede",
        to_double(F.element_at(item, F.lit("taxa_alfabetizacao"))).alias("taxa_alfabetizacao"),
    )


@query("stream_ingest")
def _(w):
    _, received = w.run_events()
    return stream.goal_years_of(received).select("ano", "rede", "ano_meta", "meta_alfabetizacao")


@query("stream_acknowledgement")
def _(w):
    """Events a finished run took in, and the goals it stored."""
    run, received = w.run_events()
    return received.agg(
        F.lit(stream.acknowledgement(run)["eventos"]).cast("bigint").alias("eventos"),
        F.count(F.lit(1)).alias("metas"),
    )


@query("stream_refresh")
def _(w):
    """The national comparison after events arrived and refreshed the stored layers by batch."""
    root = scratch_folder(w.spark, "events")
    layers = replace(w.full_lake(), received_goals=f"{root}/received")
    w.run_events(
        root,
        lambda session, batch, _: pipeline.refresh_after_batch(session, layers, MODEL, batch),
    )
    return scan(w.spark, f"{layers.gold}/metas_vs_resultado_{COUNTRY.scope}")


@query("run_pipeline")
def _(w):
    """Rows of every table after a whole run, from the copied sources to the feature table."""
    layers = w.new_lake()
    pipeline.run_pipeline(w.spark, layers, MODEL)
    stored = {t: f"{layers.silver}/{t}" for t in ("alunos", "municipio", "uf", "meta_alfabetizacao")}
    stored |= {t: f"{layers.gold}/{t}" for t in (*pipeline.CATALOG_TABLES, "ml_aluno")}
    return table_sizes({t: scan(w.spark, path) for t, path in stored.items()})


# ---- tables -------------------------------------------------------------------------


@query("silver_state")
def _(w):
    return w.silver_state


@query("silver_municipality")
def _(w):
    return w.silver_municipality


@query("silver_pupil")
def _(w):
    return w.silver_pupils


@query("silver_goal")
def _(w):
    return w.silver_goals


@query("indicator_finalize")
def _(w):
    return gold.finished(_rates(w.silver_state, STATE), STATE)


@query("gold_indicator_municipality")
def _(w):
    return w.municipality


@query("gold_indicator_state")
def _(w):
    return w.state


@query("gold_indicator_total")
def _(w):
    return w.country


@query("gold_goal_vs_result_municipality")
def _(w):
    return w.comparison(MUNICIPALITY)


@query("gold_goal_vs_result_state")
def _(w):
    return w.comparison(STATE)


@query("gold_goal_vs_result_total")
def _(w):
    return w.comparison(COUNTRY)


@query("gold_evolution_municipality")
def _(w):
    return w.evolution(MUNICIPALITY)


@query("gold_evolution_state")
def _(w):
    return w.evolution(STATE)


@query("gold_evolution_total")
def _(w):
    return w.evolution(COUNTRY)


@query("gold_ml_features")
def _(w):
    return w.features(portable_bucket)


@query("gold_ml_features_murmur")
def _(w):
    return w.features(murmur_bucket)


# ---- reports ------------------------------------------------------------------------

COMPARED = "metas_vs_resultado"


@query("q1_result_vs_goal")
def _(w):
    return reports.result_against_goal(w.gold_table(COMPARED, MUNICIPALITY), CURRENT_YEAR)


@query("q2_goal_reached")
def _(w):
    return reports.goal_reached(w.gold_table(COMPARED, MUNICIPALITY), CURRENT_YEAR)


@query("q3_distance_by_goal_year")
def _(w):
    return reports.distance_by_goal_year(w.gold_table(COMPARED, MUNICIPALITY), CURRENT_YEAR)


@query("q4_state_ranking")
def _(w):
    return reports.state_ranking(w.gold_table(COMPARED, STATE), CURRENT_YEAR, FINAL_YEAR)


@query("q5_states_below")
def _(w):
    return reports.states_below_goal(w.gold_table(COMPARED, MUNICIPALITY), CURRENT_YEAR)


@query("q6_state_spread")
def _(w):
    return reports.spread_between_and_within_states(
        w.gold_table("indicador", MUNICIPALITY), CURRENT_YEAR
    )


@query("q7_national_goal_vs_result")
def _(w):
    return w.gold_table(COMPARED, COUNTRY)


@query("q8_national_indicator")
def _(w):
    return w.gold_table("indicador", COUNTRY)


@query("q9_national_evolution")
def _(w):
    return w.gold_table("evolucao_temporal", COUNTRY)
