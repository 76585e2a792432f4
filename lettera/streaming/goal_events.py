"""Goal events: a stream of JSON envelopes becomes rows of the goal table.

Events arrive as text (files here; any source with a text column will do).  Accepted rows are
appended to a bronze table, one folder per micro-batch, so that a batch that runs again after
a failure replaces its own output.  What cannot be used goes to a quarantine table and never
stops the stream.  Which goal counts is decided when the table is read: the latest to arrive.

A producer that hands over many files at once numbers its deliveries, one folder
``entrega=<number>`` each.  The numbers tell the order then, however many files a micro-batch
takes and in whatever order they were written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lettera.functions import code_of, to_double, to_int
from lettera.model import COUNTRY_KEY, GOAL_PREFIX, SCOPE_COUNTRY, IndicatorModel
from lettera.operators.clean import one_per_key
from lettera.operators.goals import GOAL_KEY

REJECT_EMPTY = "vazio"
REJECT_FORMAT = "formato nao suportado"
REJECT_YEAR = "sem ano"

BRONZE_SCHEMA = (
    "chegada timestamp, entrega bigint, linha bigint, ordem int, ano int, rede string, item string, "
    "lote bigint"
)

# The number of a delivery, in the path of its files.
_DELIVERY = r"/entrega=([0-9]+)/[^/]*$"


def read_goal_events(
    spark: SparkSession, path: str, one_event_per_file: bool = False, files_per_batch: int = 1000
) -> DataFrame:
    """Stream of raw events: ``value``, the time its file arrived (``chegada``) and the number of
    its delivery (``entrega``; NULL for a file outside a numbered folder).

    Events are lines, or whole files.  Lines of one file arrive at the same time.
    """
    return (
        spark.readStream.format("text")
        .option("wholetext", one_event_per_file)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select(
            "value",
            F.col("_metadata.file_modification_time").alias("chegada"),
            F.regexp_extract("_metadata.file_path", _DELIVERY, 1).try_cast("bigint")
            .alias("entrega"),
        )
    )


def _starts_with(c: Column, sign: str) -> Column:
    return F.ltrim(c).startswith(sign)


def unwrap(events: DataFrame) -> DataFrame:
    """Add ``carga``: the goal object or list inside the envelope.

    Tried in turn, after taking the body out of an HTTP event: ``detail.detail``, ``metas``,
    a list in ``detail``, and the event itself.
    """
    event = F.coalesce(F.get_json_object("value", "$.body"), F.col("value"))
    listed = F.get_json_object("_event", "$.detail")
    payload = F.coalesce(
        F.get_json_object("_event", "$.detail.detail"),
        F.get_json_object("_event", "$.metas"),
        F.when(_starts_with(listed, "["), listed),
        F.col("_event"),
    )
    return events.withColumn("_event", event).withColumn("carga", payload).drop("_event")


def goal_items(events: DataFrame) -> DataFrame:
    """One row per goal object: ``ordem``, its text, its fields (a map), and ``motivo``.

    ``motivo`` is NULL for usable rows and tells why the others are refused.  Items are judged
    one by one; an event without any keeps one row, with its original text.
    """
    listed = (
        F.when(_starts_with(F.col("carga"), "{"), F.concat(F.lit("["), "carga", F.lit("]")))
        .when(_starts_with(F.col("carga"), "["), F.col("carga"))
    )
    texts = unwrap(events).withColumn("_texts", F.from_json(listed, "array<string>"))
    items = texts.select("*", F.posexplode_outer("_texts").alias("ordem", "texto")).withColumn(
        "item",
        F.when(
            _starts_with(F.col("texto"), "{"), F.from_json("texto", "map<string,string>")
        ),
    )
    year = to_int(F.element_at("item", F.lit("ano")))
    listless, empty_list = F.col("_texts").isNull(), F.col("ordem").isNull()
    reason = (
        F.when(listless, REJECT_FORMAT)
        .when(empty_list | (F.size("item") == 0), REJECT_EMPTY)
        .when(F.col("item").isNull(), REJECT_FORMAT)
        .when(year.isNull(), REJECT_YEAR)
    )
    return items.select(
        *events.columns,
        "ordem",
        "texto",
        "item",
        year.alias("ano"),
        F.trim(F.element_at("item", F.lit("rede"))).alias("rede"),
        reason.alias("motivo"),
    )


def accepted(items: DataFrame) -> DataFrame:
    kept = [c for c in items.columns if c not in ("value", "motivo", "item", "texto")]
    return items.where(F.col("motivo").isNull()).select(
        *kept, F.col("texto").alias("item")
    )


def quarantined(items: DataFrame) -> DataFrame:
    kept = [c for c in items.columns if c not in ("item", "texto", "ano", "rede")]
    return items.where(F.col("motivo").isNotNull()).select(*kept)


def latest_goals(received: DataFrame) -> DataFrame:
    """Of the goals received for one year and network, the last to arrive.

    Numbered deliveries come first, then batches, the arrival of files, the lines of a file, the
    places in a line.  What has a number is later than what has none.
    """
    return one_per_key(
        received, ["ano", "rede"], prefer=["entrega", "lote", "chegada", "linha", "ordem"],
        latest=True,
    )


def goal_years_of(received: DataFrame, item: str = "item") -> DataFrame:
    """One row per goal year found among the names of an item, whatever years it brings."""
    name = rf"^{GOAL_PREFIX}(\d{{4}})$"
    others = [c for c in received.columns if c != item]
    return (
        received.select(*others, F.explode(F.from_json(item, "map<string,string>")))
        .where(F.col("key").rlike(name))
        .select(
            *others,
            F.regexp_extract("key", name, 1).cast("int").alias("ano_meta"),
            to_double(F.col("value")).alias("meta_alfabetizacao"),
        )
        .where(F.col("meta_alfabetizacao").isNotNull())
    )


def streamed_goals(received: DataFrame, model: IndicatorModel) -> DataFrame:
    """Received goals in the shape of the long goal table, limited to the model's years."""
    return (
        goal_years_of(latest_goals(received))
        .where(F.col("ano_meta").isin(*model.goal_years))
        .select(
            F.lit(SCOPE_COUNTRY).alias("escopo"),
            F.lit(COUNTRY_KEY).alias("chave"),
            code_of(F.col("rede"), model.network_codes).alias("rede"),
            F.col("rede").alias("rede_descricao"),
            F.col("ano").alias("ano_publicacao"),
            "ano_meta",
            "meta_alfabetizacao",
        )
    )


def with_streamed_goals(goals: DataFrame, streamed: DataFrame) -> DataFrame:
    """Goal table in which a received goal replaces the one from the batch load."""
    columns = [*GOAL_KEY, "meta_alfabetizacao"]
    both = (
        goals.select(*columns, F.lit(0).alias("_recent"))
        .unionByName(streamed.select(*columns, F.lit(1).alias("_recent")))
    )
    return one_per_key(both, GOAL_KEY, prefer=["_recent"], latest=True).drop("_recent")


def read_received(spark: SparkSession, bronze: str) -> DataFrame:
    """Goals received so far, with their batch (``lote``); none before the first event."""
    try:
        return spark.read.schema(BRONZE_SCHEMA).parquet(bronze)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BRONZE_SCHEMA)


@dataclass(frozen=True)
class GoalRun:
    """A started run, and what its micro-batches took in so far: (events, goals) by batch."""

    query: StreamingQuery
    batches: dict[int, tuple[int, int]] = field(default_factory=dict)

    def awaitTermination(self, *seconds: float) -> bool | None:
        return self.query.awaitTermination(*seconds)


def start_goal_stream(
    events: DataFrame,
    bronze: str,
    quarantine: str,
    checkpoint: str,
    refresh: Callable[[SparkSession, int, int], None] | None = None,
) -> GoalRun:
    """Process all events there are, then stop; run again to continue where it stopped.

    ``refresh(session, batch, goals)`` is called after a micro-batch has stored its goals, to
    bring the tables that depend on goals up to date.  A batch without usable goals calls
    nothing.

    Batches take the files in the order of their arrival.  Between unnumbered files of one batch
    that arrived in the same moment the order is that of the partitions that read them.
    """
    batches: dict[int, tuple[int, int]] = {}
    # The first row of each event is its only one without an item, or its item 0.
    firsts = F.count_if(F.coalesce("ordem", F.lit(0)) == 0).alias("events")

    def store(batch: DataFrame, batch_id: int) -> None:
        # Numbers rise along the lines of a file, so that the later of two lines counts.
        lines = batch.withColumn("linha", F.monotonically_increasing_id())
        used = F.col("motivo").isNull()
        # Kept until both tables are written: of each row only the text that its table takes.
        items = goal_items(lines).drop("item").withColumns(
            {"value": F.when(~used, F.col("value")), "texto": F.when(used, F.col("texto"))}
        ).persist()
        try:
            stored, refused = Observation(), Observation()
            accepted(items).observe(stored, F.count(F.lit(1)).alias("goals"), firsts) \
                .write.mode("overwrite").parquet(f"{bronze}/lote={batch_id}")
            quarantined(items).observe(refused, firsts).write.mode("overwrite") \
                .parquet(f"{quarantine}/lote={batch_id}")
        finally:
            items.unpersist()
        goals = stored.get["goals"]
        batches[batch_id] = (stored.get["events"] + refused.get["events"], goals)
        if refresh is not None and goals:
            refresh(batch.sparkSession, batch_id, goals)

    query = (
        events.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return GoalRun(query, batches)


def acknowledgement(run: GoalRun) -> dict[str, int]:
    """Number of events, micro-batches and goals that a finished run took in."""
    return {
        "eventos": sum(events for events, _ in run.batches.values()),
        "lotes": sum(1 for events, _ in run.batches.values() if events),
        "metas": sum(goals for _, goals in run.batches.values()),
    }
