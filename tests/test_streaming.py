import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from lettera.model import IndicatorModel
from lettera.plans import catalog
from lettera.plans.catalog import Workspace
from lettera.streaming import goal_events as stream
from oracle.sql import ORACLE
from tests.compare import connect, differences
from tests.conftest import FOLDER, as_set

MODEL = IndicatorModel()


@pytest.fixture(scope="module")
def con_events():
    return connect(FOLDER)


def goal(year, network="Pública", **goals):
    return {"ano": str(year), "rede": network, "taxa_alfabetizacao": "61.0"} | {
        f"meta_alfabetizacao_{y[1:]}": v for y, v in goals.items()
    }


FOUR = [
    goal(2023, g2024="60.0", g2030="90.0"),
    goal(2024, g2025="62.0", g2030="87.0", g2031="92.0"),
    goal(2025, g2026=64.0, g2032="94.0"),
    goal(2026, g2027="66.0", g2033="96.0"),
]


@pytest.fixture
def events(spark):
    return lambda *texts: spark.createDataFrame(
        [(t if isinstance(t, str) or t is None else json.dumps(t, ensure_ascii=False),)
         for t in texts],
        "value string",
    )


ENVELOPES = {
    "nested": {"detail": {"detail": FOUR}},
    "documented": {"version": "0", "detail-type": "metas", "source": "x", "detail": FOUR},
    "metas": {"metas": FOUR},
    "http": {"body": json.dumps({"metas": FOUR}), "headers": {"a": "b"}},
    "http around the documented one": {"body": json.dumps({"detail": FOUR})},
    "bare list": FOUR,
}


@pytest.mark.parametrize("name", ENVELOPES)
def test_lists_in_every_envelope(events, name):
    items = stream.goal_items(events(ENVELOPES[name]))
    assert as_set(items, "ordem", "ano", "rede", "motivo") == {
        (i, 2023 + i, "Pública", None) for i in range(4)
    }


@pytest.mark.parametrize("event", [FOUR[0], {"metas": FOUR[0]}, {"detail": {"detail": FOUR[0]}}])
def test_single_objects(events, event):
    items = stream.goal_items(events(event))
    assert as_set(items, "ordem", "ano", "motivo") == {(0, 2023, None)}


@pytest.mark.parametrize(
    "event, reason",
    [
        ({}, "vazio"), ([], "vazio"), ({"metas": []}, "vazio"), ({"metas": {}}, "vazio"),
        ({"detail": {"detail": []}}, "vazio"),
        ({"metas": "texto"}, "formato nao suportado"), ({"metas": 7}, "formato nao suportado"),
        ("nem json", "formato nao suportado"), ({"metas": [1, 2]}, "formato nao suportado"),
        ("", "formato nao suportado"), (None, "formato nao suportado"),
        ({"metas": [{"rede": "Pública"}]}, "sem ano"), ({"outro": 1}, "sem ano"),
        ({"metas": [{"ano": "x"}]}, "sem ano"),
    ],
)
def test_what_cannot_be_used_is_kept_aside(events, event, reason):
    items = stream.goal_items(events(event))
    assert items.select("motivo").distinct().collect() == [(reason,)]
    assert stream.accepted(items).count() == 0
    original = event if isinstance(event, str) or event is None else (
        json.dumps(event, ensure_ascii=False)
    )
    assert as_set(stream.quarantined(items), "value") == {(original,)}


def test_bad_items_do_not_take_good_ones_along(events):
    items = stream.goal_items(events({"metas": [FOUR[0], {"rede": "x"}, {}, "x", None, 7]}))
    assert as_set(items, "ordem", "motivo") == {
        (0, None), (1, "sem ano"), (2, "vazio"), (3, "formato nao suportado"),
        (4, "formato nao suportado"), (5, "formato nao suportado"),
    }


def test_unexpected_fields_do_not_matter(events):
    odd = {"ano": 2024, "rede": None, "outro": {"a": [1]}, "meta_alfabetizacao_2025": 61.5}
    items = stream.accepted(stream.goal_items(events({"detail": "texto", "metas": [odd]})))
    assert as_set(stream.goal_years_of(items), "ano", "rede", "meta_alfabetizacao") == {
        (2024, None, 61.5)
    }


def test_nothing_received_yet(spark, tmp_path):
    received = stream.read_received(spark, str(tmp_path / "absent"))
    assert stream.streamed_goals(received, MODEL).count() == 0


def test_any_goal_year_is_found(events):
    items = stream.accepted(stream.goal_items(events({"metas": FOUR})))
    found = as_set(stream.goal_years_of(items), "ano", "ano_meta", "meta_alfabetizacao")
    assert found == {
        (2023, 2024, 60.0), (2023, 2030, 90.0), (2024, 2025, 62.0), (2024, 2030, 87.0),
        (2024, 2031, 92.0), (2025, 2026, 64.0), (2025, 2032, 94.0), (2026, 2027, 66.0),
        (2026, 2033, 96.0),
    }


class Run:
    """A stream over a folder, run once per call."""

    def __init__(self, spark, root, refresh=None, files_per_batch=1000):
        self.spark, self.root, self.refresh = spark, root, refresh
        self.files_per_batch = files_per_batch
        (root / "in").mkdir()

    def drop(self, name, *events):
        lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
        (self.root / "in" / name).write_text("\n".join(lines))

    def __call__(self):
        query = stream.start_goal_stream(
            stream.read_goal_events(
                self.spark, str(self.root / "in"), files_per_batch=self.files_per_batch
            ),
            str(self.root / "received"), str(self.root / "quarantine"),
            str(self.root / "checkpoint"), self.refresh,
        )
        query.awaitTermination()
        return query

    def received(self):
        return stream.read_received(self.spark, str(self.root / "received"))


def test_the_later_line_of_one_file_counts(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.drop("a.json", {"metas": goal(2024, "Municipal", g2030="90")},
             {"metas": goal(2024, "Municipal", g2030="10")})
    run()
    goals = stream.goal_years_of(stream.latest_goals(run.received()))
    assert as_set(goals, "ano_meta", "meta_alfabetizacao") == {(2030, 10.0)}


def test_stream_continues_and_the_latest_goal_counts(spark, tmp_path):
    calls = []
    run = Run(spark, tmp_path, lambda session, batch, goals: calls.append((batch, goals)))
    run.drop("a.json", {"metas": FOUR}, "kaputt", {"metas": goal(2024, "Municipal", g2030="1")})
    assert stream.acknowledgement(run()) == {"eventos": 3, "lotes": 1, "metas": 5}
    assert run.received().count() == 5
    run()
    assert run.received().count() == 5 and calls == [(0, 5)]

    run.drop("b.json", {"detail": [goal(2024, " Pública", g2030="88.5", g2026="70")]})
    run()
    assert calls == [(0, 5), (1, 1)]
    goals = stream.streamed_goals(run.received(), MODEL)
    now = as_set(
        goals.where("ano_publicacao = 2024"), "rede", "ano_meta", "meta_alfabetizacao"
    )
    # The newer revision replaces the older one as a whole; 2031 and later are not kept.
    assert now == {(5, 2030, 88.5), (5, 2026, 70.0), (3, 2030, 1.0)}
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 1


def test_every_batch_of_a_long_run_is_acknowledged(spark, tmp_path):
    """However many batches a run has, and however few of them Spark remembers."""
    run = Run(spark, tmp_path, files_per_batch=1)
    for n in range(4):
        run.drop(f"{n}.json", {"metas": FOUR[:n]}, "kaputt")
    remembered = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(remembered, 1)
    try:
        assert stream.acknowledgement(run()) == {"eventos": 8, "lotes": 4, "metas": 6}
    finally:
        spark.conf.unset(remembered)


def test_a_repeated_batch_replaces_its_own_output(spark, tmp_path):
    calls = []

    def fail_once(session, batch, goals):
        calls.append(batch)
        if len(calls) == 1:
            raise RuntimeError("lost")

    run = Run(spark, tmp_path, fail_once)
    run.drop("a.json", {"metas": FOUR})
    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert calls == [0, 0]
    assert run.received().count() == 4


def test_a_batch_without_goals_refreshes_nothing(spark, tmp_path):
    calls = []
    run = Run(spark, tmp_path, lambda *args: calls.append(args))
    run.drop("a.json", {}, "kaputt")
    run()
    assert calls == []
    assert run.received().count() == 0


def test_received_goals_replace_loaded_ones(rows):
    schema = (
        "escopo string, chave string, rede int, rede_descricao string, ano_publicacao int, "
        "ano_meta int, meta_alfabetizacao double"
    )
    loaded = rows(
        [("brasil", "BR", 5, "Pública", 2024, 2030, 90.0),
         ("uf", "RS", 5, "Pública", 2024, 2030, 80.0)], schema,
    )
    received = rows(
        [("brasil", "BR", 5, "Pública", 2024, 2030, 70.0),
         ("brasil", "BR", 5, "Pública", 2025, 2030, 75.0)], schema,
    )
    out = stream.with_streamed_goals(loaded, received)
    assert as_set(out, "chave", "ano_publicacao", "meta_alfabetizacao") == {
        ("BR", 2024, 70.0), ("RS", 2024, 80.0), ("BR", 2025, 75.0),
    }


def test_numbered_deliveries_tell_the_order(spark, tmp_path):
    """The higher number counts, in one batch and across batches, whatever was written last."""
    for files_per_batch in (1, 10):
        (tmp_path / str(files_per_batch)).mkdir()
        run = Run(spark, tmp_path / str(files_per_batch), files_per_batch=files_per_batch)
        for at, number in enumerate((2, 10, 1)):
            folder = run.root / "in" / f"entrega={number}"
            folder.mkdir()
            line = json.dumps({"metas": goal(2024, "Municipal", g2030=str(number))})
            (folder / "part-0.txt").write_text(line)
            os.utime(folder / "part-0.txt", (1_000_000 + at, 1_000_000 + at))
        run()
        goals = stream.goal_years_of(stream.latest_goals(run.received()))
        assert as_set(goals, "ano_meta", "meta_alfabetizacao") == {(2030, 10.0)}


def test_batches_do_not_grow_in_number_with_the_events(workspace, con_events, monkeypatch):
    """Many files, and ids with wide gaps: few batches, and the last event still counts."""
    wide = Workspace(workspace.spark, workspace.folder)
    wide._tables["events"] = workspace.table("events").withColumn(
        "event_id", F.col("event_id") * 1_000_000_001  # the same remainder by 4, which tells the year
    )
    monkeypatch.setattr(catalog, "EVENTS_PER_FILE", 40)
    run, received = wide.run_events()
    assert 1 < len(run.batches) <= catalog.EVENT_BATCHES
    assert received.select("entrega").distinct().count() > catalog.EVENT_BATCHES
    got = stream.latest_goals(received).select(
        "ano", "rede",
        F.get_json_object("item", "$.taxa_alfabetizacao").cast("double").alias("taxa_alfabetizacao"),
    )
    assert differences(got, con_events, ORACLE["latest_goal"]) == []


@pytest.mark.parametrize("name", ["stream_ingest", "stream_acknowledgement", "latest_goal"])
def test_queries_on_the_stream_take_all_events_in_few_steps(spark, con_events, monkeypatch, name):
    """Of a hundred files, one write deals all and five batches take all in."""
    runs, written = [], []
    start, text = stream.start_goal_stream, DataFrameWriter.text

    def start_noted(*args):
        runs.append(start(*args))
        return runs[-1]

    def text_noted(writer, path):
        written.append(path)
        text(writer, path)

    monkeypatch.setattr(stream, "start_goal_stream", start_noted)
    monkeypatch.setattr(DataFrameWriter, "text", text_noted)
    monkeypatch.setattr(catalog, "EVENTS_PER_FILE", 10)
    got = catalog.QUERIES[name](spark, FOLDER)
    assert differences(got, con_events, ORACLE[name]) == []
    assert (len(written), [len(run.batches) for run in runs]) == (1, [5])
