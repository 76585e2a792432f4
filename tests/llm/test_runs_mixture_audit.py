"""Periodic runs, mixture-controlled packing and the filter audit against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction
from functools import cache
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettera.llm import filter_audit, mixture, periods
from lettera.llm.common import text_of
from lettera.llm.queries import ORACLE, QUERIES
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(connect(SF).execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


# ---- periodic runs ------------------------------------------------------------------


def brute_runs(w, least_length=6, least_exponent=4):
    """Every maximal stretch that keeps a distance and has no smaller period."""
    out = set()
    for q in range(1, len(w) // least_exponent + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(least_length, least_exponent * q):
                x = w[start : start + length]
                if all(x[: length - r] != x[r:] for r in range(1, q)):
                    out.add((start, length, q))
            i = max(i, start + 1)
    return sorted(out)


def test_runs_of_several_documents():
    rng = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(rng.randrange(1, 4)):
            w = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(60))]
            if len(w) > 10:
                a, p = rng.randrange(len(w)), rng.randrange(1, 12)
                w[a:] = [w[a : a + p][i % len(w[a : a + p])] for i in range(len(w) - a)]
            docs.append(w)
        ends = np.cumsum([len(d) for d in docs])
        ids = np.array(sum(docs, []), np.int64)
        stop = np.repeat(ends, [len(d) for d in docs])
        for least in (3, 4):
            want = [
                (s + int(e) - len(d), m, q) for d, e in zip(docs, ends, strict=True)
                for s, m, q in brute_runs(d, 6, least)
            ]
            assert periods.runs(ids, stop, 6, least) == want


def expected_runs(doc, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, h = len(w), zlib.crc32(str(doc).encode())
    if h % 10 == 0 and n and doc is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    out = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    return (
        doc, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in out).encode()).hexdigest(),
    )


def test_op11_on_all_documents(spark, texts):
    got = QUERIES["op11_periodic_runs"](spark, SF).collect()
    assert len(got) == len(texts) and any(r.n_runs for r in got)
    for r in got:
        if len(texts[r.doc_id]) < 5000:
            assert tuple(r) == expected_runs(r.doc_id, texts[r.doc_id])


def test_runs_of_odd_rows(spark):
    rows = [
        (1, None), (None, "a a a a a a b"), (2, ""), (3, " \t\x0b"), (4, "x y " * 5), (4, "x y " * 5),
        (5, "a b a b\x0ca b\na b a b a b é"), (6, "z " * 60_000 + "end"),
        (7, " ".join(f"w{i % 5000}" for i in range(40_000))),
    ]
    df = spark.createDataFrame([(*r, "r", 5) for r in rows], "doc_id long, text string, row string, runs int")
    found = periods.with_runs(df, keep=["doc_id", "row", "runs"])
    got = defaultdict(list)
    for r in found.collect():
        got[r.row.doc_id].append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
        assert (r.row.row, r.row.runs) == ("r", 5)
    assert got[1] == got[2] == got[3] == [(0, [], "")]
    assert got[None] == [(7, [(0, 6, 1)], "a b")]
    assert got[4] == [(10, [(0, 10, 2)], "x y")] * 2
    assert got[5] == [(7, [(0, 6, 1)], "a b é")]
    assert got[6] == [(60_001, [(0, 60_000, 1)], "z end")]
    assert got[7][0][:2] == (40_000, [(0, 40_000, 5000)])
    assert periods.with_runs(df.filter("false")).count() == 0
    with pytest.raises(ValueError):
        periods.with_runs(df, least_exponent=2)


# ---- mixture-controlled packing -----------------------------------------------------


@cache
def library():
    import public_tokenizers as places
    from tokenizers import Tokenizer

    return Tokenizer.from_file(places.path("word_bpe_49k.json"))


def token_ids(text):
    return np.array([*library().encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_word_ids_as_the_library_gives_them():
    rng = random.Random(4)
    signs = ["a", "B", "don't", "'S", "7", "é", "é", "ß", "İ", "Σ", "ς", " ", "  ", "\n", "\t", " ", " ",
             "\x1c", "\x85", "́", ".", "--", "_", "<|", "<|endoftext|>", "|>", "ﬁ", "日本", "😀", "'ll", "x" * 70, "가", "ᄀ", "ᅡ"]
    encoder = mixture.encoder_of(mixture.TOKENIZER)
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(12)))
        assert encoder.ids(text) == token_ids(text)[:-1].astype("<u2").tobytes(), repr(text)


def check_pieces(rows, docs, capacity):
    """Every id lies in one piece, sequences are gapless, and only full or powers of two."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append(r)
    assert set(of_doc) == set(docs)
    for doc, text in docs.items():
        ids, at = token_ids(text), 0
        for r in sorted(of_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    lengths = []
    for pieces in of_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        lengths.append(at)
    total = sum(lengths)
    assert sorted(lengths, reverse=True) == [capacity] * (total // capacity) + [
        1 << b for b in reversed(range(capacity.bit_length())) if total % capacity >> b & 1
    ]


def test_op12_on_all_documents(spark, texts):
    check_pieces(QUERIES["op12_mixture_packing"](spark, SF).collect(), texts, 4096)


def sent_by_rounds(queues, quanta):
    """Deficit round-robin as a loop: the packets of each round, by queue."""
    queues = {k: list(v) for k, v in queues.items()}
    deficit, rounds = dict.fromkeys(queues, Fraction(0)), []
    while any(queues.values()):
        sent = []
        for name in sorted(queues):
            deficit[name] += quanta[name]
            while queues[name] and queues[name][0][1] <= deficit[name]:
                packet = queues[name].pop(0)
                deficit[name] -= packet[1]
                sent.append(packet)
        rounds.append(sent)
    return rounds


@pytest.mark.parametrize("targets", [None, {"a": 3, "b": 1, None: 2}])
def test_mixture_is_deficit_round_robin(spark, targets, monkeypatch):
    """The order of all packets is that of the loop, over several tasks and blocks of windows."""
    monkeypatch.setattr(mixture, "BLOCK_WINDOWS", 3)
    monkeypatch.setattr(mixture, "BLOCK_BLOCKS", 2)
    rng, capacity = random.Random(9), 64
    rows = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "b", "c", None, ""])
        rows.append((i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 3, 20, 90]))), source))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    # Reads its documents again and again, so they stay where they are.
    found = mixture.packets(df, capacity, "source", mixture.TOKENIZER, mixture.END)
    monkeypatch.setattr(mixture, "packets", lambda *_: found)
    pieces = mixture.mixed(df, capacity, targets=targets).collect()
    check_pieces(pieces, {i: t for i, t, _ in rows}, capacity)

    queues = defaultdict(list)
    for r in found.orderBy("part", "at").drop("ids").collect():
        queues[r.queue].append(((r.doc_id, r.start), r.length))
    total = {q: sum(n for _, n in v) for q, v in queues.items()}
    weight = total if targets is None else {
        q: targets.get(q[1:] if q else None, 1) for q in queues
    }
    quanta = {q: Fraction(capacity * w, sum(weight.values())) for q, w in weight.items()}
    rounds = sent_by_rounds(queues, quanta)
    order = [p for sent in rounds for p, _ in sent]
    mine = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    packets = set(order)
    begun = [(r.doc_id, r.start) for r in mine if (r.doc_id, r.start) in packets]
    assert begun == order
    window = {p: n for n, sent in enumerate(rounds) for p, _ in sent}
    assert all(window.get((r.doc_id, r.start), r.window) == r.window for r in mine)
    # After each window a queue that lasts is less than a packet behind its target.
    given = dict.fromkeys(queues, 0)
    queue_of = {i: "" if s is None else f"={s}" for i, _, s in rows}
    for n, sent in enumerate(rounds, 1):
        for (doc, _), length in sent:
            given[queue_of[doc]] += length
        for q in queues:
            assert given[q] == total[q] or 0 <= quanta[q] * n - given[q] < capacity


def test_mixture_of_odd_rows(spark):
    rows = [(1, None, None, 0), (None, "a b", "", 1), (2, "", "x", 2), (3, "y " * 50_000, "x", 3), (3, "y", "x", 4), (3, "y", "x", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, `window` int")
    found = mixture.mixed(df).collect()
    assert sum(r.length for r in found) == sum(len(token_ids(t)) for _, t, *_ in rows)
    assert {(r.doc_id, r.source) for r in found} == {(i, s) for i, _, s, _ in rows}
    assert mixture.mixed(df.filter("false")).count() == 0
    with pytest.raises(ValueError):
        mixture.mixed(df, targets={"x": 0})


# ---- filter audit -------------------------------------------------------------------


def test_op13_against_sql(spark):
    assert differences(QUERIES["op13_filter_audit"](spark, SF), connect(SF), ORACLE["op13_filter_audit"]) == []


def brute_audit(docs, names):
    """Each order applied to the documents one after the other."""
    out, removed_by = {}, defaultdict(int)
    for part in {p for p, *_ in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in permutations(names):
            left, gone = mine, []
            for step, f in enumerate(order, 1):
                lost = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, "".join(order), step] = [
                    len(left), len(lost), sum(f in d[1] for d in gone),
                    sum(d[1] == {f} for d in mine), sum(d[2] for d in lost), f,
                ]
                gone = gone + lost
                removed_by[part, f] += len(lost)
    return {k: (*v[:-1], removed_by[k[0], v[-1]]) for k, v in out.items()}


def test_audit_applies_every_order(spark):
    rng = random.Random(3)
    docs = [
        (rng.choice(["x", "y", None]), {f for f in "PQRS" if rng.random() < 0.4}, rng.random() < 0.5)
        for _ in range(300)
    ]
    df = spark.createDataFrame(
        [(p, *(f in bad if rng.random() < 0.9 or f in bad else None for f in "PQRS"), m) for p, bad, m in docs],
        "p string, P1 boolean, Q1 boolean, R1 boolean, S1 boolean, step boolean",
    ).toDF("code", *"PQRS", "step")
    got = filter_audit.audited(df, "code", "PQRS", {"n0": F.col("step")})
    want = brute_audit(docs, "PQRS")
    mine = {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.n0, r.shapley)
        for r in got.collect()
    }
    assert mine == want and len(mine) == 3 * 24 * 4
    assert filter_audit.audited(df.filter("false"), "code", "PQRS", {}).count() == 0


def test_verdicts_of_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [
        (3, None, None), (1, "", "en"), (2, None, ""), (None, "", "en"), (1, "", "en"),
        (5, long, "de"), (4, long, "de"), (6, "A" * 4 + "b" * 96, "x"), (7, "AB é%", "x"),
        (8, "a " * 200, "x"), (9, "a b " * 100 + "\x0b c", "x"), (10, "ab|", None),
    ]
    df = spark.createDataFrame([(*r, True, 1) for r in rows], "doc_id long, text string, lang string, A boolean, first int")
    failed = defaultdict(list)
    for r in filter_audit.text_verdicts(df).collect():
        failed[r.doc_id].append((r.part, "".join(c for c in "ABCDE" if r[c])))
    assert failed == {
        3: [("", "AE")], 1: [("en", "A")] * 2, 2: [("", "AE")], None: [("en", "A")],
        5: [("de", "E")], 4: [("de", "")], 6: [("x", "AC")], 7: [("x", "ACD")], 8: [("x", "B")],
        9: [("x", "B")], 10: [("", "AD")],
    }
    assert filter_audit.text_verdicts(df.filter("false")).count() == 0
    labels = spark.createDataFrame(
        [(1, 0, 0, 1), (1, 1, None, 1), (4, None, 1, 1), (None, 1, 1, 1), (4, None, 1, 1)],
        "doc_id long, quality int, toxic int, part int",
    )
    labelled = filter_audit.with_labels(filter_audit.text_verdicts(df), labels)
    assert labelled.count() == len(rows)
    said = {(r.doc_id, r.good, r.toxic) for r in labelled.collect() if r.good or r.toxic}
    assert said == {(1, True, False), (4, None, True)}
    audit = filter_audit.audited(labelled, "part", "ABCDE", {"good": F.col("good"), "toxic": F.col("toxic")})
    assert audit.count() == 4 * 600


def test_text_column_is_read_as_text(spark):
    df = spark.createDataFrame([(1, 12)], "doc_id long, text int")
    assert periods.with_runs(df).first().collapsed == df.select(text_of()).first()[0]
