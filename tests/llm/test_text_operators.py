"""Operators on texts and pages against brute force, with nulls, repeats and clashing columns."""

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettera.llm import (
    common, decontaminate, html_text, licenses, near_duplicates, packing, quality, sanitise, sharding, urls, warc,
)
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, row string, node long, number long, id long, words string, n_chars long"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}x" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, a null text, a null id, an empty text, a very long one, odd columns."""
    rng = random.Random(5)
    base = words(rng, 120, 10**6)
    near = base.replace(base.split()[60], "changed")
    rows = [(1, base), (2, base), (3, near), (4, None), (None, "a b"), (5, ""), (6, "short one"),
            (7, words(rng, 30_000)), (8, words(rng, 120, 10**6)), (8, words(rng, 80, 10**6)), (9, " \n\t "), (1, base)]
    return spark.createDataFrame(
        [(i, t, "r", 1, 2, 3, "w", len(t or "")) for i, t in rows], DOCS
    )


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def brute_quality(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = {i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))


def test_quality_counts(spark, docs):
    rng = random.Random(1)
    odd = ["".join(rng.choice("ab \n\t#é😀\x0b\u00a0|") for _ in range(rng.randrange(120))) for _ in range(300)]
    texts = [*odd, "a b c a b c a b c", "x\n\nx\n \nx", *(r.text or "" for r in docs.collect())]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    s = quality.statistics(F.col("text"))
    for r in df.select("text", s.alias("s")).collect():
        got = (r.s.n_words, r.s.word_chars, r.s.n_symbols, r.s.n_dup_lines, r.s.n_repeat_words)
        assert got == brute_quality(r.text)


def test_learned_rules_on_held_out_rows(spark):
    rng = random.Random(2)
    rows = []
    for i in range(1200):
        bad = i % 4 == 0
        rows.append((i, 0 if bad else 1, rng.uniform(0.3, 1) if bad else rng.uniform(0, 0.2), rng.random()))
    df = spark.createDataFrame(rows, "id long, y int, share double, noise double")
    rules = quality.learn(df.filter("id < 800"), "y", ["share", "noise"])
    assert rules and rules[0].tests[0].name == "share" and rules[0].good <= 2
    decided = df.filter("id >= 800").withColumn(
        "kept", quality.verdict(rules, {n: F.col(n) for n in ("share", "noise")})
    )
    right = decided.filter(F.col("kept") == (F.col("y") == 1)).count()
    assert right >= 0.97 * decided.count()
    assert quality.learn(df.filter("y = 1"), "y", ["share"]) == []
    assert quality.learn(df.filter("false"), "y", ["share"]) == []


def test_quality_without_labels_or_rows(spark, docs, none):
    labels = spark.createDataFrame([(8, 1), (8, 0), (None, 0)], "doc_id long, quality int")
    rows, rules = quality.judged(docs, labels, whole_rows=True)
    assert rules == [] and rows.count() == docs.count()
    assert rows.select("row.*").columns == docs.columns
    assert all(r.kept != r.base_failed for r in rows.collect())
    assert quality.judged(none, labels)[0].count() == 0


def luhn(d):
    return sum((x * 2 - 9 * (x > 4)) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute_private(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return ",".join("%s:%d:%d" % x for x in out)


def test_private_spans_and_cleaning(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("a1 .-+()@2,\n9é4😀") for _ in range(rng.randrange(200)))) for i in range(400)]
    rows += [(None, None), (900, "1" * 30_000), (901, "a" * 2000), (902, "+1" + "(" * 2000),
             (903, "é mail a.b@c.de and 4111 1111 1111 1111 10.0.0.255 or +49 (30) 123-4567 10.0.0.1")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, spans long")
    found = sanitise.marked_spans(df)
    base = F.filter("spans", lambda s: s["base"])
    for r in found.select("row.text", sanitise.listed(base).alias("l")).collect():
        assert r.l == brute_private(r.text or "")
    clean = sanitise.sanitised(df)
    assert clean.columns == df.columns and clean.count() == df.count()
    by = {r.doc_id: r.text for r in clean.collect()}
    assert by[None] is None
    assert by[903] == "é mail [EMAIL] and [CARD] [IP] or [PHONE] [IP]"
    assert all(by[i] == t for i, t in rows if not brute_private(t or "") and not re.search(r"\d", t or ""))
    assert sanitise.sanitised(df.filter("false")).count() == 0


def test_texts_with_very_many_matches(spark):
    """Lists of numbers and addresses: time in proportion, the same spans as in short texts."""
    rng = random.Random(8)
    kinds = {
        "ip": lambda: f"10.{rng.randrange(300)}.0.{rng.randrange(256)}",
        "phone": lambda: f"+49 {rng.randrange(10**8, 10**9)} {rng.randrange(10)}",
        "email": lambda: f"\u00e9a{rng.randrange(99)}@b.org",
        "card": lambda: "4111 1111 1111 1111 " + rng.choice(["7", "x"]),
    }
    texts = ["; ".join(make() for _ in range(n)) for make in kinds.values() for n in (3, 300, 3000)]
    texts.append(" ".join(rng.choice(list(kinds.values()))() for _ in range(5000)))
    texts.append("\n".join(f"+1 {i:010d}" for i in range(60_000)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = F.filter("spans", lambda s: s["base"])
    start = time.perf_counter()
    found = sanitise.found(df)
    for r in found.select("row.doc_id", sanitise.listed(base).alias("l")).collect():
        assert r.l == brute_private(texts[r.doc_id])
    masked = found.select("row.doc_id", sanitise.masked(F.col("text"), F.col("spans")).alias("m"), "spans")
    for r in masked.collect():
        want = list(texts[r.doc_id])
        for s in r.spans:
            want[s.start : s.end] = sanitise.FILL * (s.end - s.start)
        assert r.m == "".join(want)
    assert time.perf_counter() - start < 120


def test_sums_and_cuts_of_long_arrays_and_texts(spark, monkeypatch):
    monkeypatch.setattr(common, "FOLDED", 4)
    monkeypatch.setattr(common, "PIECE", 5)
    rng = random.Random(2)
    rows = [([rng.randrange(9) for _ in range(n)], "a\u00e9😀b"[: 1 + n % 4] * n) for n in (0, 1, 3, 4, 5, 16, 17, 70)]
    df = spark.createDataFrame(rows, "v array<int>, t string")
    ranges = [(a, b) for a in range(0, 41, 3) for b in range(0, 41, 4)]
    got = df.select(
        "v", "t", common.before(F.col("v"), lambda a, x: a + x, F.lit(0)).alias("s"),
        common.before(F.col("v"), F.greatest, F.lit(0)).alias("m"),
        common.let(common.pieces_of(F.col("t")), lambda p: F.array(*(
            common.cut(p, F.lit(a), F.least(F.lit(b), F.length("t"))) for a, b in ranges
        ))).alias("c"),
    )
    for r in got.collect():
        assert r.s == [sum(r.v[:i]) for i in range(len(r.v))]
        assert r.m == [max(r.v[:i], default=0) for i in range(len(r.v))]
        assert r.c == [r.t[a : min(b, len(r.t))] for a, b in ranges]


def test_rare_meetings_prove_nothing(spark):
    """A term of nineteen documents, two of them with the entity, discloses nothing by chance."""
    rows = [(i, f"oddname wrote a{i} line to x@y.org") for i in range(2)]
    rows += [(10 + i, f"oddname and thing{i} of the day") for i in range(17)]
    rows += [(100 + i, f"surename{'' if i < 2 else i} says b{i}" + (f" x{i}x to z@y.org" if i < 2 else "")) for i in range(9)]
    rows += [(1000 + i, f"some plain text number q{i} stands here") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = {(r.entity, r.term) for r in sanitise.disclosing(df, sanitise.found(df)).collect()}
    assert ("email:z@y.org", "surename") in pairs and ("email:x@y.org", "oddname") not in pairs
    clean = {r.doc_id: r.text for r in sanitise.sanitised(df).collect()}
    assert all(clean[i] == t for i, t in rows if "@" not in t and "surename " not in t)


def test_disclosing_terms_against_counts(spark):
    rows = [(i, f"the unusualname{'' if i < 4 else i} wrote to x@y.org about thing{i}") for i in range(4)]
    rows += [(10 + i, f"the quick thing{i} of the day") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = {(r.entity, r.term): r for r in sanitise.disclosing(df, sanitise.found(df)).collect()}
    assert ("email:x@y.org", "unusualname") in pairs and ("email:x@y.org", "the") not in pairs
    n, ne, nt, nw = 44, 4, 4, 4
    expected = np.log(nt * n / (ne * nw)) / np.log(n / ne)
    assert abs(pairs["email:x@y.org", "unusualname"].disclosure - expected) < 1e-9
    texts = {r.doc_id: r.text for r in sanitise.sanitised(df).collect()}
    assert "unusualname" not in texts[0] and "x@y.org" not in texts[0]
    assert texts[10] == rows[4][1]


def test_disclosing_terms_far_off_and_without_the_entity(spark):
    rng = random.Random(31)
    far = " ".join(f"filler{i % 5}" for i in range(60))
    rows = [(i, f"note{i} mail x@y.org now. {far} Oddname and oddname é ODDNAME4 oddname") for i in range(4)]
    rows += [(9, "here oddname stands alone, İx oddname"), (10, None)]
    rows += [(20 + i, f"plain text {far} of day {rng.random()}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {r.doc_id: r.text for r in sanitise.sanitised(df).collect()}
    assert all("oddname " not in texts[i].lower() + " " and "x@y.org" not in texts[i] for i in (0, 1, 2, 3, 9))
    assert texts[9].startswith("here ") and texts[10] is None and texts[20] == dict(rows)[20]
    marked = {r.row.doc_id: (r.text, r.terms) for r in sanitise.marked_spans(df).collect()}
    for i in (0, 9):
        got = [t for t in marked[i][1] if marked[i][0][t.start : t.end].lower() == "oddname"]
        assert len(got) == (3 if i == 0 else 2)
    pair = {(r.entity, r.term): r.disclosure for r in sanitise.disclosing(df, sanitise.found(df)).collect()}
    n, ne, nt, nw = len(rows), 4, 4, 5
    assert abs(pair["email:x@y.org", "oddname"] - np.log(nt * n / (ne * nw)) / np.log(n / ne)) < 1e-9
    assert not any(e.startswith("email") and t in ("x", "y", "org") for e, t in pair)


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        n = min(5, len(w))
        sets.append({tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set())
    links = {
        (a, b) for a in range(len(rows)) for b in range(a)
        if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
    }
    root = list(range(len(rows)))
    for _ in rows:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return links, root


def test_near_duplicates_against_all_pairs(spark, docs, none):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 9000]
    base = words(rng, 200, 10**6).split()
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(12)):
            w[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links, root = brute_links(rows)
    degree = Counter(x for pair in links for x in pair)
    groups = defaultdict(list)
    for k, r in enumerate(root):
        groups[r].append(rows[k][0])
    name = [min((x for x in groups[root[k]] if x is not None), default=None) for k in range(len(rows))]
    want = Counter((i, name[k], degree[k]) for k, (i, _) in enumerate(rows))
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in near_duplicates.near_duplicates(df).collect())
    assert got == want
    assert near_duplicates.near_duplicates(none).count() == 0


def test_blocks_of_one_group_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_TEXTS", 8)
    rng = random.Random(6)
    base = words(rng, 300, 10**6).split()
    rows = [(i, " ".join(base[: 300 - i] + [f"z{i}"])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links, _ = brute_links(rows)
    degree = Counter(x for pair in links for x in pair)
    got = {r.doc_id: r.n_links for r in near_duplicates.near_duplicates(df).collect()}
    assert got == {i: degree[i] for i in range(60)}


def test_empty_pieces_count_no_link_twice(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", 40)
    rng = random.Random(12)
    rows = []
    for i in range(24):  # two texts a group, dealt to several pieces
        base = words(rng, 100, 10**6).split()
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:99], f"z{i}"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in near_duplicates.near_duplicates(df).collect()}
    assert got == dict.fromkeys(range(48), 1)


def test_depth_holds_the_recall_of_pairs_at_the_threshold(spark, monkeypatch):
    searched, links = [], near_duplicates.trie_links
    monkeypatch.setattr(
        near_duplicates, "trie_links", lambda nodes, depth: searched.append(depth) or links(nodes, depth)
    )
    base = words(random.Random(14), 200, 10**6)
    # One large group of nearly equal texts.
    df = spark.createDataFrame([(i, f"{base} z{i}") for i in range(40)], "doc_id long, text string")
    got = near_duplicates.near_duplicates(df).collect()
    assert {r.n_links for r in got} == {39}
    assert float(near_duplicates.recall(0.8, searched[-1])) >= 0.999


def test_one_of_each_keeps_columns(docs, none):
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and not ids[2] and not ids[3] and ids[8] == 2 and ids[4] == 1
    assert near_duplicates.one_of_each(none).count() == 0


def test_benchmark_items_are_found(spark, docs, none):
    rng = random.Random(7)
    items = [(i, words(rng, rng.randrange(15, 70), 3000)) for i in range(30)] + [(99, None), (98, "")]
    rows, planted = [], set()
    for i in range(200):
        text = words(rng, rng.randrange(20, 600), 3000).split()
        if i % 5 == 0:
            item = items[rng.randrange(30)]
            w = item[1].split()
            if i % 10 == 0:  # a paraphrase: one word in nine is another
                w = [x if k % 9 else "other" for k, x in enumerate(w)]
            at = rng.randrange(len(text))
            text[at:at] = w
            planted.add((i, item[0]))
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame([*rows, (500, None)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert got <= planted and len(got) >= 0.9 * len(planted)
    clean = decontaminate.decontaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert decontaminate.decontaminated(docs, bench.filter("false")).count() == docs.count()
    assert decontaminate.decontaminated(none, bench).count() == 0


def test_recall_of_the_index_against_brute_force(spark, monkeypatch):
    """The space is fitted to a few documents, all are searched: against every passage being looked at."""
    monkeypatch.setattr(decontaminate, "FIT_DOCS", 60)
    folder = "/root/testdata/sf0.01"
    docs, bench = (
        spark.read.parquet(f"{folder}/{name}.parquet").select(key, "text").where(f"{key} IS NOT NULL")
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    got = {tuple(r) for r in decontaminate.contaminated(docs, bench).select("doc_id", "item_id").collect()}

    def hashes(df):
        rows = df.toArrow()
        return zip(rows.column(0).to_pylist(),
                   decontaminate.hashed(rows.column(1).combine_chunks().fill_null("")), strict=True)

    items = [(i, ws) for i, ws in hashes(bench) if len(ws)]
    weights = np.ones(decontaminate.FEATURES, np.float32)
    texts = [(i, ws) for i, ws in hashes(docs) if len(ws)]
    for _, ws in texts:
        weights[np.unique(ws % decontaminate.FEATURES)] += 1
    weights = np.log((len(texts) + 1) / weights).astype(np.float32) + np.float32(0.05)
    # No space and no least cosine: a part is compared wherever a passage begins.
    monkeypatch.setattr(decontaminate, "COSINE", -2.0)
    every = decontaminate.Items(
        [i for i, _ in items], [ws for _, ws in items], weights, np.zeros((decontaminate.FEATURES, 1), np.float32)
    )
    all_pairs = {(i, every.ids[m[0]]) for i, ws in texts for m in every.matches(ws)}
    assert len(texts) > 5 * decontaminate.FIT_DOCS and len(all_pairs) > 20
    assert len(got & all_pairs) >= 0.9 * len(all_pairs)
    print("recall", len(got & all_pairs), "of", len(all_pairs), "found in all", len(got))


def fitted_rows(monkeypatch):
    """What each later call of ``singular_vectors`` is fitted to: words and weight of its rows."""
    rows, fit = [], decontaminate.singular_vectors

    def kept(words, weights, rank):
        rows.append([(bytes(r["words"]), r["weight"]) for r in words.collect()])
        return fit(words, weights, rank)

    monkeypatch.setattr(decontaminate, "singular_vectors", kept)
    return rows


def test_the_space_is_fitted_to_all_texts_and_items(spark, monkeypatch):
    """However many there are; items keep the share that they have among FIT_DOCS texts and items."""
    monkeypatch.setattr(decontaminate, "FIT_DOCS", 10)
    monkeypatch.setattr(decontaminate, "FIT_WORDS", 500)
    rows = fitted_rows(monkeypatch)
    rng = random.Random(31)
    docs = [(i, words(rng, 1 + i % 90)) for i in range(70)] + [(0, "a b"), (None, "a b"), (71, None), (72, " . ")]
    items = [(i, words(rng, 20)) for i in range(20)] + [(0, "c d"), (21, "")]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert found.count() == 0

    def hashes(texts):
        return [ws.tobytes() for ws in decontaminate.hashed(common.pa.array([t or "" for _, t in texts])) if len(ws)]

    weight = decontaminate.ITEM_WEIGHT * (72 / 10) / (21 / 10)
    expected = [(ws, 1.0) for ws in hashes(docs)] + [(ws, weight) for ws in hashes(items)]
    assert len(expected) == 72 + 21 and [sorted(r) for r in rows] == [sorted(expected)]


def test_products_of_all_passages(monkeypatch):
    """Texts of all lengths, long ones in pieces, against one passage after the other."""
    for n in range(1, 70_000, 7):
        found = [a + x for a, b in decontaminate.pieces(n) for x in decontaminate.starts(b - a).tolist()]
        assert found == decontaminate.starts(n).tolist()
    monkeypatch.setattr(decontaminate, "CHUNK", 60)
    monkeypatch.setattr(decontaminate, "FIT_BLOCK", 3000)
    rng = np.random.default_rng(41)
    texts = [rng.zipf(1.3, n).astype("<u4") for n in range(1, 200)]
    weight = rng.random(len(texts))
    weights = rng.random(decontaminate.FEATURES).astype(np.float32)
    basis = rng.standard_normal((decontaminate.FEATURES, 3)).astype(np.float32)
    brute = np.zeros(basis.shape)
    for ws, w in zip(texts, weight, strict=True):
        for at in decontaminate.starts(len(ws)):
            feature = ws[at : at + decontaminate.PASSAGE] % decontaminate.FEATURES
            product = (basis[feature] * weights[feature, None]).sum(axis=0, dtype=float)
            np.add.at(brute, feature, w * weights[feature, None] * product)
    batch = common.pa.record_batch({"words": [t.tobytes() for t in texts], "weight": weight})
    total, blocks = np.zeros(basis.shape, np.float32), list(decontaminate._fit_blocks([batch]))
    for block in blocks:
        decontaminate._add_products(total, *block, basis * weights[:, None])
    assert len(blocks) > 3
    assert np.allclose(total * weights[:, None], brute, rtol=1e-4, atol=1e-4 * abs(brute).max())


def test_singular_vectors_are_those_of_the_passages(spark):
    """Of 30 different words, fewer than the columns of the random matrix, so nothing is approximate."""
    rng = np.random.default_rng(43)
    texts = [rng.integers(0, 30, n).astype("<u4") for n in rng.integers(1, 400, 80)]
    weight = rng.choice([1.0, 5.0], len(texts))
    weights = rng.random(decontaminate.FEATURES).astype(np.float32)
    rows = []
    for ws, w in zip(texts, weight, strict=True):
        for at in decontaminate.starts(len(ws)):
            count = np.bincount(ws[at : at + decontaminate.PASSAGE], minlength=30)
            rows.append(count * weights[:30] * w ** 0.5)
    size = np.linalg.svd(np.array(rows), compute_uv=False)
    df = spark.createDataFrame(
        [(t.tobytes(), float(w)) for t, w in zip(texts, weight, strict=True)], "words binary, weight double"
    ).repartition(5)
    basis = decontaminate.singular_vectors(df, weights, 20)
    assert basis.shape == (decontaminate.FEATURES, 20) and not basis[30:].any()
    # Each is divided by its singular value; together they hold as much of the matrix as any so many can.
    product = np.array(rows) @ basis[:30]
    assert np.allclose(product.T @ product, np.eye(20), atol=0.02)
    held = np.linalg.norm(np.array(rows) @ np.linalg.qr(basis[:30])[0]) ** 2 / np.sum(size[:20] ** 2)
    print("held", held)
    assert held > 0.999


def test_words_of_odd_texts():
    rng = random.Random(47)
    signs = " \t\n\r\x0b\x0c\x1c\x85\xa0\u2003\u3000aAbÉéßΣς_09٣-,.'«漢字\U0001F600\u0301"
    texts = ["", " ", "a", " . "] + ["".join(rng.choices(signs, k=rng.randrange(50))) for _ in range(2500)]
    found = decontaminate.hashed(common.pa.array(texts))
    whole = common.pa.compute.split_pattern_regex(
        common.pa.compute.utf8_lower(common.pa.array(texts)), decontaminate.WORD_BREAK
    )
    for ws, expected in zip(found, whole.to_pylist(), strict=True):
        assert ws.tolist() == [zlib.crc32(w.encode()) for w in expected if w]


def test_the_driver_holds_little_beside_the_space(spark):
    """The products of the passages are worked on in blocks: no double copy of a whole matrix."""
    rows = [(np.arange(i, i + 300, dtype="<u4").tobytes(), 1.0) for i in range(0, 60_000, 300)]
    df = spark.createDataFrame(rows, "words binary, weight double").repartition(2)
    whole = decontaminate.FEATURES * (decontaminate.RANK + decontaminate.EXTRA)
    tracemalloc.start()
    try:
        basis = decontaminate.singular_vectors(df, np.ones(decontaminate.FEATURES, np.float32), decontaminate.RANK)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert basis.shape == (decontaminate.FEATURES, decontaminate.RANK) and np.isfinite(basis).all()
    print("peak MB", peak / 1e6)
    assert peak < 5 * 4 * whole


def test_parts_of_long_items_are_found(spark):
    rng = random.Random(13)
    items = [(i, words(rng, n, 3000)) for i, n in enumerate([300, 300, 800, 40])]
    cuts = [(0, 0, 200), (0, 100, 300), (1, 55, 255), (2, 0, 150), (2, 333, 453), (2, 680, 800), (3, 0, 40)]
    rows, planted = [], set()
    for i in range(60):
        text = words(rng, 300, 3000).split()
        if i < len(cuts):
            item, first, last = cuts[i]
            part = items[item][1].split()[first:last]
            # Cut in the middle of the item at the end of the text, or in the text.
            text = text + part if i % 2 else text[:100] + part + text[100:]
            planted.add((i, item))
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()]
    assert set(found) == planted and len(found) == len(planted)


def test_long_items_are_dealt_to_blocks(spark, monkeypatch):
    """Items of any length fill blocks by their passages, and are found in whichever they are."""
    monkeypatch.setattr(decontaminate, "BLOCK_VECTORS", 200)
    rng = random.Random(21)
    items = [(i, words(rng, n, 10**6)) for i, n in enumerate([700, 700, 30, 30, 200])]
    docs = [(10 * i, "before it " + t + " after it") for i, t in items] + [(99, words(rng, 500, 10**6)), (98, None)]
    sent = []
    broadcast = type(spark.sparkContext).broadcast
    monkeypatch.setattr(
        type(spark.sparkContext), "broadcast", lambda self, v: sent.append(v) or broadcast(self, v)
    )
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(10 * i, i) for i, _ in items}
    blocks = [v[1] for v in sent if len(v) == 4]
    assert len(blocks) > 1 and sum(map(len, blocks)) == len(items)


def test_longest_common_subsequence():
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 40))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        assert decontaminate.in_order(np.array(a), np.array(b)) == row[-1]


def test_packing(spark, docs, none):
    import public_tokenizers as places
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(places.path("byte_bpe_50k.json"))
    odd = ["  two  spaces ", "a\n b", "x<|endoftext|>y", "tab\t end ", "it's we'll", "é😀 ü", " lead"]
    extra = spark.createDataFrame([(50 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(extra)
    got = packing.packed(df).collect()
    want = Counter()
    for r in df.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        for n, end in enumerate(range(first, len(ids) + 1, 2048)):
            start = 0 if not n else end - 2048
            want[r.doc_id, n, start, end - start, zlib.crc32(ids[start:end].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    assert packing.packed(none).count() == 0


def test_fullest_is_the_best_sum():
    rng = random.Random(9)
    for _ in range(100):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(1, 80)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        got = packing.fullest(counts, room)
        assert sum(got) == max(s for s in sums if s <= room)
        assert all(c <= counts[n] for n, c in Counter(got).items())


def test_licenses(spark, docs, none):
    automaton = licenses.compiled()
    text = "x. Licensed under the\nAPACHE License, Version 2.0. then MIT  license and the mit, license"
    got = licenses.scan(text, automaton)
    assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"]) == (16, 3, 4, 14)
    assert got["labels"] == "apache,apache-2.0,mit" and 0 < got["score"] <= 1
    assert licenses.scan("licensed under the apache licence version 2.0", automaton)["labels"] == ""
    one = licenses.compiled([("t", "begin [[maybe {{2}}]] end")])
    assert one.run("begin end".split(), 0) == {"t": 2}
    assert one.run("begin maybe a b end".split(), 0) == {"t": 5}
    assert one.run("begin maybe a b c end".split(), 0) == {}
    rows = licenses.scanned(docs).collect()
    assert len(rows) == docs.count()
    for r, d in zip(sorted(rows, key=lambda r: (r.doc_id or 0, r.n_words)), range(len(rows)), strict=True):
        assert r.n_base == 0 and r.first_word is None and r.base_labels == ""
    assert licenses.scanned(none).count() == 0


def written(template, optional, words="the example project"):
    """A template as a text, with or without its optional regions."""
    text = re.sub(r"\[\[((?:(?!\]\]).)*)\]\]", r" \1 " if optional else " ", template, flags=re.S)
    return re.sub(r"\{\{(\d+)\}\}", lambda m: " ".join(words.split()[: int(m[1])]), text)


def as_pattern(template):
    """A template as a regular expression over words, each with a blank behind."""
    out = ""
    for mark in licenses._MARK.finditer(template):
        token = mark.group()
        out += {"[[": "(?:", "]]": ")?"}.get(token) or (
            r"(?:\S+ ){1,%s}" % mark[1] if mark[1] else "".join(re.escape(w) + " " for w in licenses.words_of(token))
        )
    return re.compile(r"(?:^| )" + out)


def test_whole_licenses():
    automaton = licenses.compiled()
    whole = {"mit-text", "isc-text", "bsd-2-clause", "bsd-3-clause", "unlicense-text"}
    for label, template in licenses.TEMPLATES:
        if label not in whole:
            continue
        for optional in (False, True):
            text = "Copyright 2020 A B\n" + written(template, optional) + "\nint main"
            assert whole & set(licenses.scan(text, automaton)["labels"].split(",")) == {label}
            assert licenses.scan(text.replace("\n", " # "), automaton)["labels"].count(label) == 1
            words = text.split()
            for change in (
                words[: len(words) * 3 // 4], [*words[:40], "for", "non-commercial", "use", "only", *words[40:]],
                [*words[:30], *words[31:]], [*words[:60], "never", *words[61:]],
            ):
                assert not whole & set(licenses.scan(" ".join(change), automaton)["labels"].split(","))


def test_templates_as_regular_expressions(spark):
    """All labels of all given documents, and of licenses with words left out, by another matcher."""
    automaton, rng = licenses.compiled(), random.Random(11)
    patterns = [(label, as_pattern(template)) for label, template in licenses.TEMPLATES]
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for _, template in licenses.TEMPLATES:
        for optional in (False, True):
            words = written(template, optional).split()
            texts += [" ".join(["so", *words, "then"]), " ".join(w for w in words if rng.random() > 0.02)]
    seen = set()
    for text in texts:
        plain = " " + "".join(w + " " for w in licenses.words_of(text))
        want = {label for label, pattern in patterns if pattern.search(plain)}
        got = licenses.scan(text, automaton)
        assert set(filter(None, got["labels"].split(","))) == want | set(filter(None, got["base_labels"].split(",")))
        seen |= want
    assert seen == {label for label, _ in licenses.TEMPLATES}


def test_html(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav>"
        "<div class=\"ad\">Buy, now.</div><article><h1>Head &amp; more</h1><p><b>One,  two.<br>three<p>Next\nline."
        "</p><script>var a='</p>';</script><ul><li>item one<li>item two</ul></article>"
        "<section class='comments'><p>I like it, really. So much text here.</p></section><footer>&copy; x</footer>"
    )
    assert html_text.main_blocks(page) == ["Head & more", "One, two. three", "Next line.", "item one", "item two"]
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "<p>just &lt;text"), (5, "u", "a < b"),
            (6, "u", "<a" * 20_000), (1, "u", page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.url): r for r in html_text.extracted(df).collect()}
    assert got[2, None].text == "" and got[3, "u"].n_chars == 0 and got[None, "u"].text == "just <text"
    assert got[5, "u"].text == "a < b" and all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.extracted(df).count() == 7 and html_text.extracted(df.filter("false")).count() == 0


@pytest.mark.parametrize("around", [
    "<div class='content has-sidebar'>%s</div>", "<div class='no-sidebar'>%s</div>", "<div id='overlay'>%s</div>",
    "<div class='header-fixed'>%s</div>", "<article><div class='article-body toc-enabled'>%s</div></article>",
    "<div class='page-header-left'><article>%s</article></div>", "<form id='aspnetForm'>%s</form>", "%s",
])
def test_html_names_do_not_lose_the_article(around):
    body = [f"Sentence number {i}, with some words, and more of them. It goes on here." for i in range(6)]
    page = (
        "<body><div class='cookie-bar'><p>" + "We use cookies, really. " * 100 + "</p></div>"
        + around % "".join(f"<p>{t}</p>" for t in body) + "<div class=sidebar><p>Old news, here.</p></div>"
        + "<section class='comments'><p>" + "I like it, really. " * 100 + "</p></section></body>"
    )
    assert html_text.main_blocks(page) == body


@pytest.mark.parametrize("around", ["<div>%s</div>", "<div><section>%s</section></div>", "%s", "<table><tr><td>%s</table>"])
@pytest.mark.parametrize("n", [5, 8, 15, 30, 60])
def test_html_undeclared_pages_keep_lists_tables_and_code(around, n):
    paragraph = "<p>" + "many words here, and so on. " * 3 + "x" * 300 + "</p>"
    items = [f"item {k:02d} without any mark" for k in range(n)]
    parts = {
        "ul": "<ul>" + "".join(f"<li>{t}" for t in items) + "</ul>",
        "table": "<table>" + "".join(f"<tr><td>{t}</td></tr>" for t in items) + "</table>",
        "pre": "".join(f"<pre>{t}</pre>" for t in items),
    }
    links = "".join(f"<li><a href=x>Page number {k}</a></li>" for k in range(40))
    for part in parts.values():
        for body in (paragraph * 4 + part, paragraph * 2 + part + paragraph * 2, paragraph * 3 + part + part):
            page = f"<body><div><ul>{links}</ul></div>{around % body}<div><ul>{links}</ul></div></body>"
            got = html_text.main_blocks(page)
            assert [t for t in got if t.startswith("item")] == items * body.count(part)
            assert len(got) == body.count("<p>") + n * body.count(part)


SENTENCES = "".join(f"<p>Sentence number {i}, with some words, and more of them. It goes on here.</p>" for i in range(6))


@pytest.mark.parametrize("page", [
    '<article>%s</article><article class="comment"><p>I like it, really. So it is.</p></article>',
    '<article>%s</article><article class="promo"><p>Buy it now, please. It is cheap, today.</p></article>',
    '<div>%s</div><div class="sidebar">' + "<p>Old news, here, and there. More of it.</p>" * 60 + "</div>",
    '<div>%s</div><div class="popup">' + "<p>Old news, here, and there. More of it.</p>" * 60 + "</div>",
    '<article>%s<div class="responses"><h3>Letters</h3><p>Nice one, I say. Yes, it is.</p></div></article>',
    '<div class="x">%s</div><div class="y"><h3>3 Responses</h3><ol><li><p>Nice one, I say. Yes.</p></ol></div>',
    '<article>%s<section><h2>Comentarios (2)</h2><p>Me gusta, de verdad. Mucho.</p></section></article>',
])
def test_html_leaves_other_peoples_text(page):
    assert html_text.main_blocks("<body>" + page % SENTENCES + "</body>") == re.findall("<p>(.*?)</p>", SENTENCES)


@pytest.mark.parametrize("part, end", [
    ("<div>text ", ""), ("<![CDATA[ x ", ""), ('<a "', ""), ('<a "', ">"), ("<a x='", ">"), ("<!-- a --!>", "-->"), ("<", ""),
    ("<div class=ad>t ", ""), ("<table><tr><td>x.", ""), ("<p><b>x ", "</b>" * 50_000), ("<div>", "</p>" * 50_000),
    ("<i>", "<b>" * 50_000 + "</i>" * 50_000), ("<ul><li>x", ""), ("&", ""), ("<script>", ""), ("<?x", ""),
])
def test_html_broken_pages_take_linear_time(part, end):
    start = time.perf_counter()
    html_text.main_blocks(part * 100_000 + end)
    assert time.perf_counter() - start < 20


class Reader(HTMLParser):
    """Another reading of well-formed pages with a declared article, by the standard library."""

    BREAKS = {"p", "div", "section", "ul", "ol", "li", "h1", "h2", "h3", "h4", "article", "table", "tr", "td", "th",
              "blockquote", "pre", "figure", "figcaption", "header", "main", "br", "dl", "dt", "dd"}

    def __init__(self, page):
        super().__init__()
        self.open, self.article, self.out, self.text = [], 0, [], ""
        self.feed(page)
        self.close()

    def flush(self):
        if text := " ".join(self.text.split()):
            self.out.append(text)
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += " "
            return
        if tag in self.BREAKS:
            self.flush()
        if tag in html_text.VOID:
            return
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id")).split()
        self.open.append((tag, tag in html_text.NEVER or any(n in html_text.ASIDE for n in names)))
        self.article += tag == "article"

    def handle_endtag(self, tag):
        if tag in self.BREAKS:
            self.flush()
        if any(t == tag for t, _ in self.open):
            while self.open:
                last, _ = self.open.pop()
                self.article -= last == "article"
                if last == tag:
                    break

    def handle_data(self, data):
        if self.article and not any(aside for _, aside in self.open):
            self.text += data


def test_html_as_another_reader(spark):
    """All given pages that close what they open, read by the standard library."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r.text for r in html_text.extracted(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    read = same = 0
    for r in pages:
        page = r.html or ""
        balanced = all(page.count(f"<{t}>") + page.count(f"<{t} ") == page.count(f"</{t}>") for t in ("p", "li", "div", "td", "article"))
        if balanced and page.count("<article") == 1:
            read += 1
            same += "\n".join(Reader(page).out) == got[r.page_id]
    assert read > 10 and same == read


def brute_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for verdict, rule in urls.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (not best or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


def test_urls(spark, docs):
    cases = ["http://a.Example.COM/en/1?x", "https://www.example.com/en/", "http://x.net/es/a#b", "http://net/fr/",
             "http://com", "ftp://a.com?q=://b/c", "no scheme", "", None, "http://É.com/\nz", "http://goodword.org/a",
             "http://x.net/fr", "http://notexample.com/en/", "a://b://c.com/en/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    rows = {r.page_id: r for r in urls.judged(df, docs).collect()}
    for i, u in enumerate(cases):
        host, path, best = brute_url(u)
        assert (rows[i].host, rows[i].path) == (host, path)
        assert rows[i].rule == (best[0] if best else None)
        assert rows[i].verdict == best[1] if best else rows[i].verdict in ("allow", "block")
    assert urls.judged(df.filter("false"), docs).count() == 0


def brute_words(text, counts):
    """The cheapest of all splits; the fewest parts from the left among equals are not asked for."""
    total = sum(counts.values())
    best = {0: (0.0, [])}
    for end in range(1, len(text) + 1):
        best[end] = min(
            (best[i][0] + (math.log(total / counts[w]) if (w := text[i:end]) in counts
                           else math.log(total) + len(w) * math.log(10)), [*best[i][1], text[i:end]])
            for i in range(end)
        )
    return best[len(text)][1]


def test_bayes_against_brute_force(spark):
    """Odds of every url that no rule decides, from words of any length and digits in hosts."""
    long = "extraordinarilyoverlongwordofmanyletters"
    docs = spark.createDataFrame(
        [(f"good news spam offer 7 {long} {long} news good",), ("spam offer offer sale",), (None,)], "text string"
    )
    counts = Counter({"good": 2, "news": 2, "spam": 2, "offer": 3, "sale": 1, long: 2})
    cases = ["http://goodnews.com/a/12", "http://good24news.com/", "http://spamoffer.net/es/sale/3", "http://spam7.net/fr/",
             f"http://{long}sale.net/es/", "http://goodnews.org/a/77", "http://spam99offer.org/sale", f"http://{long}.org/",
             "http://spam7.org", "http://xyz.org/q", "http://newsspam12good.org/sale/1/2", "http://goodnews.com/a/12"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    tokens, known = {}, {}
    for u in cases:
        host, path, best = brute_url(u)
        labels = re.findall(r"[^\W\d_]+|[0-9]+", host)
        tokens[u] = [w for x in labels for w in (["0"] if x.isdigit() else brute_words(x, counts))]
        tokens[u] += ["/" + re.sub("[0-9]+", "0", x) for x in re.findall(r"[^\W_]+", path)]
        known[u] = best[1] if best else None
    seen = {k: Counter(w for u in cases if known[u] == k for w in tokens[u]) for k in ("block", "allow")}
    size = {k: sum(c.values()) + len(set(seen["block"]) | set(seen["allow"])) + 1 for k, c in seen.items()}
    rule = Counter(known[u] for u in cases)
    for r in urls.judged(df, docs).collect():
        u = cases[r.page_id]
        if known[u]:
            continue
        odds = math.log((rule["block"] + 1) / (rule["allow"] + 1)) + sum(
            math.log((seen["block"][w] + 1) / size["block"]) - math.log((seen["allow"][w] + 1) / size["allow"])
            for w in tokens[u] if seen["block"][w] + seen["allow"][w]
        )
        assert r.blocked_odds == pytest.approx(odds) and r.verdict == ("block" if odds >= 0 else "allow")
    assert urls.judged(df, docs.filter("false")).count() == len(cases)


def test_segmentation_of_long_labels(spark):
    counts = {"ab": 9, "abab": 2, "c" * 300: 1, "ba": 4}
    table = spark.createDataFrame(list(counts.items()), "word string, count long")
    rng = random.Random(6)
    labels = ["c" * 300 + "ab", "x" * 500, "ab" * 200, "c" * 299, *("".join(rng.choices("abc", k=30)) for _ in range(40))]
    df = spark.createDataFrame([(x,) for x in labels], "label string").distinct()
    total = sum(counts.values())

    def cost(parts):
        return sum(math.log(total / counts[w]) if w in counts else math.log(total) + len(w) * math.log(10) for w in parts)

    for r in urls.segmented(df, table).collect():
        assert "".join(r.words) == r.label
        assert cost(r.words) == pytest.approx(cost(brute_words(r.label, counts)))


def test_segmentation(spark):
    counts = spark.createDataFrame([("good", 50), ("word", 40), ("go", 5), ("odword", 1)], "word string, count long")
    labels = spark.createDataFrame([("goodword",), ("goodxword",)], "label string")
    got = {r.label: r.words for r in urls.segmented(labels, counts).collect()}
    assert got == {"goodword": ["good", "word"], "goodxword": ["good", "x", "word"]}


def test_shards(spark, none):
    rows = [(i, 100 + i % 7) for i in range(400)] + [(None, 90)] * 60 + [(7, 100)] * 300 + [(1000, 50_000), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, bytes long")
    got = sharding.assign_shards(df, F.col("doc_id"), F.col("bytes"), 2000).collect()
    assert Counter((r.row.doc_id, r.row.bytes) for r in got) == Counter(rows)
    sizes, rows_of = Counter(), Counter()
    for r in got:
        sizes[r.shard] += r.bytes
        rows_of[r.shard] += 1
    for r in got:
        assert sizes[r.shard] == r.shard_bytes and r.depth == len(r.shard)
        assert r.oversized == (r.shard_bytes > 2000) and (not r.oversized or rows_of[r.shard] == 1)
    shards = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:], strict=False))
    assert sharding.assign_shards(none, F.col("doc_id"), F.col("n_chars"), 10).count() == 0


def test_warc(spark, tmp_path):
    long = "é" * 600
    rows = [(1, "http://a/b c", long), (5, None, long), (5, "u", long), (3, "u", "short"), (4, "u", "short"),
            (None, "u", long), (6, "u", None), (7, "u", "x" * 3_000_000), (8, "u\r\nv", "\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter(tuple(r) for r in warc.archived(df).collect())
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        again = html == long and page != 5
        want[page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 5 if again else None] += 1
    assert got == want
    bundles, index = warc.write_archives(df)
    page_of = {r.record_id: r.page_id for r in index.collect()}
    for r in warc.read_archives(bundles).collect():
        assert page_of[r.record_id] == r.page_id
        assert page_of.get(r.refers_to) == (5 if r.record_type == "revisit" else None)
    one = index.filter("page_id = 7")
    assert bytes(warc.read_records(bundles, index, one).first().payload) == b"x" * 3_000_000
    warc.write_files(bundles, str(tmp_path))
    for f in tmp_path.iterdir():
        data = f.read_bytes()
        assert sum(size for _, size, _ in warc.frames_of(data)) < len(data)
    assert warc.archived(df.filter("false")).count() == 0


def test_warc_names_of_repeated_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 3000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 100)
    rows = [(1, "http://a/b", "é" * 600)] * 40 + [(2, "u", "x" * 2000), (3, "u", "é" * 600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    bundles, index = warc.write_archives(df)
    names = [r.bundle for r in bundles.collect()]
    assert len(names) > 5 and len(set(names)) == len(names)
    assert index.select("record_id").distinct().count() == len(rows)
    warc.write_files(bundles, str(tmp_path))
    assert len(list(tmp_path.iterdir())) == len(names)
    read = {r.record_id: r.page_id for r in warc.read_records(bundles, index, index).collect()}
    assert read == {r.record_id: r.page_id for r in index.collect()} and len(read) == len(rows)


@pytest.mark.parametrize("name", ["op9_sharding", "op10_warc"])
def test_queries_against_sql(spark, name):
    from lettera.llm.queries import ORACLE, QUERIES

    if name == "op9_sharding":
        assert QUERIES[name](spark, SF).agg(F.min("depth")).first()[0] > 1
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0
    table = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SF)
        assert out.columns == table.columns, name
        assert out.count() <= table.count()
        table = out


def test_the_pipeline_fits_its_space_to_all_rows(spark, docs, monkeypatch):
    """Of documents with null and repeated ids, of which one repeats as a whole, and of all of the benchmark."""
    import corpus_pipeline

    monkeypatch.setattr(decontaminate, "FIT_DOCS", 3)
    rows = fitted_rows(monkeypatch)
    kept = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    n_items = common.table(spark, SF, "benchmark").count()
    weight = decontaminate.ITEM_WEIGHT * 9 / n_items
    assert [Counter(w for _, w in r) for r in rows] == [Counter({1.0: 9, weight: n_items})]
    assert max(len(ws) for ws, _ in rows[0]) == 4 * 30_000
