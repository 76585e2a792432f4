"""Join of texts by the Jaccard similarity of their word shingles, with a MinHash LSH forest.

Each text that occurs is one node, however many rows hold it.  Its MinHash signature makes a
path of ``DEPTH`` labels in each of ``TREES`` prefix tries.  A trie is its paths in sorted order:
the texts below a node of depth k are a run of neighbours with at least k labels in common.  All
tries are sorted at once, by ranges, so that a run of any length lies in many tasks.

The scan of the sorted paths begins with whole paths and shortens the matched prefix label by
label; each run of a depth links its texts to the least of them.  Shortening stops where a pair at
the threshold itself, whose recall is least, is found often enough; the mix of links in the data
decides nothing.  Texts connected by common nodes form candidate groups; within a group every pair
whose sizes allow the similarity is then verified exactly on the shingle sets, a block against a
block at a time, and only counts and roots leave a block.  So a group of any size is many small
tasks, and no pair is ever a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark.sql.types as T
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lettera.llm.common import map_batches, stored, text_of
from lettera.llm.components import components

TREES, DEPTH = 32, 8
#: Shingles of a block at most on average: a task holds two blocks.
BLOCK_SHINGLES, BLOCK_TEXTS = 1_000_000, 1024
#: Parts in which the texts of one band meet the sizes of its blocks.
SALTS = 16
WORD_BREAK = r"[^\p{L}\p{N}_]+"

_SEEDS = np.random.default_rng(20240607)
_A = (_SEEDS.integers(1, 2**32, TREES * DEPTH, dtype=np.uint64) | 1).astype(np.uint32)
_B = _SEEDS.integers(0, 2**32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-case words of a text."""
    ws = F.filter(F.split(F.lower(text), WORD_BREAK, -1), lambda w: w != "")
    return F.transform(ws, lambda w: F.xxhash64(w))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the different runs of ``size`` words; of all of a shorter text."""
    words = words.astype(np.uint64, copy=False)
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    out = np.zeros(n - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = (out ^ words[i : n - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return np.unique(out)


def paths(found: np.ndarray) -> bytes:
    """The text's path in each trie: 16 bits of a minimum of its permuted shingles per label."""
    x = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    low = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 1024):
            np.minimum(low, (x[at : at + 1024, None] * _A + _B).min(axis=0), out=low)
        low = (low * np.uint32(0x85EBCA6B)) >> np.uint32(16)
    return low.astype(">u2").tobytes()


def recall(similarity: np.ndarray | float, depth: int):
    """The probability that a pair shares a prefix of ``depth`` in one of the tries."""
    return 1 - (1 - np.asarray(similarity, float) ** depth) ** TREES


def search_depth(least: float, target: float) -> int:
    """The greatest depth at which a pair of similarity ``least`` is found with probability ``target``."""
    return next((d for d in range(DEPTH, 1, -1) if float(recall(least, d)) >= target), 1)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Stored ``id`` (doc_id), ``text_key`` (MD5 of the text), ``n`` shingles, ``paths``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.md5(text_of()).alias("text_key"),
        word_hashes(text_of()).alias("words"),
    )

    def work(batches):
        for batch in batches:
            ids, keys, words = batch.columns
            flat = words.values.to_numpy(zero_copy_only=False)
            offsets = words.offsets.to_numpy()
            for i in range(batch.num_rows):
                found = shingles(flat[offsets[i] : offsets[i + 1]].view(np.uint64), size)
                yield {
                    "id": ids[i].as_py(), "text_key": keys[i].as_py(), "n": len(found),
                    "paths": paths(found) if len(found) else None,
                }

    return stored(
        map_batches(rows, work, "id long, text_key string, n int, paths binary"), "near-signatures"
    )


def trie_links(nodes: DataFrame, least_depth: int) -> DataFrame:
    """Stored links of each text to the least text of its run at each depth from ``least_depth`` on.

    ``a``, ``b`` and the greatest ``depth`` of a node that both stand below.  A run that lies in
    several tasks has a least text in each of them, and links where their ranges meet.
    """
    paths_of = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(
            t.alias("tree"), F.substring(F.col("paths"), t * (2 * DEPTH) + 1, F.lit(2 * DEPTH)).alias("path"),
        ),
    )
    order = ["tree", "path", "node"]
    ranged = nodes.select("node", F.explode(paths_of).alias("p")).select("p.*", "node")
    ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order)

    def common(labels: np.ndarray) -> np.ndarray:
        """Labels that each row has in common with the one before it."""
        return np.cumprod(labels[1:] == labels[:-1], axis=1).sum(axis=1)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before, first = TaskContext.get().partitionId(), None, None

        def rows(a, b, depth, end=None, row=None) -> pa.RecordBatch:
            n = len(a)
            return pa.RecordBatch.from_pydict({
                "a": a, "b": b, "depth": depth, "task": [task] * n, "end": [end] * n,
                "tree": [row and row[0]] * n, "path": [row and row[1]] * n,
            }, schema=fields)

        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy()
            labels = np.frombuffer(
                batch.column(1).cast(pa.binary(2 * DEPTH)).buffers()[1], ">u2",
            )[: batch.num_rows * DEPTH].reshape(-1, DEPTH)
            node = batch.column(2).to_numpy()
            if before is None:
                first = (int(tree[0]), labels[0].tobytes(), int(node[0]))
            else:
                tree, node = np.r_[before[0], tree], np.r_[before[2], node]
                labels = np.vstack([before[1], labels])
            shared = np.where(tree[1:] == tree[:-1], common(labels), 0)
            for depth in range(least_depth, DEPTH + 1):
                begin = np.flatnonzero(np.r_[True, shared < depth])
                least = np.repeat(np.minimum.reduceat(node, begin), np.diff(np.r_[begin, len(node)]))
                other = np.flatnonzero(least != node)
                yield rows(node[other], least[other], [depth] * len(other))
            before = tree[-1:], labels[-1:].copy(), node[-1:]
        if before is not None:
            last = (int(before[0][0]), before[1].tobytes(), int(before[2][0]))
            yield rows([first[2]], [first[2]], [0], 0, first)
            yield rows([last[2]], [last[2]], [0], 1, last)

    schema = "a long, b long, depth int, task int, end int, tree int, path binary"
    fields = to_arrow_schema(T.StructType.fromDDL(schema))
    found = stored(ranged.mapInArrow(neighbours, schema), "near-tries")
    # Where ranges meet: a first and a last row per task, whatever the tasks hold.
    behind = Window.orderBy("task", "end")
    ends = found.filter(F.col("end").isNotNull()).select(
        "a", "end", *(F.lag(c).over(behind).alias(f"_{c}") for c in ("a", "end", "tree", "path")),
        "tree", "path",
    ).filter((F.col("end") == 0) & (F.col("_end") == 1) & (F.col("tree") == F.col("_tree")))
    alike = [
        (F.substring("path", 1, 2 * d) == F.substring("_path", 1, 2 * d)).cast("int")
        for d in range(1, DEPTH + 1)
    ]
    borders = ends.select("a", F.col("_a").alias("b"), sum(alike[1:], alike[0]).alias("depth"))
    links = found.filter(F.col("end").isNull()).select("a", "b", "depth").unionByName(
        borders.filter(F.col("depth") >= least_depth)
    )
    return stored(
        links.groupBy(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .agg(F.max("depth").alias("depth")),
        "near-trie-links",
    )


def _cells(members: DataFrame) -> DataFrame:
    """Members of candidate groups, dealt to pairs of blocks: ``cell``, ``side``.

    Texts of one group are banded by size, so that only a band and the next can be similar
    enough, and a band is cut by hash into blocks of bounded size.
    """
    parts = F.greatest(
        F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.ceil(F.col("texts") / BLOCK_TEXTS), F.lit(1)
    ).cast("int")
    bands = members.groupBy("root", "band").agg(
        F.sum("n").alias("shingles"), F.count("*").alias("texts")
    ).select("root", "band", parts.alias("parts"))
    above = bands.select("root", (F.col("band") - 1).alias("band"), F.col("parts").alias("next"))
    below = bands.select("root", (F.col("band") + 1).alias("band"), F.col("parts").alias("previous"))
    sizes = bands.join(above, ["root", "band"], "left").join(below, ["root", "band"], "left")
    piece = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    # A band of a large group is a hot key: its sizes are there several times, for parts of its texts.
    sizes = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = members.withColumn("salt", F.pmod(F.hash("node"), F.lit(SALTS)))

    def cell(band, one, other, side):
        return F.struct(band.alias("band"), one.alias("one"), other.alias("other"), side.alias("side"))

    def each(count: Column, make) -> Column:
        return F.transform(F.sequence(F.lit(1), count), lambda q: make(q - 1))

    own = each(F.col("parts"), lambda q: cell(
        2 * F.col("band"), F.least(F.col("piece"), q), F.greatest(F.col("piece"), q),
        F.when(F.col("piece") <= q, 0).otherwise(1),
    ))
    up = each(F.col("next"), lambda q: cell(2 * F.col("band") + 1, F.col("piece"), q, F.lit(0)))
    down = each(F.col("previous"), lambda q: cell(2 * F.col("band") - 1, q, F.col("piece"), F.lit(1)))
    none = F.array().cast("array<struct<band:int,one:int,other:int,side:int>>")
    return (
        salted.join(sizes, ["root", "band", "salt"]).withColumn("piece", piece)
        .select("root", "node", "copies", F.explode(F.concat(
            own.cast(none_type := "array<struct<band:int,one:int,other:int,side:int>>"),
            F.when(F.col("next").isNotNull(), up.cast(none_type)).otherwise(none),
            F.when(F.col("previous").isNotNull(), down.cast(none_type)).otherwise(none),
        )).alias("c"))
        .select("root", "node", "copies", "c.band", "c.one", "c.other", "c.side")
    )


def similar(a: list[np.ndarray], b: list[np.ndarray], least: float) -> np.ndarray:
    """The matrix of exact similarities of sets ``a`` to sets ``b``; 0 where below ``least``."""
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    every = np.concatenate([*a, *b])
    row = np.repeat(np.arange(len(a) + len(b)), np.concatenate([na, nb]))
    _, column, often = np.unique(every, return_inverse=True, return_counts=True)
    shared = often[column] > 1
    row, column = row[shared], column[shared]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(a), len(b)), np.float32)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(a) + len(b), width), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        rows_a = part[: len(a)].any(axis=1)
        rows_b = part[len(a) :].any(axis=1)
        both[np.ix_(rows_a, rows_b)] += part[: len(a)][rows_a] @ part[len(a) :][rows_b].T
    ratio = both / (na[:, None] + nb[None, :] - both)
    ratio[ratio < least - 1e-6] = 0
    exact = both.astype(np.int64)
    ratio[exact * 1000 < np.round(least * 1000) * (na[:, None] + nb[None, :] - exact)] = 0
    return ratio


def _verifier(size: int, least: float):
    def verify(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["side", "node"], kind="stable")
        sets = [shingles(np.asarray(w).view(np.uint64), size) for w in cell["words"]]
        side = cell["side"].to_numpy()
        # Any other cell whose one side got no text has no pairs: its texts meet in a diagonal cell.
        same = bool(cell["one"].iloc[0] == cell["other"].iloc[0] and cell["band"].iloc[0] % 2 == 0)
        first = len(sets) if same else int((side == 0).sum())
        b = sets if same else sets[first:]
        if not first or not b:
            return pd.DataFrame({"node": [], "root": [], "linked": []})
        ratio = similar(sets[:first], b, least)
        if same:
            np.fill_diagonal(ratio, 0)
            link = ratio > 0
            copies = cell["copies"].to_numpy()
            linked, links = link @ copies, link.sum(1)
            full = link
        else:
            link = ratio > 0
            copies = cell["copies"].to_numpy()
            linked = np.concatenate([link @ copies[first:], link.T @ copies[:first]])
            links = np.concatenate([link.sum(1), link.sum(0)])
            full = np.zeros((len(sets), len(sets)), bool)
            full[:first, first:] = link
            full |= full.T
        label = np.arange(len(sets))
        while True:  # least reachable place, along links and by jumping
            new = np.minimum(label, np.where(full, label[None, :], len(sets)).min(axis=1))
            new = new[new]
            if (new == label).all():
                break
            label = new
        nodes = cell["node"].to_numpy()
        keep = links > 0
        return pd.DataFrame({"node": nodes[keep], "root": nodes[label][keep], "linked": linked[keep]})

    return verify


def near_duplicates(
    docs: DataFrame, least: float = 0.8, size: int = 5, target: float = 0.999,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id``, ``text_key``, ``class_key`` (unique,
    null for texts without words), ``class_id``, ``n_links``, ``class_docs``.

    Texts are linked whose sets of ``size``-word shingles (lower-case words; a shorter text is
    one shingle) have a Jaccard similarity of at least ``least``; a class is a component of the
    links and is named by its least doc_id.  ``n_links`` counts the other rows linked with a row,
    copies included.  Rows with equal text are one node, so null or repeated ids do no harm; a
    class without any id has a null name.  Texts without words are linked with nothing: their
    class is their own id.  The shared words of the whole corpus decide nothing: only whole sets.
    """
    rows = signatures(docs, size)
    nodes = stored(
        rows.filter(F.col("n") > 0).groupBy("text_key").agg(
            F.min("id").alias("first_id"), F.count("*").alias("copies"),
            F.max("n").alias("n"), F.max("paths").alias("paths"),
        ).withColumn("node", F.xxhash64("text_key")),
        "near-nodes",
    )
    texts_of = docs.select(text_of().alias("text")).withColumn("node", F.xxhash64(F.md5("text")))
    groups = components(trie_links(nodes, search_depth(least, target)).drop("depth"))
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(least) + 1e-9).cast("int")
    members = stored(
        nodes.join(groups, "node").select("node", "root", "n", "copies", band.alias("band")),
        "near-members",
    )
    once = (
        texts_of.join(members.select("node"), "node", "left_semi")
        .groupBy("node").agg(F.first("text").alias("text"))
        .select("node", word_hashes(F.col("text")).alias("words"))
    )
    verified = stored(
        _cells(members).join(once, "node")
        .groupBy("root", "band", "one", "other")
        .applyInPandas(_verifier(size, least), "node long, root long, linked long"),
        "near-links",
    )
    classes = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = verified.groupBy("node").agg(F.sum("linked").alias("linked"))
    joined = (
        nodes.select("node", "text_key", "first_id", "copies")
        .join(classes, "node", "left").join(counts, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = joined.groupBy("root").agg(
        F.min("first_id").alias("class_id"), F.sum("copies").alias("class_docs")
    )
    of_text = stored(
        joined.join(named, "root").select(
            "text_key", F.col("root").alias("class_key"), "class_id", "class_docs",
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "near-classes",
    )
    out = rows.select("id", "text_key", "n").join(of_text, "text_key", "left")
    bare = F.col("n") == 0
    return out.select(
        F.col("id").alias("doc_id"), "text_key", "class_key",
        F.when(bare, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(bare, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(bare, F.lit(1)).otherwise(F.col("class_docs")).cast("long").alias("class_docs"),
    )


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of each class: that with the least doc_id.

    Documents without words all stay, as do rows with a null id in a class without any id, one
    each.  Repeated rows count as copies: one stays.  Columns of any name are kept.
    """
    found = near_duplicates(docs, **how)
    chosen = (
        found.filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .groupBy("doc_id", F.coalesce("class_key", F.xxhash64("text_key")).alias("class_key"))
        .agg(F.min("text_key").alias("text_key"))
        .select(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), "text_key").alias("pick"))
    )
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.md5(text_of())).alias("pick"),
    )
    return (
        rows.join(chosen, "pick", "left_semi").dropDuplicates(["pick"]).select("row.*")
    )
