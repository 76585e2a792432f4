"""Packing by deficit round-robin over source queues, so that sequences mix the sources.

Each source is a queue of packets: documents, cut where they are longer than a window.  A window
is one sequence long and gives each queue a quantum, its target share of the window's tokens.  A
queue adds the quantum to its deficit and sends packets while the deficit covers them; what is
left is carried into the next window.  An empty queue sends nothing more and leaves its turn to
the others.  The packets in the order sent, cut every 4,096 tokens, are the sequences.

A queue's deficit after window r is r quanta less what it sent, so a packet leaves in the first
window whose quanta reach its end in the queue.  That needs no loop over windows: it takes the
packet's end in its queue, which is its end within the task that cut it plus what the source has
in the tasks before.  So deficits are carried across tasks as exactly as across windows.  Where a
packet stands among all sent is a running sum, taken in blocks of windows, and blocks of blocks.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettera.llm.common import map_batches, stored, text_of

TOKENIZER = "word_bpe_49k"
END = 2
#: Chunks between spaces, and words, whose ids a worker remembers; others are encoded again.
REMEMBERED = 400_000
#: Windows whose packets are put in order together, and such blocks whose sums are.
BLOCK_WINDOWS = 256
BLOCK_BLOCKS = 4096
#: Printable ASCII and Western European letters: no white space, no combining marks, and each
#: capital has one small letter, whatever stands beside it.
WESTERN = re.compile(r"[!-~\u00c0-\u00ff]+")
#: What the vocabulary's splitter matches in such a text in lower case.
WESTERN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Remembered(dict):
    """Results of ``work`` for as many different, short texts as there is room for."""

    def __init__(self, work) -> None:
        super().__init__()
        self.work = work

    def __missing__(self, text: str) -> bytes:
        ids = self.work(text)
        if len(self) < REMEMBERED and len(text) < 64:
            self[text] = ids
        return ids


class WordEncoder:
    """Ids of a vocabulary of words, as the ``tokenizers`` library gives them, in two bytes each.

    White space is dropped before the merges and no rule looks across it, so a text is cut at
    spaces and line ends, and the ids of a chunk are remembered.  New chunks of Western letters
    and ASCII signs are split into words here and only words are merged by the library; all
    others, and those that may hold a special token, are left to the library whole.
    """

    def __init__(self, name: str) -> None:
        import public_tokenizers as places
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(places.path(f"{name}.json"))
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("the ids of this vocabulary don't fit into two bytes")
        self.merge = self.library.model.tokenize
        # Byte-level vocabularies write a byte as its own sign, or as one from 256 on.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        signs = iter(range(256, 512))
        self.signs = {b: b if b in shown else next(signs) for b in range(256)}
        self.words = Remembered(self.word)
        self.chunks = Remembered(self.chunk)

    def word(self, text: str) -> bytes:
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.signs)
        return array("H", [t.id for t in self.merge(text)]).tobytes()

    def chunk(self, text: str) -> bytes:
        if not text:
            return b""
        if WESTERN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.words.__getitem__, WESTERN_WORD.findall(text.lower())))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


@cache
def encoder_of(name: str) -> WordEncoder:
    """The worker's one encoder of a vocabulary, kept from task to task."""
    return WordEncoder(name)


def packets(docs: DataFrame, window: int, source: str, tokenizer: str, end: int) -> DataFrame:
    """Stored packets of at most ``window`` tokens, with their place in the part of their queue.

    ``part`` is the task that cut the packet and ``at`` the tokens of the same source before it
    there.  ``queue`` names the source; null is a queue of its own.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder, task = encoder_of(tokenizer), TaskContext.get().partitionId()
        sent: dict[str, int] = {}
        last = np.array([end], "<u2").tobytes()
        for batch in batches:
            for doc, text, queue in zip(*(batch.column(i) for i in range(3)), strict=True):
                ids, queue = encoder.ids(text.as_py()) + last, queue.as_py()
                for start in range(0, len(ids), 2 * window):
                    piece, at = ids[start : start + 2 * window], sent.get(queue, 0)
                    yield {
                        "doc_id": doc.as_py(), "doc_tokens": len(ids) // 2, "start": start // 2,
                        "length": len(piece) // 2, "ids": piece,
                        "queue": queue, "part": task, "at": at,
                    }
                    sent[queue] = at + len(piece) // 2

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
        F.when(F.col(f"`{source}`").isNull(), "").otherwise(
            F.concat(F.lit("="), F.col(f"`{source}`").cast("string"))
        ).alias("queue"),
    )
    schema = (
        "doc_id long, doc_tokens long, start long, length long, ids binary, queue string, "
        "part int, at long"
    )
    return stored(map_batches(rows, work, schema, rows=500), "mixture-packets")


def running(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """``before``: the sum of ``value`` in the rows before, in the order given, within a group."""
    upto = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(value).over(upto), F.lit(0)))


def block_starts(lengths: DataFrame) -> DataFrame:
    """``block`` and ``block_start``: the tokens in all blocks before it."""
    blocks = lengths.groupBy("block").agg(F.sum("length").alias("tokens")).withColumn(
        "group", F.floor(F.col("block") / BLOCK_BLOCKS)
    )
    # One row per 4,096 blocks of 256 windows, some 4 * 10^9 tokens: few, whatever the input.
    groups = blocks.groupBy("group").agg(F.sum("tokens").alias("tokens")).withColumn("all", F.lit(0))
    firsts = running(groups, "all", ["group"], "tokens").select("group", F.col("before").alias("first"))
    return running(blocks, "group", ["block"], "tokens").join(firsts, "group").select(
        "block", (F.col("first") + F.col("before")).alias("block_start")
    )


def mixed(
    docs: DataFrame, capacity: int = 4096, source: str = "source",
    targets: Mapping[str | None, int] | None = None, tokenizer: str = TOKENIZER, end: int = END,
) -> DataFrame:
    """One row per piece: doc_id, source, start, length, ids_crc32, doc_tokens, window,
    sequence_id, offset.

    ``targets`` weighs the sources, 1 for a source it doesn't name; without it each source has
    its share of all tokens, so that every window looks like the whole table to the end.  After
    any window a source is less than one packet behind its target, as long as it lasts.

    Every sequence but the last ones is full.  The tokens after the last full sequence are laid
    into sequences of falling powers of two, so that none is padded.

    Every row (doc_id, text, source) is a document of its own, so repeated rows and null ids are
    packed like any other; a null or empty text is the end id alone, a null source is a source.
    Longer documents are cut every ``capacity`` tokens, and any packet where a sequence ends.
    No rows: no pieces.
    """
    found = packets(docs, capacity, source, tokenizer, end)
    per_part = found.groupBy("queue", "part").agg(F.sum("length").alias("tokens"))
    queues = running(per_part, "queue", ["part"], "tokens").select(
        "queue", "part", "before",
        F.sum("tokens").over(Window.partitionBy("queue")).alias("total"),
    )
    if targets is None:
        weight = F.col("total")
    else:
        weight = F.lit(1)
        for name, share in targets.items():
            if share < 1:
                raise ValueError("targets are whole numbers from 1")
            weight = F.when(F.col("queue") == ("" if name is None else f"={name}"), share).otherwise(weight)
    queues = stored(queues.withColumn("weight", weight.cast("long")), "mixture-queues")
    sums = queues.dropDuplicates(["queue"]).agg(
        F.sum("weight").alias("weights"), F.sum("total").alias("tokens")
    ).first()
    weights, tokens = sums["weights"] or 1, sums["tokens"] or 0

    # The window in which the quanta reach the packet's end; whole numbers of up to 38 digits.
    exact = "decimal(20,0)"
    until = (F.col("before") + F.col("at") + F.col("length")).cast(exact) * F.lit(weights).cast(exact)
    quantum = F.col("weight").cast(exact) * F.lit(capacity).cast("decimal(10,0)")
    placed = (
        found.join(queues.select("queue", "part", "before", "weight"), ["queue", "part"])
        .withColumns({"until": until, "quantum": quantum})
        .withColumn("window", F.expr("(until + quantum - 1) div quantum - 1"))
        .withColumn("place", F.col("before") + F.col("at"))
        .withColumn("block", F.floor(F.col("window") / BLOCK_WINDOWS))
        .drop("until", "quantum", "before", "at", "weight", "part")
    )
    ordered = running(placed, "block", ["window", "queue", "place"], "length").join(
        block_starts(placed.select("block", "length")), "block"
    )
    sent = ordered.withColumn("position", F.col("block_start") + F.col("before")).select(
        "doc_id", "doc_tokens", "start", "length", "ids", "queue", "window", "position"
    )
    full = tokens // capacity
    borders = [full * capacity]
    for bit in reversed(range(capacity.bit_length())):
        if (tokens - full * capacity) >> bit & 1:
            borders.append(borders[-1] + (1 << bit))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for values in zip(*batch.columns, strict=True):
                row = {f.name: v.as_py() for f, v in zip(batch.schema, values, strict=True)}
                ids = np.frombuffer(row["ids"], "<u2").astype("<u4")
                done = 0
                while done < len(ids):
                    at = row["position"] + done
                    sequence = at // capacity
                    begin, finish = sequence * capacity, (sequence + 1) * capacity
                    if sequence >= full:
                        n = int(np.searchsorted(borders, at, "right")) - 1
                        sequence, begin, finish = full + n, borders[n], borders[n + 1]
                    piece = ids[done : done + finish - at]
                    yield {
                        "doc_id": row["doc_id"], "source": row["queue"][1:] if row["queue"] else None,
                        "start": row["start"] + done, "length": len(piece),
                        "ids_crc32": zlib.crc32(piece.tobytes()), "doc_tokens": row["doc_tokens"],
                        "window": row["window"], "sequence_id": sequence, "offset": at - begin,
                    }
                    done += len(piece)

    return map_batches(
        sent, cut, "doc_id long, source string, start long, length long, ids_crc32 long, "
                   "doc_tokens long, window long, sequence_id long, offset long",
    )
