"""Packing of tokenised documents into sequences by minimum bin slack.

The bins depend on the lengths alone, and there are no more different lengths than tokens in a
sequence.  So the driver sees one count per length.  It fills bins from those counts: the longest
length left starts a bin, a subset sum over the lengths left, kept as the bits of an integer,
finds the fullest completion, and the same combination is taken as often as the counts allow.
The pieces, numbered within their length, are then dealt to the bins by a join.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettera.llm.common import map_batches, stored, text_of, texts

TOKENIZER = "byte_bpe_50k"
END = 0
#: Chunks of text whose ids a worker remembers.
REMEMBERED = 150_000


class Encoder:
    """Ids of the byte-level vocabulary ``name``, as the ``tokenizers`` library gives them.

    A single space between two other characters always begins a new token, so a text is cut
    there and the ids of a chunk are remembered.  Texts with other white space next to a space,
    or with the name of a special token, are encoded whole by the library itself.
    """

    def __init__(self, name: str) -> None:
        import base64

        import public_tokenizers as places
        import tiktoken
        from tokenizers import Tokenizer

        with open(places.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        chunk = tiktoken.Encoding(
            name, pat_str=places.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.library = Tokenizer.from_file(places.path(f"{name}.json"))
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

        class Chunks(dict):
            def __missing__(self, text: str) -> bytes:
                ids = np.array(chunk(" " + text), "<u4").tobytes()
                if len(self) < REMEMBERED and len(text) < 100:
                    self[text] = ids
                return ids

        self.chunks, self.first = Chunks(), chunk

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        head, *rest = text.split(" ")
        if not rest:
            return np.array(self.first(text), "<u4")
        if not head or head[-1].isspace() or any(not r or r[0].isspace() or r[-1].isspace() for r in rest):
            return np.array(self.first(text), "<u4")
        first = np.array(self.first(head), "<u4").tobytes()
        return np.frombuffer(first + b"".join(map(self.chunks.__getitem__, rest)), "<u4")


@cache
def encoder_of(name: str) -> Encoder:
    """The worker's one encoder of a vocabulary, kept from task to task."""
    return Encoder(name)


def pieces(docs: DataFrame, capacity: int, tokenizer: str = TOKENIZER) -> DataFrame:
    """Stored pieces: doc_id, piece, start, length, ids_crc32, and their place in the table.

    A document is its ids and the end id.  One longer than ``capacity`` is cut from its end, so
    only its first piece may be shorter.  ``part`` and ``nth`` number the pieces of one length.
    """
    def work(batches):
        encoder, task = encoder_of(tokenizer), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            for doc, text in zip(batch.column(0), texts(batch, "text"), strict=True):
                ids = np.append(encoder.ids(text), np.uint32(END)).astype("<u4")
                first = len(ids) % capacity or capacity
                ends = range(first, len(ids) + 1, capacity)
                for n, end in enumerate(ends):
                    start = 0 if n == 0 else end - capacity
                    raw = ids[start:end].tobytes()
                    nth = seen[end - start] = seen.get(end - start, -1) + 1
                    yield {
                        "doc_id": doc.as_py(), "piece": n, "start": start, "length": end - start,
                        "ids_crc32": zlib.crc32(raw), "part": task, "nth": nth,
                    }

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return stored(
        map_batches(rows, work, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                "part int, nth long"),
        "packing-pieces",
    )


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, none oftener than ``counts`` has it, with the largest sum up to ``room``.

    Bit s of ``reach`` tells whether the lengths so far can sum to s.  Lengths enter from the
    longest on, several of one as blocks of 1, 2, 4 ... pieces; the way back takes a block
    wherever its sum couldn't be reached without it.
    """
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, block = min(counts[length], room // length), 1
        while left:
            block = min(block, left)
            grown = (reach | reach << (length * block)) & mask
            if grown != reach:
                steps.append((length, block, reach))
                reach = grown
            left, block = left - block, block * 2
        if reach >> room & 1:
            break
    want, out = reach.bit_length() - 1, []
    for length, block, before in reversed(steps):
        if not before >> want & 1:
            out += [length] * block
            want -= length * block
    return out


def bins(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how many bins each fills, until no length is left."""
    left = {n: c for n, c in counts.items() if c}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = fullest({n: c for n, c in left.items() if c}, capacity - longest)
        left[longest] += 1
        lengths = sorted([longest, *rest], reverse=True)
        times = min(left[n] // lengths.count(n) for n in set(lengths))
        for n in lengths:
            left[n] -= times
        left = {n: c for n, c in left.items() if c}
        out.append((lengths, times))
    return out


def packed(docs: DataFrame, capacity: int = 2048, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece with its sequence and offset: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    Every row of ``docs`` (doc_id, text) is a document of its own, so repeated rows and null ids
    are packed like any other; a null or empty text is the end id alone.  No rows: no pieces.
    """
    spark = docs.sparkSession
    found = pieces(docs, capacity, tokenizer)
    per_part = stored(found.groupBy("part", "length").agg(F.count("*").alias("c")), "packing-counts")
    counts = {r["length"]: r["c"] for r in per_part.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    rows, sequence, used = [], 0, dict.fromkeys(counts, 0)
    for lengths, times in bins(counts, capacity):
        offset = 0
        for n in dict.fromkeys(lengths):
            each = lengths.count(n)
            rows.append((n, used[n], used[n] + times * each, each, sequence, offset))
            used[n] += times * each
            offset += n * each
        sequence += times
    table = "length long, `from` long, `to` long, each long, first long, at long"
    plan = spark.createDataFrame(rows, table)
    base = per_part.select(
        "part", "length",
        (F.sum("c").over(Window.partitionBy("length").orderBy("part")) - F.col("c")).alias("base"),
    )
    numbered = found.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    # As many rows as lengths and combinations: bounded by the capacity, not by the input.
    placed = numbered.join(
        F.broadcast(plan.withColumnRenamed("length", "l")),
        (F.col("length") == F.col("l")) & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("to")),
    )
    slot = F.col("rank") - F.col("from")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(slot / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.col("length") * (slot % F.col("each"))).cast("long").alias("offset"),
    )
