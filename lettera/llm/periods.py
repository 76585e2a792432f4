"""Maximal periodic runs of words, found with a dictionary of basic factors.

Level k of the dictionary names every stretch of 2^k words: equal names, equal words.  A name of
level k+1 is the pair of the names of its halves.  Where a stretch occurs again at most twice its
own length later, the distance is a possible period; neighbouring places with the same distance
form one repetition, which is extended as far as it goes.

A run of smallest period q and of length 4q or more shows at the level with q <= 2^k < 2q: there
a stretch and its next occurrence are exactly q apart (a smaller distance would be a period of
the run itself, by the theorem of Fine and Wilf).  Levels find the same run repeatedly, so runs
are deduplicated.  A stretch that occurs once in its document is left out of the higher levels,
which are empty soon in ordinary prose.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import map_batches, text_of

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
#: Documents are searched together up to about this many words; a longer one alone.
WORDS_AT_ONCE = 200_000

LOW = (1 << 32) - 1


def runs(
    words: np.ndarray, stop: np.ndarray, least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
) -> list[tuple[int, int, int]]:
    """Sorted ``(start, length, period)`` of the runs of several documents laid end to end.

    ``words`` numbers the words, ``stop`` tells for each word where its document ends.
    """
    found: set[tuple[int, int, int]] = set()
    at, name, size = np.arange(len(words)), words.astype(np.int64), 1
    place = np.empty(len(words), np.int64)
    while len(at):
        key = np.sort(name << 32 | at)
        who, where = key >> 32, key & LOW
        again = (who[1:] == who[:-1]) & (stop[where[1:]] == stop[where[:-1]])
        gap = np.diff(where)
        near = again & (gap <= 2 * size)
        start, end, period = progressions(where[:-1][near], gap[near], size)
        # Shorter ones are beginnings that a distance below the period cuts off at this level.
        long = end - start >= np.maximum(least_length, least_exponent * period)
        for one in zip(start[long].tolist(), end[long].tolist(), period[long].tolist(), strict=True):
            found.add(extended(words, stop, *one))
        # Only stretches that occur again in their document can be halves of such ones.
        kept = np.zeros(len(where), bool)
        kept[1:] |= again
        kept[:-1] |= again
        place[:] = -1
        place[where[kept]] = who[kept]
        at = np.sort(where[kept])
        at = at[at + 2 * size <= stop[at]]
        at = at[place[at + size] >= 0]
        name = np.unique(place[at] << 32 | place[at + size], return_inverse=True)[1]
        size *= 2
    return sorted(found)


def progressions(
    start: np.ndarray, gap: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of neighbouring places whose stretches recur at one distance."""
    order = np.argsort(start)
    start, gap = start[order], gap[order]
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(start) != 1) | (np.diff(gap) != 0)
    last = np.roll(first, -1)
    return start[first], start[last] + size + gap[last], gap[first]


def extended(
    words: np.ndarray, stop: np.ndarray, start: int, end: int, period: int
) -> tuple[int, int, int]:
    """Start, length and period with all neighbouring words that keep the period."""
    limit = stop[start]
    while start and stop[start - 1] == limit and words[start - 1] == words[start - 1 + period]:
        start -= 1
    while end < limit and words[end] == words[end - period]:
        end += 1
    return start, end - start, period


def searched(
    rows: list[tuple[dict, list[bytes]]], least_length: int, least_exponent: int
) -> Iterator[dict]:
    """The results of several documents, which share one numbering of their words."""
    number = defaultdict(count().__next__)
    sizes = np.array([len(words) for _, words in rows], np.int64)
    ends = np.cumsum(sizes)
    ids = np.fromiter((number[w] for _, words in rows for w in words), np.int64, sizes.sum())
    of_row = defaultdict(list)
    for start, length, period in runs(ids, np.repeat(ends, sizes), least_length, least_exponent):
        n = int(np.searchsorted(ends, start, "right"))
        of_row[n].append((start - int(ends[n] - sizes[n]), length, period))
    for n, (row, words) in enumerate(rows):
        kept = np.ones(len(words), bool)
        for start, length, period in of_row[n]:
            kept[start + period : start + length] = False
        yield {
            "row": row, "n_words": len(words),
            "runs": [{"start": s, "length": m, "period": q} for s, m, q in of_row[n]],
            "collapsed": b" ".join(compress(words, kept.tolist())).decode(),
        }


def with_runs(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
    least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """``row`` (the columns to ``keep``), ``n_words``, ``runs`` and ``collapsed`` of each row.

    ``runs`` lists start, length and period of every run by start, then period; words are what
    stands between spaces and the characters 9 to 13, numbered from 0.  ``collapsed`` joins by
    one space the words that no run holds after its first period.

    A null or empty text has no words, no runs and an empty ``collapsed``; repeated rows are
    searched each for itself; other columns may have any names; no rows give no rows.  A text
    of any length is searched whole.
    """
    if least_exponent < 3:
        raise ValueError("runs of fewer than three periods can hide from the dictionary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        waiting: list[tuple[dict, list[bytes]]] = []
        total = 0
        for batch in batches:
            for row, value in zip(batch.column(0), batch.column(1), strict=True):
                words = value.as_py().split()
                waiting.append((row.as_py(), words))
                total += len(words)
                if total >= WORDS_AT_ONCE:
                    yield from searched(waiting, least_length, least_exponent)
                    waiting, total = [], 0
        yield from searched(waiting, least_length, least_exponent)

    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), text_of(text).cast("binary").alias("t")
    )
    schema = (
        f"row {rows.schema['row'].dataType.simpleString()}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    return map_batches(rows, work, schema)
