"""What every order of several filters keeps, removes and loses, from one small tensor a part.

The filters' verdicts on a document are bits; a part's documents are counted per combination of
bits, once as they are and once per measure.  These counts form a tensor with one axis of two
places, pass and fail, for each filter.  Any question about an order of filters selects pass,
fail or all along each axis and sums: one contraction of the tensor with a vector per axis,
[1, 0], [0, 1] or [1, 1].  The rows never meet the orders: 2^f counts a part do.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import let, stored, text_of

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
WORD_GAP = r"[\x20\x09-\x0D]+"


def outcomes(tensor: np.ndarray, names: Sequence[str]) -> Iterator[dict]:
    """One row per order and step, from counts shaped (2, ..., 2, measures).

    The first measure counts documents.  ``lost`` gives the others of what a step removes.
    """
    names, axes = list(names), range(len(names))
    steps = [(order, n) for order in permutations(axes) for n in axes]

    def counted(choose) -> np.ndarray:
        """The measures of every step, with ``choose(axis, steps before, its axis)`` selected."""
        chosen = [
            np.array([choose(axis, order[:n], order[n]) for order, n in steps]) for axis in axes
        ]
        step, measure = len(names), len(names) + 1
        operands = [x for axis in axes for x in (chosen[axis], [step, axis])]
        return np.einsum(tensor, [*axes, measure], *operands, [step, measure])

    kept = counted(lambda a, before, own: PASS if a in before or a == own else ALL)
    removed = counted(lambda a, before, own: PASS if a in before else FAIL if a == own else ALL)
    failing = counted(lambda a, before, own: FAIL if a == own else ALL)
    alone = counted(lambda a, before, own: FAIL if a == own else PASS)
    over_all = dict.fromkeys(axes, 0)
    for (order, n), counts in zip(steps, removed, strict=True):
        over_all[order[n]] += int(counts[0])
    for i, (order, n) in enumerate(steps):
        yield {
            "filter_order": "".join(names[a] for a in order), "step": n + 1,
            "kept": int(kept[i, 0]), "removed": int(removed[i, 0]),
            "redundant": int(failing[i, 0] - removed[i, 0]), "unique_fails": int(alone[i, 0]),
            "lost": [int(c) for c in removed[i, 1:]], "shapley": over_all[order[n]],
        }


def audited(
    verdicts: DataFrame, part: str, filters: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """One row per part, order of the filters and step.

    ``verdicts`` has a boolean column per filter (true: fails; null: passes) and one that names
    the part (null: a part of its own); ``measures`` are conditions counted among what a step
    removes, one result column each.  Other results: ``filter_order``, ``step`` from 1, ``kept``
    after the step, ``removed`` by it, ``redundant`` (fails, but went before), ``unique_fails``
    (fails this filter only, whatever the order), ``shapley`` (removed by the step's filter,
    summed over all orders).  Rows count as often as they occur; no rows give no rows.

    Documents are counted before the shuffle, so however large a part is, at most 2^filters
    rows of it leave a task.
    """
    code = sum(
        (F.coalesce(F.col(f"`{f}`"), F.lit(False)).cast("int") * (1 << i) for i, f in enumerate(filters)),
        F.lit(0),
    )
    counts = (
        verdicts.groupBy(F.col(f"`{part}`").alias("part"), code.alias("code"))
        .agg(F.count(F.lit(1)).alias("n0"), *(
            F.count_if(c).alias(f"n{i}") for i, c in enumerate(measures.values(), 1)
        ))
    )
    wide, names = len(measures) + 1, list(measures)

    def contracted(rows: pd.DataFrame) -> pd.DataFrame:
        flat = np.zeros((1 << len(filters), wide), np.int64)
        flat[rows["code"]] = rows[[f"n{i}" for i in range(wide)]]
        # The first axis of the reshaped tensor is the highest bit.
        tensor = flat.reshape([2] * len(filters) + [wide]).transpose(
            [*reversed(range(len(filters))), len(filters)]
        )
        out = pd.DataFrame(outcomes(tensor, filters))
        out[names] = out.pop("lost").tolist()
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    kind = counts.schema["part"].dataType.simpleString()
    return counts.groupBy("part").applyInPandas(
        contracted,
        f"part {kind}, filter_order string, step int, kept long, removed long, redundant long, "
        "unique_fails long, shapley long" + "".join(f", `{n}` long" for n in names),
    )


def text_verdicts(docs: DataFrame) -> DataFrame:
    """Stored ``doc_id``, ``part`` and the verdicts of five filters, A to E, true where it fails.

    A: under 200 words.  B: fewer than half of the words are different.  C: capitals A to Z are
    more than 3 % of the characters.  D: holds one of ``#$%&*|``.  E: a smaller ``doc_id`` has
    the same text.  Null texts are empty, and empty texts are equal; a row without ``doc_id``
    never fails E, nor do repeated rows of the smallest one.

    Copies are found by digest: a group shrinks to its smallest id before the shuffle, and rows
    look for themselves by digest and id together, so that no group gathers in a task.
    """
    text = text_of()
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    judged = stored(
        docs.select(
            "doc_id",
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.length(F.regexp_replace(text, "[^A-Z]", "")).alias("capitals"),
            F.length(text).alias("length"),
            text.rlike("[#$%&*|]").alias("D"),
            let(words, lambda w: F.struct(
                F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("different")
            )).alias("words"),
        ).select(
            "doc_id", "part", "digest", "D",
            (F.col("words.all") < 200).alias("A"),
            (100 * F.col("words.different").cast("long") < 50 * F.col("words.all").cast("long")).alias("B"),
            (100 * F.col("capitals").cast("long") > 3 * F.col("length").cast("long")).alias("C"),
        ),
        "audit-verdicts",
    )
    first = judged.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    return judged.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", "A", "B", "C", "D",
        (F.col("first").isNull() & F.col("doc_id").isNotNull()).alias("E"),
    )


def with_labels(verdicts: DataFrame, labels: DataFrame) -> DataFrame:
    """``good`` and ``toxic``: whether ``labels`` has quality 1, toxic 1 for the document.

    Several labels of one document count as one that says all they say; none: false.
    """
    of_doc = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    return verdicts.join(of_doc, "doc_id", "left")
