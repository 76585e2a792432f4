"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into overlapping passages of words, weighted by TF-IDF over hashed words, and
projected onto the leading right singular vectors of the matrix of all passages, found by a randomised
SVD whose products are sums over the tasks.  Passages near a benchmark item in that space are
candidates; a longest common subsequence with the item and a check of the item's most telling
words (its answer) decide.  An item longer than ``RUN`` words is judged by overlapping runs of its
words as well, so a part of it is found.  Items are queries: they are taken a block at a time, each block
against all passages, so what travels to the tasks has a fixed bound.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import map_batches, rows_of, stored, text_of

FEATURES = 1 << 16
RANK, EXTRA = 96, 16
#: Texts whose words are cut at once.
TEXTS = 1000
WORD_BREAK = r"[^\p{L}\p{N}_]+"
#: A passage is two strides long.
PASSAGE, STRIDE = 24, 12
#: Items of more words are judged by runs of so many as well, which begin at every second stride:
#: of any ``RUN + 2 * STRIDE`` words of an item in a row, a whole run is part.
RUN = 3 * PASSAGE
#: The weight of the benchmark's own passages in the fitted matrix, so the space can tell items apart:
#: the weight of an item among ``FIT_DOCS`` texts and items.  All are fitted, and among more of them
#: items keep their share of the matrix.
ITEM_WEIGHT, FIT_DOCS = 20.0, 1000
#: Words of a text that are projected at once.
CHUNK = 16_380
#: Words of texts that are multiplied at once in the fit, and words that a task of it has at least: the
#: sums it sends on have a fixed size, 29 MB, which stays below what it reads.
FIT_BLOCK, FIT_WORDS = 1 << 19, 1 << 24
#: Rows that are summed one after the other, and sums that are worked on together.
GROUP, SUMS = 64, 1024
#: Rows of the summed product that travel together.
SUM_ROWS = 2048
#: Passage vectors of a block of items, of all its items and their runs: some 16 MB in a task.
BLOCK_VECTORS = 65_536
#: A candidate's least cosine; a match's least share of the item in order, and of its telling words.
COSINE, IN_ORDER, ANSWER = 0.35, 0.75, 0.6


def _hashes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the values that aren't empty, and which are not: each is cut out of the array's buffer."""
    if not len(values):
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int32)[values.offset : values.offset + len(values) + 1]
    filled, data = np.diff(ends) > 0, data.to_pybytes() if data else b""
    cuts = zip(ends[:-1][filled].tolist(), ends[1:][filled].tolist(), strict=True)
    return np.fromiter((zlib.crc32(data[a:b]) for a, b in cuts), np.uint32, np.count_nonzero(filled)), filled


def hashed(column: pa.Array) -> Iterator[np.ndarray]:
    """32-bit hashes of the lower-case words (letters, digits, underscores) of each whole text.

    Arrow cuts the texts and tells the words apart, ``TEXTS`` texts at a time, so each different
    word of them is hashed once.  They are cut at white space first: only different pieces are
    looked at letter by letter.
    """
    for at in range(0, len(column), TEXTS):
        lists = pc.ascii_split_whitespace(pc.utf8_lower(column.slice(at, TEXTS)))
        coded = lists.flatten().dictionary_encode()
        parts = pc.split_pattern_regex(coded.dictionary, WORD_BREAK)
        own, filled = _hashes_of(parts.flatten().cast(pa.binary()))
        # Where the words of each different piece begin and end among all of them.
        past = np.append(0, np.cumsum(filled))
        ends = past[np.append(0, np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False)))]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        number = np.diff(ends)[codes]
        past = np.append(0, np.cumsum(number))
        found = own[np.repeat(ends[codes] - past[:-1], number) + np.arange(past[-1])]
        ends = past[np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))]
        for first, last in zip(ends[:-1], ends[1:], strict=True):
            yield found[first:last]


def word_table(docs: DataFrame, key: str) -> DataFrame:
    """Stored ``id`` and ``words`` (hashes, four bytes each) for texts with any words."""
    def work(batches) -> Iterator[dict]:
        for batch in batches:
            for i, ws in zip(batch.column(0), hashed(batch.column(1)), strict=True):
                if len(ws):
                    yield {"id": i.as_py(), "words": ws.astype("<u4").tobytes()}

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), text_of().alias("text"))
    return stored(map_batches(rows, work, "id long, words binary"), "decontaminate-words")


def _arrays(batch, column: str = "words", kind="<u4") -> Iterator[np.ndarray]:
    values = batch.column(batch.schema.get_field_index(column))
    return (np.frombuffer(v.as_buffer(), kind) for v in values)


def idf(words: DataFrame) -> tuple[np.ndarray, int, int]:
    """Inverse document frequency of each feature over all texts, their number and that of their words."""
    def work(batches) -> Iterator[dict]:
        total, n, length = np.zeros(FEATURES, np.int64), 0, 0
        for batch in batches:
            for ws in _arrays(batch):
                # A feature that repeats in the index is counted once.
                total[ws % FEATURES] += 1
                n += 1
                length += len(ws)
        for at in np.flatnonzero(total):
            yield {"feature": int(at), "n": int(total[at])}
        yield {"feature": -1, "n": n}
        yield {"feature": -2, "n": length}

    sums = map_batches(words.select("words"), work, "feature int, n long", rows=20_000)
    # A row per feature at most, as columns: objects for each would take ten times as much.
    counts = sums.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    feature, number = (counts.column(c).to_numpy() for c in ("feature", "n"))
    out, n, length = np.zeros(FEATURES), number[feature == -1].sum(), number[feature == -2].sum()
    out[feature[feature >= 0]] = number[feature >= 0]
    return np.log((n + 1) / (out + 1)).astype(np.float32) + np.float32(0.05), int(n), int(length)


def starts(n: int) -> np.ndarray:
    """Where the passages of a text of ``n`` words begin; the last ends with the text."""
    return np.unique(np.append(np.arange(0, max(n - PASSAGE, 0) + 1, STRIDE), max(n - PASSAGE, 0)))


def passage_vectors(words: np.ndarray, scaled: np.ndarray):
    """Starts of the passages and their projections: sums of a stride's words, two at a time.

    ``scaled`` is the basis with each feature's row times its weight.
    """
    begin, rows = starts(len(words)), scaled[words % FEATURES]
    if len(words) <= PASSAGE:
        return begin, rows.sum(axis=0, keepdims=True)
    whole = len(words) // STRIDE
    steps = rows[: whole * STRIDE].reshape(whole, STRIDE, -1).sum(axis=1)
    vectors = steps[:-1] + steps[1:]
    if len(begin) > len(vectors):
        vectors = np.concatenate([vectors, rows[-PASSAGE:].sum(axis=0, keepdims=True)])
    return begin, vectors


def singular_vectors(words: DataFrame, weights: np.ndarray, rank: int, seed: int = 11) -> np.ndarray:
    """The leading right singular vectors of the passages' TF-IDF matrix A, each divided by its
    singular value, so that what all passages share doesn't drown the rest: features by rank.

    ``words`` has ``words`` and ``weight``, the weight of a text's passages.  Randomised: a
    Gaussian test matrix is multiplied by A and then by its transpose, twice, with an orthonormal
    basis between.  Every passage of every text is part of both.  A task sums the products of its
    passages; the sum over tasks has a fixed size, features by ``rank + EXTRA``.
    """
    spark = words.sparkSession
    width = rank + EXTRA
    # The driver holds the basis and the product in single precision and works on SUM_ROWS of them.
    random, blocks = np.random.default_rng(seed), range(0, FEATURES, SUM_ROWS)
    basis = np.empty((FEATURES, width), np.float32)
    for at in blocks:
        basis[at : at + SUM_ROWS] = random.standard_normal((SUM_ROWS, width))
    for _ in range(2):
        shared = spark.sparkContext.broadcast((weights, basis))

        def work(batches, shared=shared) -> Iterator[dict]:
            weights, basis = shared.value
            total, scaled = np.zeros(basis.shape, np.float32), _aligned(*basis.shape)
            np.multiply(basis, weights[:, None], out=scaled)
            for block in _fit_blocks(batches):
                _add_products(total, *block, scaled)
            total *= weights[:, None]
            for at in range(0, FEATURES, SUM_ROWS):
                if total[at : at + SUM_ROWS].any():
                    yield {"at": at, "v": total[at : at + SUM_ROWS].tobytes()}

        def added(batches) -> Iterator[dict]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for at, v in zip(batch.column(0).to_pylist(), _arrays(batch, "v", np.float32), strict=True):
                    whole = sums.setdefault(at, np.zeros(len(v)))
                    whole += v
            for at, whole in sums.items():
                yield {"at": at, "v": whole.astype(np.float32).tobytes()}

        parts = map_batches(words.select("words", "weight"), work, "at int, v binary", rows=4)
        # Added as they come: what a task holds doesn't grow with the number of parts.
        whole = map_batches(parts.repartition("at"), added, "at int, v binary", rows=4)
        z, gram = np.zeros((FEATURES, width), np.float32), np.zeros((width, width))
        for r in whole.toLocalIterator():
            z[r["at"] : r["at"] + SUM_ROWS] = np.frombuffer(bytes(r["v"]), np.float32).reshape(-1, width)
        # z = U S V' by way of its Gram matrix; S holds the squares of A's singular values.
        for at in blocks:
            rows = z[at : at + SUM_ROWS].astype(np.float64)
            gram += rows.T @ rows
        squares, turn = np.linalg.eigh(gram)
        squares, turn = np.maximum(squares[::-1], 1e-12), turn[:, ::-1]
        for at in blocks:
            rows = z[at : at + SUM_ROWS].astype(np.float64)
            basis[at : at + SUM_ROWS] = rows @ turn / np.sqrt(squares)
        del z
        shared.unpersist()
    out = np.empty((FEATURES, rank), np.float32)
    for at in blocks:
        out[at : at + SUM_ROWS] = (basis[at : at + SUM_ROWS] / squares ** 0.25)[:, :rank]
    return out


def pieces(n: int) -> Iterator[tuple[int, int]]:
    """Begin and end of pieces of some ``CHUNK`` words of a text: each of its passages is one of a piece."""
    at = 0
    while n - at > CHUNK + PASSAGE:
        yield at, at + CHUNK + STRIDE
        at += CHUNK
    yield at, n


def _fit_blocks(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in pieces, some ``FIT_BLOCK`` words at a time: the words, and lengths and weights of the pieces."""
    held, weights, n = [], [], 0
    for batch in batches:
        for ws, weight in zip(_arrays(batch), batch.column(1).to_pylist(), strict=True):
            for first, last in pieces(len(ws)):
                held.append(ws[first:last]), weights.append(weight)
                n += last - first
                if n >= FIT_BLOCK:
                    yield np.concatenate(held), np.array(list(map(len, held))), np.array(weights, np.float32)
                    held, weights, n = [], [], 0
    if held:
        yield np.concatenate(held), np.array(list(map(len, held))), np.array(weights, np.float32)


def cells(lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Texts in cells, whose words are part of the same passages, for texts one after the other.

    A cell is a stride, but for the one in which the last passage begins, which is cut there, and
    the last.  Begin and size of the cells; first cell, number of cells and text of the passages.
    """
    whole, short = lengths // STRIDE, lengths <= PASSAGE
    rest = np.where(short, 0, lengths % STRIDE)
    number = np.where(short, -(-lengths // STRIDE), whole + 2 * (rest > 0))
    text, first = np.repeat(np.arange(len(lengths)), number), np.cumsum(number) - number
    k, left = np.arange(len(text)) - first[text], rest[text]
    begin = (np.cumsum(lengths) - lengths)[text] + STRIDE * k
    begin -= np.where(left > 0, STRIDE * (k >= whole[text]) + (STRIDE - left) * (k == whole[text] - 1), 0)
    passages = np.where(short, 1, whole - 1 + (rest > 0))
    owner = np.repeat(np.arange(len(lengths)), passages)
    j = np.arange(len(owner)) - (np.cumsum(passages) - passages)[owner]
    cut = (rest[owner] > 0) & (j >= whole[owner] - 3)
    of = np.where(short[owner], number[owner], 2 + cut)
    return begin, np.diff(np.append(begin, lengths.sum())), first[owner] + j, of, owner


def _aligned(n: int, width: int) -> np.ndarray:
    """Room for ``n`` rows that begins with a cache line: a row that is cut by more of them takes longer."""
    room = np.empty(n * width + 16, np.float32)
    first = -room.ctypes.data % 64 // 4
    return room[first : first + n * width].reshape(n, width)


def group_sums(rows: np.ndarray, which: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each group the sum of ``rows[which[first : first + size]]``; no group is empty.

    The first rows of many groups are taken together, then the second ones and so on, so few rows
    are held.  Groups of more than ``GROUP`` are cut, and the sums of their parts summed again.
    """
    parts = -(-size // GROUP)
    if (parts > 1).any():
        begin = np.cumsum(parts) - parts
        past = (np.arange(parts.sum()) - np.repeat(begin, parts)) * GROUP
        sums = group_sums(
            rows, which, np.repeat(first, parts) + past, np.minimum(np.repeat(size, parts) - past, GROUP)
        )
        return group_sums(sums, np.arange(len(sums)), begin, parts)
    out, some, held = (_aligned(n, rows.shape[1]) for n in (len(size), SUMS, SUMS))
    longest_first = np.argsort((GROUP - size).astype(np.uint8), kind="stable")
    for low in range(0, len(size), SUMS):
        mine = longest_first[low : low + SUMS]
        begin, n = first[mine], size[mine]
        total = np.take(rows, which[begin], axis=0, out=some[: len(mine)], mode="clip")
        for k in range(1, n[0]):
            m = np.count_nonzero(n > k)
            total[:m] += np.take(rows, which[begin[:m] + k], axis=0, out=held[:m], mode="clip")
        out[mine] = total
    return out


def _add_products(
    total: np.ndarray, words: np.ndarray, lengths: np.ndarray, weights: np.ndarray, scaled: np.ndarray
) -> None:
    """Adds to ``total`` the transpose of the passages' matrix times its product with the basis, but
    for the weights of the features on the left; ``weights`` are those of the texts."""
    begin, size, first, of, owner = cells(lengths)
    feature = (words % FEATURES).astype(np.uint16)
    y = group_sums(scaled, feature, begin, size)
    y = group_sums(y, np.arange(len(y)), first, of) * weights[owner][:, None]
    # A cell is part of passages in a row: the first that ends after it to the last that begins by it.
    low, high = (np.searchsorted(x, np.arange(len(size)), "right") for x in (first + of, first))
    rows = group_sums(y, np.arange(len(y)), low, high - low)
    order = np.argsort(feature, kind="stable")
    feature, cell = feature[order], np.repeat(np.arange(len(size)), size)[order]
    at = np.flatnonzero(np.append(True, feature[1:] != feature[:-1]))
    total[feature[at]] += group_sums(rows, cell, at, np.diff(np.append(at, len(feature))))


def in_order(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, with the states of a row in one integer."""
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b.tolist():
        if m := where.get(w):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def runs(n: int) -> list[tuple[int, int]]:
    """Begin and end of the parts by which an item of ``n`` words is judged: all of it, and its runs."""
    if n <= RUN:
        return [(0, n)]
    begins = sorted({*range(0, n - RUN, 2 * STRIDE), n - RUN})
    return [(0, n), *((b, b + RUN) for b in begins)]


class Items:
    """A block of benchmark items, ready to be searched for: whole and in runs."""

    def __init__(self, ids, words: list[np.ndarray], weights: np.ndarray, basis: np.ndarray) -> None:
        self.ids, self.scaled = ids, basis * weights[:, None]
        vectors, owner, place, telling = [], [], [], []
        self.words: list[np.ndarray] = []
        self.lengths = list(map(len, words))
        #: The item of each part.
        self.item: list[int] = []
        for i, whole in enumerate(words):
            for first, last in runs(len(whole)):
                ws = whole[first:last]
                begin, v = passage_vectors(ws, self.scaled)
                vectors.append(v), owner.extend([len(self.words)] * len(begin)), place.extend(begin.tolist())
                self.words.append(ws), self.item.append(i)
                own = np.unique(ws)
                rare = np.argsort(-weights[own % FEATURES], kind="stable")
                telling.append(own[rare[: max(1, len(own) // 2)]])
        self.vectors = _unit(np.concatenate(vectors))
        self.owner, self.place = np.array(owner), np.array(place)
        self.part = np.repeat(np.arange(len(telling)), list(map(len, telling)))
        self.all_telling = np.concatenate(telling) % FEATURES
        self.sizes = np.array(list(map(len, telling)))
        self.telling = [frozenset(t.tolist()) for t in telling]

    def matches(self, words: np.ndarray) -> Iterator[tuple[int, int, int, float, float, float]]:
        """Item, begin, end, cosine, share in order, share of the telling words, for each found.

        The figures are those of the whole item if it is found, else of its run with the greatest share.
        """
        present = np.zeros(FEATURES, bool)
        present[words % FEATURES] = True
        # A part can't match a text that lacks its telling words.
        here = np.bincount(self.part[present[self.all_telling]], minlength=len(self.sizes))
        may = here >= ANSWER * self.sizes - 1e-9
        if not may.any():
            return
        mine = np.flatnonzero(may[self.owner])
        vectors = self.vectors[mine]
        best: dict[int, tuple[tuple[bool, float], int, int, float, float]] = {}
        for low in range(0, len(words), CHUNK):
            part = words[low : low + CHUNK + PASSAGE]
            begin, v = passage_vectors(part, self.scaled)
            cosine = _unit(v) @ vectors.T
            for p, q in np.argwhere(cosine >= COSINE):
                part_of, at = int(self.owner[mine[q]]), low + int(begin[p])
                i, item = self.item[part_of], self.words[part_of]
                # The part would begin about here; a passage more on either side is looked at.
                first = max(0, at - int(self.place[mine[q]]) - PASSAGE)
                last = min(len(words), first + len(item) + 2 * PASSAGE)
                near = words[first:last]
                answer = len(self.telling[part_of].intersection(near.tolist())) / len(self.telling[part_of])
                if answer < ANSWER:
                    continue
                share = in_order(item, near) / len(item)
                rank = (len(item) == self.lengths[i], share)
                if share >= IN_ORDER and (i not in best or rank > best[i][0]):
                    best[i] = (rank, first, last, float(cosine[p, q]), answer)
        for i, ((_, share), first, last, cosine, answer) in best.items():
            yield i, first, last, cosine, share, answer


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """Stored pairs of a text and a benchmark item found in it.

    Columns: ``key``, item_id, begin, end (of the searched words, counted from 0), cosine,
    in_order, answer.  ``docs`` needs ``key`` and text, ``benchmark`` item_id and text.  Null or
    empty texts and items have no words and match nothing; repeated rows give repeated pairs; an
    empty table gives none.  The space is fitted to every passage of every text and item, and every
    passage of every text is searched.
    """
    spark = docs.sparkSession
    schema = f"`{key}` long, item_id long, begin long, end long, cosine double, in_order double, answer double"
    words = word_table(docs, key)
    items = word_table(benchmark.select("item_id", "text"), "item_id")
    items = stored(items.withColumn("number", F.monotonically_increasing_id()), "decontaminate-items")
    # Dealt by the hash of a number: repeated items can't fill one block.  An item has a passage for
    # each stride and, in its runs, six passages for every second stride.
    length = F.octet_length("words") / 4
    vectors = F.ceil(length / STRIDE) + F.when(length > RUN, F.ceil(length / (2 * STRIDE)) * 6).otherwise(1)
    n_vectors, n_items, item_words = items.agg(F.sum(vectors), F.count("*"), F.sum(length)).first()
    count = -(-(n_vectors or 0) // BLOCK_VECTORS)
    items = items.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(max(count, 1))))
    blocks = range(count)
    if not count or words.isEmpty():
        return spark.createDataFrame([], schema)
    weights, n_docs, doc_words = idf(words)
    item_weight = ITEM_WEIGHT * max(n_docs, FIT_DOCS) / max(n_items, FIT_DOCS)

    def fitted(rows: DataFrame, weight: float, n_words: float) -> DataFrame:
        return rows.select("words", F.lit(weight).alias("weight")).coalesce(int(n_words // FIT_WORDS) + 1)

    basis = singular_vectors(
        fitted(words, 1.0, doc_words).unionByName(fitted(items, item_weight, item_words)), weights, RANK
    )
    out = None
    for block in blocks:
        rows = items.filter(F.col("block") == block).orderBy("id", "words").collect()
        if not rows:
            continue
        shared = spark.sparkContext.broadcast(
            ([r["id"] for r in rows], [bytes(r["words"]) for r in rows], weights, basis)
        )

        def work(batches, shared=shared) -> Iterator[dict]:
            ids, raw, weights, basis = shared.value
            ready = Items(ids, [np.frombuffer(w, "<u4") for w in raw], weights, basis)
            for batch in batches:
                for i, ws in zip(batch.column(0), _arrays(batch), strict=True):
                    for item, first, last, cosine, share, answer in ready.matches(ws):
                        yield {key: i.as_py(), "item_id": ready.ids[item], "begin": first, "end": last,
                               "cosine": cosine, "in_order": share, "answer": answer}

        found = stored(map_batches(words, work, schema), "decontaminate-found")
        out = found if out is None else out.unionByName(found)
        shared.unpersist()
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the texts in which a benchmark item was found; all columns kept.

    A row is told by a hash of its id and text, so null or repeated ids do no harm and rows that
    repeat share their fate.
    """
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.md5(text_of()))
    bad = contaminated(
        docs.select(key.alias("number"), text_of().alias("text")), benchmark, "number"
    ).select("number").distinct()
    rows = rows_of(docs, key.alias("number"))
    return rows.join(bad, "number", "left_anti").select("row.*")
