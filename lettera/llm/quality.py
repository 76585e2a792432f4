"""Quality rules learned as a decision list by sequential covering.

Statistics of whole texts are native expressions over each row.  A rule is a conjunction of
thresholds on those statistics that rejects; rules are grown on two thirds of the labelled rows
by information gain, pruned on the rest, and kept only while they are precise.  The list comes
out as one ``CASE`` expression.  Learning reads all labelled rows: each step is one grouped
count over their binned statistics, of which only a histogram reaches the driver (statistics
times bins times two labels, whatever the size of the input).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import let, rows_of, stored, text_of

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
FEATURES = [
    "symbol_share", "repeat_share", "dup_line_share", "word_length", "upper_share",
    "exclamation_share", "distinct_share", "n_words",
]


def words(text: Column) -> Column:
    """Runs of characters other than blank, tab, line feed, VT, FF and CR."""
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def repeated_words(w: Column) -> Column:
    """How many words of ``w`` stand in a window of three that occurs twice or more.

    Windows are told apart by a 64-bit hash within one text.  They are sorted with their places,
    equal neighbours are repeats, and the places of repeats, sorted, cover at most three words
    each.  Texts whose windows are all different are done after a set of the hashes.
    """
    windows = F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
    )

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")
            ),
            lambda a: a["n"],
        )

    def places(s: Column) -> Column:
        same = F.filter(
            s,
            lambda e, j: (F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False)))
            | (F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False))),
        )
        return F.array_sort(F.transform(same, lambda e: e["i"]))

    def count(h: Column) -> Column:
        ordered = F.array_sort(
            F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        )
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(ordered, lambda s: covered(places(s)))
        )

    return let(windows, count)


def statistics(text: Column) -> Column:
    """A struct of a text's counts; a null text counts as the empty one.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines
    with a word that equal an earlier one), ``n_repeat_words``, ``n_upper`` (upper-case
    letters), ``n_exclamation``, ``n_distinct`` (different words).  All are 0 for no words.
    """
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.size(F.split(text, SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("long").alias("n_dup_lines"),
            let(lines, F.size).cast("long").alias("n_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
            (F.size(F.split(text, "!", -1)) - 1).cast("long").alias("n_exclamation"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        ),
    )


def shares(s: Column) -> dict[str, Column]:
    """What rules may test, from the struct of ``statistics``."""
    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(s[part].cast("double"), s[whole]), F.lit(0.0))

    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "word_length": share("word_chars", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "exclamation_share": share("n_exclamation", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "n_words": s["n_words"].cast("double"),
    }


def base_failed(s: Column) -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


@dataclass(frozen=True)
class Test:
    """One threshold: ``name >= value``, or ``name < value``."""

    name: str
    above: bool
    value: float

    def on(self, column: Column) -> Column:
        return column >= F.lit(self.value) if self.above else column < F.lit(self.value)

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.value:.6g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects, with the labelled rows it met."""

    tests: tuple[Test, ...]
    bad: int
    good: int

    def __str__(self) -> str:
        return " and ".join(map(str, self.tests)) + f"  [{self.bad} bad, {self.good} good]"


def learn(
    rows: DataFrame, label: str, names: list[str], bins: int = 40, most_rules: int = 8,
    most_tests: int = 3, least_precision: float = 0.95, least_rows: int = 5,
) -> list[Rule]:
    """An ordered list of rules that find rows whose ``label`` is 0.

    ``rows`` holds the statistics ``names`` and the label; rows with another label or none are
    left out.  Each rule is grown on the rows that no earlier one met, a test at a time, by the
    gain in information; its last tests are then dropped as long as that serves (p - n)/(p + n)
    on the pruning rows.  Learning ends at the first rule that meets fewer than ``least_rows``
    bad rows or is less precise than ``least_precision`` (with one good row added), on all rows.
    No labels, or labels of one kind only: no rules.
    """
    known = rows.filter(F.col(label).isin(0, 1))
    cuts = _cuts(known, names, bins)
    binned = stored(
        known.select(
            F.when(F.pmod(F.xxhash64(*names), F.lit(3)) == 0, 1).otherwise(0).alias("fold"),
            F.col(label).cast("int").alias("y"),
            *(_bin(F.col(n), cuts[n]).alias(f"b{i}") for i, n in enumerate(names)),
        )
        .groupBy("fold", "y", *(f"b{i}" for i in range(len(names)))).agg(F.count("*").alias("c")),
        "quality-binned",
    )
    rules: list[Rule] = []
    left = binned
    while len(rules) < most_rules:
        grown = _grow(left, names, cuts, most_tests)
        if not grown:
            break
        kept, bad, good = _prune(left, grown)
        if bad < least_rows or bad / (bad + good + 1) < least_precision:
            break
        rules.append(Rule(tuple(Test(names[i], up, cuts[names[i]][at]) for i, up, at in kept), bad, good))
        left = left.filter(~_meets(kept))
    return rules


def _cuts(rows: DataFrame, names: list[str], bins: int) -> dict[str, list[float]]:
    """Thresholds that a test may use: quantiles of each statistic, both ends closer."""
    at = sorted({*(i / bins for i in range(1, bins)), 0.002, 0.005, 0.01, 0.99, 0.995, 0.998})
    got = rows.agg(*(F.percentile_approx(n, at, 2000).alias(n) for n in names)).first()
    return {n: sorted(set(got[n] or [])) for n in names}


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many thresholds ``value`` reaches."""
    if not cuts:
        return F.lit(0)
    return reduce(lambda a, b: a + b, (F.when(value >= F.lit(c), 1).otherwise(0) for c in cuts))


def _meets(tests: list[tuple[int, bool, int]]) -> Column:
    """The conjunction on binned rows: the bin is past a threshold, or not."""
    return reduce(
        lambda a, b: a & b,
        ((F.col(f"b{i}") > at) if up else (F.col(f"b{i}") <= at) for i, up, at in tests),
        F.lit(True),
    )


def _grow(left: DataFrame, names: list[str], cuts: dict[str, list[float]], most: int):
    """Tests chosen one by one on the growing rows."""
    tests: list[tuple[int, bool, int]] = []
    rows = left.filter(F.col("fold") == 0)
    while len(tests) < most:
        pairs = F.explode(F.array(*(
            F.struct(F.lit(i).alias("i"), F.col(f"b{i}").alias("b")) for i in range(len(names))
        )))
        seen = (
            rows.filter(_meets(tests)).select("y", "c", pairs.alias("p"))
            .groupBy("p.i", "p.b", "y").agg(F.sum("c").alias("c")).collect()
        )
        counts = {(r["i"], r["b"], r["y"]): r["c"] for r in seen}
        p0 = sum(c for (i, _, y), c in counts.items() if i == 0 and y == 0)
        n0 = sum(c for (i, _, y), c in counts.items() if i == 0 and y == 1)
        if not p0 or (not n0 and tests) or p0 + n0 == 0:
            break
        best, gain = None, 1e-9
        for i, name in enumerate(names):
            below = [0, 0]
            for at in range(len(cuts[name])):
                below = [below[y] + counts.get((i, at, y), 0) for y in (0, 1)]
                for up, p, n in ((True, p0 - below[0], n0 - below[1]), (False, *below)):
                    if p:
                        g = p * (math.log2((p + 1) / (p + n + 2)) - math.log2((p0 + 1) / (p0 + n0 + 2)))
                        if g > gain + 1e-9:
                            best, gain = (i, up, at), g
        if best is None:
            break
        tests.append(best)
    return tests


def _prune(left: DataFrame, tests):
    """The best beginning of ``tests`` on the pruning rows, and what it meets of all rows."""
    cells = [
        F.coalesce(F.sum(F.when((F.col("fold") == f) & (F.col("y") == y) & _meets(tests[:k]), F.col("c"))), F.lit(0))
        .alias(f"k{k}_{f}_{y}")
        for k in range(1, len(tests) + 1) for f in (0, 1) for y in (0, 1)
    ]
    got = left.agg(*cells).first()

    def worth(k: int) -> tuple[float, int]:
        p, n = got[f"k{k}_1_0"], got[f"k{k}_1_1"]
        return (p - n) / (p + n) if p + n else -1.0, -k

    k = max(range(1, len(tests) + 1), key=worth)
    bad, good = (got[f"k{k}_0_{y}"] + got[f"k{k}_1_{y}"] for y in (0, 1))
    return tests[:k], bad, good


def verdict(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """The decision list as one ``CASE``: false at the first rule met, else true."""
    out = None
    for rule in rules:
        met = reduce(lambda a, b: a & b, (t.on(columns[t.name]) for t in rule.tests))
        out = F.when(met, F.lit(False)) if out is None else out.when(met, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judged(docs: DataFrame, labels: DataFrame, whole_rows: bool = False) -> tuple[DataFrame, list[Rule]]:
    """``docs`` (doc_id, text) with their statistics ``s``, ``base_failed`` and ``kept``; the rules.

    ``labels`` holds doc_id and quality (0 or 1).  An id with labels of both kinds counts as
    unlabelled; null ids are never labelled.  Statistics are stored with ``doc_id``.  With
    ``whole_rows`` the rows carry all columns in ``row`` and their statistics are computed again,
    so that no text is written a second time.
    """
    found = stored(docs.select(F.struct("doc_id").alias("row"), statistics(text_of()).alias("s")),
                   "quality-statistics")
    sure = (
        labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("id"))
        .agg(F.min("quality").alias("y"), F.max("quality").alias("z"))
        .filter((F.col("y") == F.col("z")) & F.col("id").isNotNull()).select("id", "y")
    )
    columns = shares(F.col("s"))
    examples = found.filter(~base_failed(F.col("s"))).select(
        F.col("row.doc_id").alias("id"), *(c.alias(n) for n, c in columns.items())
    )
    rules = learn(examples.join(sure, "id"), "y", FEATURES)
    if whole_rows:
        found = rows_of(docs, statistics(text_of()).alias("s"))

    def decided(s: Column) -> Column:
        failed = base_failed(s)
        return F.struct(failed.alias("base_failed"), (~failed & verdict(rules, shares(s))).alias("kept"))

    return found.select("row", "s", let(F.col("s"), decided).alias("d")).select(
        "row", "s", "d.base_failed", "d.kept"
    ), rules
