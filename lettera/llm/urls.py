"""URL filter: rules, and for the rest naive Bayes over the words of segmented hosts and paths.

Words are counted over the whole corpus.  Every part of a host label that is as long as some word
is looked up in those counts by a join (no dictionary travels to the tasks), and a Viterbi pass
finds the most probable split of the label.  Words and labels of any length take part.  Urls that
a rule decides train the classifier, which judges the others.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import stored, text_of

#: Fixed values of the base: verdict and rule, longest rule first.
RULES = [
    ("allow", "www.example.com/en/"), ("block", "example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"), ("allow", "com/"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z as a-z; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of the longest rule that fits and its verdict, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def unigrams(docs: DataFrame) -> DataFrame:
    """Counts of all words of two letters or more in the corpus, in lower case: word, count."""
    ws = F.filter(F.split(F.lower(text_of()), r"[^\p{L}]+", -1), lambda w: F.length(w) >= 2)
    return docs.select(F.explode(ws).alias("word")).groupBy("word").agg(F.count("*").alias("count"))


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """``label`` and the ``words`` of its most probable split, for distinct labels.

    A part's cost is the negative log of its share of all words; a part that the corpus doesn't
    have costs that of a word seen once and a factor of ten for each letter.  Of the counts only
    their sum and the lengths that words have reach the driver, a number per length.
    """
    per_length = counts.groupBy(F.length("word").alias("k")).agg(F.sum("count").alias("count")).collect()
    total = float(sum(r["count"] for r in per_length) or 1)
    lengths = F.lit(sorted(r["k"] for r in per_length) or [0])
    n = F.length("label")
    spans = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.transform(
            F.filter(lengths, lambda k: k.between(1, n - i)),
            lambda k: F.struct(i.alias("i"), k.alias("k")),
        ),
    )))
    parts = labels.filter(n > 0).select("label", spans.alias("s")).select(
        "label", "s.i", "s.k", F.expr("substring(label, s.i + 1, s.k)").alias("word")
    )
    known = parts.join(counts, "word").groupBy("label").agg(
        F.collect_list(F.struct("i", "k", F.col("count").cast("double").alias("count"))).alias("parts")
    )
    rows = labels.join(known, "label", "left").select("label", "parts")

    @F.pandas_udf("array<string>")
    def split(label: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([_viterbi(t, p if p is not None else (), total) for t, p in zip(label, parts, strict=True)])

    return rows.select("label", split("label", "parts").alias("words"))


def _viterbi(text: str, parts, total: float) -> list[str]:
    """The split of least cost; an unknown part costs log(10 ** length * total)."""
    ending: dict[int, list[tuple[int, float]]] = {}
    for p in parts:
        ending.setdefault(p["i"] + p["k"], []).append((p["i"], math.log(total / p["count"])))
    best, back = [0.0] + [math.inf] * len(text), [0] * (len(text) + 1)
    # The cheapest place for an unknown part to begin, whatever its length.
    letter, unknown = math.log(10), (0.0, 0)
    for end in range(1, len(text) + 1):
        for i, cost in (*ending.get(end, ()), (unknown[1], math.log(total) + (end - unknown[1]) * letter)):
            if best[i] + cost < best[end] - 1e-12:
                best[end], back[end] = best[i] + cost, i
        unknown = min(unknown, (best[end] - end * letter, end))
    out, end = [], len(text)
    while end:
        out.append(text[back[end] : end])
        end = back[end]
    return out[::-1]


def judged(pages: DataFrame, docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): host, path, rule, verdict, blocked_odds.

    Rules decide first.  Other urls get "block" where naive Bayes, trained on all urls that rules
    decided, finds block at least as likely, else "allow"; without urls of both kinds to learn
    from, "allow" unless all are blocked.  A null url has an empty host and path.  ``docs`` (text)
    gives the word counts.  Urls are judged by their words; in host and path a run of digits is one
    word, the same for all.
    """
    url = F.col("url").cast("string")
    rows = stored(
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            host_of(url).alias("host"), path_of(url).alias("path"),
        ).withColumn("found", rule_of(F.col("host"), F.col("path"), rules)),
        "urls-rows",
    )
    counts = stored(unigrams(docs), "urls-unigrams")
    steps = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")
    shape = F.transform(steps, lambda w: F.concat(F.lit("/"), F.regexp_replace(w, "[0-9]+", "0")))
    shaped = rows.select("*", F.array_join(shape, " ").alias("shape"))
    kinds = stored(
        shaped.groupBy("host", "shape", F.col("found.verdict").alias("known")).agg(F.count("*").alias("c")),
        "urls-kinds",
    )
    numbered = F.regexp_replace("host", "[0-9]+", ".0.")
    hosts = kinds.select("host").distinct().withColumn(
        "label", F.explode(F.split(numbered, r"[^\p{L}0]+", -1))
    ).filter(F.length("label") > 0)
    split = stored(segmented(hosts.select("label").distinct(), counts), "urls-split")
    of_host = stored(
        hosts.join(split, "label").groupBy("host").agg(F.flatten(F.collect_list("words")).alias("words")),
        "urls-hosts",
    )
    tokens = kinds.join(of_host, "host", "left").select(
        "host", "shape", "known", "c",
        F.explode_outer(F.concat(
            F.coalesce("words", F.array().cast("array<string>")),
            F.filter(F.split("shape", " "), lambda w: w != ""),
        )).alias("token"),
    )
    seen = tokens.filter(F.col("known").isNotNull() & F.col("token").isNotNull())
    model = stored(
        seen.groupBy("token").agg(
            F.sum(F.when(F.col("known") == "block", F.col("c")).otherwise(0)).alias("block"),
            F.sum(F.when(F.col("known") == "allow", F.col("c")).otherwise(0)).alias("allow"),
        ),
        "urls-model",
    )
    size = model.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("v")).first()
    prior = {r["known"]: r["c"] for r in kinds.groupBy("known").agg(F.sum("c").alias("c")).collect()}
    n_block, n_allow = prior.get("block", 0), prior.get("allow", 0)
    unsure = kinds.filter(F.col("known").isNull()).select("host", "shape")
    v = (size["v"] or 0) + 1
    odds = F.log((F.col("block") + 1) / F.lit(float((size["block"] or 0) + v))) - F.log(
        (F.col("allow") + 1) / F.lit(float((size["allow"] or 0) + v))
    )
    start = math.log((n_block + 1) / (n_allow + 1))
    scored = (
        tokens.join(unsure, ["host", "shape"], "left_semi").filter(F.col("known").isNull())
        .join(model, "token", "left").groupBy("host", "shape")
        .agg((F.lit(start) + F.sum(F.coalesce(odds, F.lit(0.0)))).alias("blocked_odds"))
    )
    both = n_block > 0 and n_allow > 0
    guess = F.when(F.col("blocked_odds") >= 0, "block").otherwise("allow") if both else F.lit(
        "block" if n_block else "allow"
    )
    return shaped.join(stored(scored, "urls-scores"), ["host", "shape"], "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", guess).alias("verdict"), "blocked_odds",
    )
