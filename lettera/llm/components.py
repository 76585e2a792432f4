"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for each node of a link.

    ``links`` has the columns a and b.  Each round hangs every node's larger neighbours, then
    its smaller ones, below the least node around it, until no link changes.  Rounds are stored;
    only a count and a checksum reach the driver.
    """
    links = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") != F.col("b")).distinct(),
        "links",
    )
    before = None
    for _ in range(most_rounds):
        links = stored(_hang(_hang(links, larger=True), larger=False), "links")
        now = tuple(links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    leaves = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return leaves.unionByName(roots.join(leaves.select("node"), "node", "left_anti"))


def _hang(links: DataFrame, larger: bool) -> DataFrame:
    """Links from each node's larger (or smaller) neighbours to the least of all around it."""
    around = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        around = around.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    )
    moved = around.join(least, "u").select(
        "u", "v", "m", (F.col("v") > F.col("u")).alias("up")
    )
    if larger:
        out = moved.filter("up").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            moved.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.filter(F.col("a") != F.col("b")).distinct()
