"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stash


def _both(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, neighbours: DataFrame, above: bool) -> DataFrame:
    """Tie neighbours to the smallest neighbour of their node: those above the node, or those below and the node."""
    least = stash(neighbours.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")))
    # both sides are plain scans, so a node with very many links can be split at run time
    met = neighbours.join(least, "a")
    if above:
        tied = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        tied = met.select(F.col("b").alias("a"), F.col("root").alias("b")).unionAll(least.select("a", F.col("root").alias("b")))
    return stash(tied.where(F.col("a") != F.col("b")).distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """a, b with b the smallest node of a's component, for every linked node but the smallest, from links a, b.

    Large and small stars alternate until the links are stars around the smallest nodes; a logarithmic
    number of rounds. Only a count and a checksum of the links reach the driver.
    """
    links = stash(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct())
    before = _state(links)
    while before[0]:
        links = _star(links, _both(links), above=True)
        links = _star(links, links, above=False)
        after = _state(links)
        if after == before:
            break
        before = after
    return links
