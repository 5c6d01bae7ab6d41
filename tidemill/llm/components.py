"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.stage import drop, settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node hands its neighbours (the larger ones, or the smaller ones and itself) to its least neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select("b", "a"))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.filter("a != b").distinct()


def contract(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Links ``a``, ``b`` that connect what ``edges`` connect, after so many rounds of stars, or until nothing changes."""
    now = settle(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a != b").distinct())
    mark, done = None, 0
    while done != rounds:
        after = settle(_star(_star(now, True), False))
        drop(now)
        now, done = after, done + 1
        if rounds is None:
            seen = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.expr("sum(xxhash64(a, b) >> 20)").alias("s")).first()
            if seen == mark:
                break
            mark = seen
    return now


def labels(links: DataFrame) -> DataFrame:
    """``node`` and ``comp`` of what ``contract`` returns: equal labels mean connected; after all its rounds, unequal ones mean apart."""
    return links.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(links.select("b", "b")).groupBy("node").agg(F.min("comp").alias("comp"))


def components(edges: DataFrame) -> DataFrame:
    """Label every node that has a link.

    ``edges`` has two long columns ``a`` and ``b`` (any order, repeats and loops allowed, no nulls). Returns ``node`` and
    ``comp``, the least node that can be reached. Nodes without a link to another node are not returned. The number of
    rounds grows with the logarithm of the largest component; each round is written to the shared folder.
    """
    return labels(contract(edges))
