"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshcat.llm.common import ship_package, sized, stage, unstage

MAX_ROUNDS = 60


def _large_star(links: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = stage(sized(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), rows), "least")
    linked = both.join(least.hint("merge"), "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    return linked, least


def _small_star(links: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """A node's smaller neighbours and the node itself are linked to the least of them."""
    least = stage(sized(links.groupBy("b").agg(F.min("a").alias("m")), rows), "least")
    neighbours = links.join(least.hint("merge"), "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
    own = least.select(F.col("m").alias("x"), F.col("b").alias("y"))
    return neighbours.unionByName(own).where(F.col("x") != F.col("y")).select(F.col("x").alias("a"), F.col("y").alias("b")), least


def contract(batches: Iterator[pd.DataFrame], most: int = 500_000) -> Iterator[pd.DataFrame]:
    """Links (a, b) of a partition as stars around the least node that they connect, up to
    ``most`` links at a time: fewer links and fewer rounds for what comes after."""
    held: list[pd.DataFrame] = []

    def stars() -> Iterator[pd.DataFrame]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root.setdefault(up, up)
            return x

        for b in held:
            for x, y in zip(b["a"].tolist(), b["b"].tolist(), strict=True):
                x, y = find(x), find(y)
                root[max(x, y)] = min(x, y)
        if root:
            nodes = [x for x in root if find(x) != x]
            yield pd.DataFrame({"a": [find(x) for x in nodes], "b": nodes}, dtype="int64")

    for b in batches:
        held.append(b)
        if sum(map(len, held)) >= most:
            yield from stars()
            held = []
    yield from stars()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that ``links`` (columns a, b; longs) mentions with another
    node, root the least node of its component.

    The links of each partition are contracted by themselves (:func:`contract`). Each round
    then is two star contractions: grouped minima (with partial aggregation, so a hub of any
    degree is one row a task), written and joined back on the node: with nothing but exchanges
    below the join, adaptive execution splits a hub's rows over tasks. It ends when the links
    are stars around the roots. Every round is written under ``spark.checkpoint.dir``, which
    cuts the lineage; the driver only sees one checksum and count a round, and few links are
    written by few tasks. Self-links and repeated links are allowed, null ends are not.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    ship_package(links.sparkSession)
    found = stage(links.mapInPandas(contract, "a long, b long"), "links")
    rows = found.count()
    state, now = None, stage(sized(ordered(found), rows), "links")
    unstage(found)
    for _ in range(MAX_ROUNDS):
        again = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if again == state:
            break
        state, before, rows = again, now, again[0]
        large, least = _large_star(before, rows)
        middle = stage(sized(large.distinct(), rows), "links")
        unstage(before, least)
        small, least = _small_star(middle, rows)
        now = stage(sized(ordered(small), rows), "links")
        unstage(middle, least)
    else:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
