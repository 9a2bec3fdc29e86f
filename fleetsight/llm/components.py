"""Connected components of a graph of links, by contraction in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetsight.llm.common import staged


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node that a link (a, b) touches; a component's nodes share their root.

    Each round sends every node to the first of its neighbours and itself in an order by a hash
    that changes with the round, and links what the ends were sent to. A constant share of the
    nodes goes in each round whatever the graph's shape, so the rounds grow with the logarithm of
    its size. Nothing is gathered by node, only minima; each round is staged.
    """
    edges = staged(links.filter("a <> b").select("a", "b").distinct(), f"{name}-edges")
    maps = []
    while not edges.isEmpty():
        turn = len(maps)
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), F.col("b").alias("node")))
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("h"), F.col("a").alias("node"))
        sent = both.groupBy("a").agg(first.alias("first")).select(F.col("a").alias("node"), F.least("first", own)["node"].alias("to"))
        sent = staged(sent, f"{name}-round{turn}")
        maps.append(sent)
        to_a = sent.select(F.col("node").alias("a"), F.col("to").alias("ra"))
        to_b = sent.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        moved = edges.join(to_a, "a").select("ra", "b").join(to_b, "b").filter("ra <> rb")
        edges = staged(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{name}-edges")
    if not maps:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    found = maps[0].withColumnRenamed("to", "root")
    for later in maps[1:]:
        step = later.select(F.col("node").alias("root"), "to")
        found = found.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return staged(found, f"{name}-roots")
