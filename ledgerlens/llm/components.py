"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import stored


def oriented(u, v) -> list:
    return [F.greatest(u, v).alias("u"), F.least(u, v).alias("v")]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v); the root is the smallest node that can be reached.

    Alternating large and small stars: each round hangs neighbours on the
    smallest one, so that the number of links never grows and trees flatten in
    about log(n) rounds. Every round is stored; a hot node's links are summed
    per task first.
    """
    state = None
    edges = stored(links.filter(col("u") != col("v")).select(*oriented(col("u"), col("v"))).distinct(), "links")
    while True:
        # Large star: neighbours above a node hang on the smallest of its neighbourhood.
        both = edges.unionByName(edges.select(col("v").alias("u"), col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter(col("v") > col("u")).select(col("v").alias("u"), col("m").alias("v"))
        large = large.filter(col("u") != col("v")).distinct()
        # Small star: neighbours below a node and the node itself hang on the smallest of them.
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u")
        hung = small.filter(col("v") != col("m")).select(col("v").alias("u"), col("m").alias("v"))
        after = stored(hung.unionByName(below.select("u", col("m").alias("v"))).distinct(), "links")
        edges = after
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state:
            break
        state = now
    # Each node now hangs on its root.
    return edges.select(col("u").alias("node"), col("v").alias("root")).unionByName(
        edges.select(col("v").alias("node"), col("v").alias("root")).distinct()
    )
