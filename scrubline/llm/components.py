"""Connected components of an edge table, by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each round is two grouped minima and two joins;
the number of rounds grows with the logarithm of the longest path. A node with very many edges is a skewed join key: the
minima are cut off into their own table first, so both join sides are plain exchanges that adaptive execution splits.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import cut


def _lowest(edges: DataFrame) -> DataFrame:
    return cut(edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(_lowest(both), "u").filter(F.col("v") > F.col("u"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    lowest = _lowest(edges)
    tied = edges.join(lowest, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.col("v") % 1000003).alias("s")).first()
    return row["n"], row["x"], row["s"]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``edges`` that is not its component's smallest, the root; both as bigint.

    Edges may repeat, point either way and tie a node to itself. No edges, no rows.
    """
    ordered = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col("u") != F.col("v"))
    stars = cut(ordered.distinct())
    state = _state(stars)
    while state[0]:
        stars = cut(_small_star(cut(_large_star(stars))))
        before, state = state, _state(stars)
        if state == before:
            break
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
