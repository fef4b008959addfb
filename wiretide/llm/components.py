"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretide.sources.storage import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of links (a, b), as a written table.

    A round hangs every node's larger neighbours, then its smaller ones, on the smallest
    node it sees; rounds grow with the logarithm of the longest path. Minima are combined
    before the shuffle, so a node with very many links is no load on one task. Every
    half round is a written table, and only counts come to the driver: links hang on the
    smallest nodes once no node sees a smaller one beside another. A round makes no more links
    than there were, so repeats among them are dropped only where links outnumber nodes.
    """
    ends = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(ends, "links")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nodes = both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("degree"))
        nodes = materialize(nodes, "nodes")
        least = F.least("u", "low")
        crossed, n_nodes, degrees = nodes.agg(F.count_if((F.col("low") < F.col("u")) & (F.col("low") < F.col("high"))), F.count(F.lit(1)), F.sum("degree")).first()
        if not crossed:
            return nodes.select(F.col("u").alias("node"), least.alias("component"))
        large = edges.join(nodes.select(F.col("u").alias("v"), least.alias("m")), "v").select("u", F.col("m").alias("v"))
        large = materialize(large, "links")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small.distinct() if degrees > 2 * n_nodes else small, "links")
