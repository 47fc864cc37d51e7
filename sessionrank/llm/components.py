"""Connected components of a link table by alternating star contractions."""

from pyspark.sql import functions as F

from sessionrank.llm.common import stage


def components(links, a="a", b="b"):
    """Rows (node, root): the smallest node reachable, for every node of a link.

    Nodes are bigint; links to itself, repeated links and both directions are allowed; rows with a
    null end are ignored. Each round writes a stage table with at most one row per node and
    remaining link; the number of rounds grows with the logarithm of the longest chain.
    Minima are taken by aggregates (combined before the shuffle) and joined back, so that a hub's links
    can be split among tasks.
    """
    edges = stage(_pairs(links.select(F.col(a).alias("hi"), F.col(b).alias("lo"))), "links")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m"))
        large = both.filter("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = stage(_pairs(large), "large-star")
        least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
        small = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = stage(_pairs(small.unionByName(least.select("hi", F.col("m").alias("lo")))), "small-star")
        before, mark = mark, _mark(edges)
        if mark == before:
            # every node now has one link, to its root; roots are their own
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )


def _pairs(rows):
    """Distinct links with the larger node first."""
    return rows.filter("hi <> lo").select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct()


def _mark(edges):
    """A figure that equal link tables share."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())
