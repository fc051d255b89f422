"""Connected components of a table of links."""

from pyspark.sql import functions as F

from .common import gathered


def _digest(links):
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def _lowest(links):
    """The lowest neighbour of every ``a``."""
    return links.groupBy("a").agg(F.min("b").alias("low"))


def connected(links):
    """(node, root) of every node of ``links`` (a, b): root is the lowest node of its component.

    Large-star and small-star steps alternate until nothing changes: each hangs
    a node's neighbours on the lowest of them. Every step is two shuffles of
    the links, written to the shared folder; none gathers a node's neighbours in one place.
    """
    links = gathered(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "links")
    state = _digest(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _lowest(both).withColumn("low", F.least("a", "low"))
        # Every higher neighbour goes to the lowest of the neighbourhood.
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # Every lower neighbour, and the node, go to the lowest neighbour.
        small = large.join(_lowest(large), "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("l")).select("l.*")
        links = gathered(small.where("a <> b").distinct(), "links")
        last, state = state, _digest(links)
        if state == last:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
