"""Connected components of links held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.llm.common import stored

# Links in a file of a round, about.  On a local file system each file costs processes,
# which share the executor's memory until they run a program of their own.
_LINKS_PER_FILE = 100_000


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest reachable node) for every linked node but the smallest itself.

    ``links`` has two bigint columns, ``a`` and ``b``; direction, repeats and
    self-links don't matter, nulls are dropped.  Large-star and small-star steps
    (Kiveris et al., 2014) alternate until nothing changes, in a number of rounds
    that grows with the logarithm of the nodes.  A node's smallest neighbour is
    found by an aggregate with map-side combine and joined back, where adaptive
    execution splits a node of very many links.  Each round is written to the
    shared folder, in as many files as its links ask for (a round never has more than
    the one before); only a count and a checksum reach the driver.
    """
    current = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        files = 1 + state[0] // _LINKS_PER_FILE
        current = stored(_small_star(_large_star(current)).coalesce(files))


def _large_star(links: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its smallest neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node, and its smaller neighbours, to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u").where(F.col("v") != F.col("m"))
    return least.select("u", F.col("m").alias("v")).union(joined.select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
