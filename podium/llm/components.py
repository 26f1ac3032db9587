"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import staged, unstage


def _star(links: DataFrame, nearest: DataFrame) -> DataFrame:
    # The second key makes Spark deal both sides anew, so that adaptive execution can split a node
    # of very many links; what is aggregated by "u" alone would be joined where it is.
    again = F.hash("u").alias("k")
    return links.select("*", again).join(nearest.select("*", again), ["k", "u"])


def _large(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest id around that node."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _star(both.where("v > u"), nearest).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    nearest = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = _star(links, nearest).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(nearest.select("u", F.col("m").alias("v"))).distinct()


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("u", "v"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """For each node of `links` (u, v: long) but the smallest of its component: u, root.

    A node's neighbours are never gathered: minima are combined before each shuffle and a node of
    any degree is joined with one row, which adaptive execution can split. Every round is written
    to the shared folder; the number of rounds grows with the logarithm of a component's diameter.
    Self-links and repeated links are ignored.
    """
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = staged(links.distinct(), "links")
    before = None
    while (now := _signature(current)) != before and now[0]:
        before = now
        nearer = staged(_small(_large(current)), "links")
        unstage(current)
        current = nearer
    return current.select("u", F.col("v").alias("root"))
