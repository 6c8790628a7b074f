"""Connected components of links between long ids, by stars.

Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node it
sees; the number of rounds grows with the logarithm of the longest chain. A node is never
brought together with all of its links: only minima are taken, which combine before a shuffle,
and are joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept


def _towards_smallest(links: DataFrame) -> DataFrame:
    """links (u, v): v and the smallest of u and all its v."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(smallest.select("u", F.least("u", "m").alias("m")), "u")


def components(links: DataFrame) -> DataFrame:
    """links (a, b: non-null longs, in either direction, repeats and self-links allowed) to (node, root).

    ``root`` is the smallest node that can be reached. Every node of a link between two
    different nodes has a row, roots too; no links give no rows.
    """
    stars = kept(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = _towards_smallest(large)
        hung = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        stars = kept(hung, "stars")
        # The links are the same as in the last round if count and sum of digests are.
        found = stars.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.countDistinct("u")
        ).first()
        if found[0] == found[2] and (found[0], found[1]) == before:
            break
        before = (found[0], found[1])
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
