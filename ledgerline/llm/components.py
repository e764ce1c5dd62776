"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, tidy


def components(links: DataFrame) -> DataFrame:
    """links: a, b (non-null longs). Each linked node with the smallest node of its component: node, root.

    Every round ties each node's neighbours to its smallest one. Rounds keep at most as many links as there were and end when
    nothing changes, after a number that grows with the logarithm of the diameter. Links and each node's smallest neighbour are tables in
    the shared folder, so that their join is one of plain scans, where adaptive execution splits the task of a node with very many
    links. The driver sees two numbers of a round. Loops and repeated links are ignored.
    """
    now = Stash(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = _mark(now.df)
    while True:
        with tidy() as keep:
            both = now.df.union(now.df.select("v", "u"))
            least = Stash(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least").df
            large = both.join(least, "u").filter("v > u and v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            down = Stash(large.distinct(), "links").df
            low = Stash(down.groupBy("u").agg(F.min("v").alias("m")), "least").df
            rest = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            after = keep(low.select("u", F.col("m").alias("v")).union(rest).distinct(), "links")
        now.drop()
        now = after
        mark = _mark(now.df)
        if mark == seen:
            return now.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark


def _mark(links: DataFrame) -> tuple:
    """Two numbers that tell link tables apart."""
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)
