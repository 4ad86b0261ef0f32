"""Connected components of a table of links, by alternating large and small stars; nothing comes to the driver but a
checksum of each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every node that a link joins to a smaller one, the smallest node it is connected with. Roots have
    no row. Links may repeat, point either way or from a node to itself; null ends are ignored; no links: no rows.
    Each round is written to the checkpoint folder, so a lost executor costs one round at most; the rounds before it are
    deleted."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} <> {b}").distinct()
    e, last = cut(e), None
    while True:
        at = e
        both = at.select(F.col("u").alias("x"), F.col("v").alias("y")).union(at.select("v", "u"))
        # Written for its own sake: a plain table as the join's other side lets a node with very many links be split.
        least = cut(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")))
        large = both.join(least, "x").where("y > x and y <> m").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        e = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m")).distinct()
        before, e = [at, least], cut(e)
        for x in before:
            drop(x)
        now = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == last:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = now
