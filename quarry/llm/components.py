"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): component is the smallest id reachable from id.

    Only ids that have a link to another id are returned; repeated links,
    self links and links with a null end are ignored; no links give no rows.
    Alternating large-star and small-star steps halve the depth of every tree,
    so the rounds grow with the logarithm of the longest path. The minima are
    written to the checkpoint folder before the join, so that adaptive
    execution can split the rows of a hub.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = (links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
             .where("hi > lo").distinct().checkpoint())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("least")).select("hi", F.least("hi", "least").alias("least")).checkpoint()
        large = (both.join(least, "hi").where("lo > hi")
                 .select(F.col("lo").alias("hi"), F.col("least").alias("lo")).where("hi > lo").distinct().checkpoint())
        least = large.groupBy("hi").agg(F.min("lo").alias("least")).checkpoint()
        small = (large.join(least, "hi").where("lo > least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
                 .unionByName(least.select("hi", F.col("least").alias("lo"))).distinct())
        edges = small.checkpoint()
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            break
        state = now
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots)
