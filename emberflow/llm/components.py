"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def connected(links: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex reachable from every vertex of ``links`` (a, b).

    Every round hooks each vertex's larger neighbours, then its smaller ones,
    to the smallest; the rounds needed grow with the logarithm of the longest
    path. Only a checksum of the links comes to the driver.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = cut_lineage(edges)
    before = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        edges = cut_lineage(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before is not None and tuple(now) == before:
            break
        before = tuple(now)
    roots = edges.select(F.col("v"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("v"), F.col("v").alias("label")).union(roots)
