"""Connected components of a link table, distributed (large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import release, table


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star operation on edges (u, v): every node's neighbours are tied to its smallest one."""
    if small:  # towards smaller neighbours only
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = sides.join(least, "u")
    if small:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b): the smallest node that it reaches. No links give no rows.

    Links may repeat and go either way; nulls are left out. Each round is written to the shared folder.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u is not null and v is not null and u <> v").distinct()
    edges = table(edges, "edges")
    before = None
    while True:
        after = table(_stars(_stars(edges, small=False), small=True), "edges")
        release(edges)
        edges = after
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == before:
            break
        before = found
    members = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
