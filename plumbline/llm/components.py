"""Connected components by alternating stars: each node joins the smallest node it can see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut


def _star(edges: DataFrame, large: bool, shares: int) -> DataFrame:
    """Neighbours (larger ones, or the others) of each node, linked to its smallest neighbour.

    A node's neighbours are dealt into ``shares`` by their hash, and its smallest one goes to the
    shares that it has, so that the neighbours of a hub meet it in as many tasks.
    """
    around = edges.select("u", "v")
    if large:
        around = around.union(edges.selectExpr("v AS u", "u AS v"))
    around = around.withColumn("share", F.pmod(F.xxhash64("v"), F.lit(shares)).cast("int"))
    least = around.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("share").alias("own"))
    if large:
        least = least.select("u", F.least("u", "m").alias("m"), F.explode("own").alias("share"))
        linked = around.where("v > u").join(least, ["u", "share"]).selectExpr("v AS u", "m AS v")
    else:
        least = least.select("u", "m", F.explode("own").alias("share"))
        both = "inline(array(named_struct('u', u, 'v', m), named_struct('u', v, 'v', m)))"
        linked = around.join(least, ["u", "share"]).selectExpr(both)
    return linked.where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root`` for every node of an edge; the root is the smallest node reachable.

    Every step keeps reachability and moves nodes towards smaller ones, so that the edges end as
    stars around the roots after a number of rounds that is logarithmic in practice. A node with
    many neighbours is read through a partial minimum and a join by shares of its neighbours, as
    many as there are shuffle partitions; no group is gathered. Null and self edges link nothing.
    """
    shares = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = edges.where(f"{a} <> {b}").select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    seen = None
    while True:
        edges = cut(_star(_star(edges, True, shares), False, shares))
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
