"""Connected components of link tables that no single machine could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.skew import join_per_key
from tidemark.llm.common import cut_lineage


def _to_smallest(pairs: DataFrame, only_larger: bool) -> DataFrame:
    """For each ``u``: its neighbours ``v`` and itself, linked to the smallest of them."""
    per_node = pairs.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("degree"))
    per_node = per_node.select("u", F.least("u", "low").alias("root"), "degree")
    linked = join_per_key(pairs, per_node, "u", "degree")
    out = linked.filter(F.col("v") > F.col("u")) if only_larger else linked
    links = out.select(F.col("v").alias("u"), F.col("root").alias("v"))
    if not only_larger:
        links = links.unionByName(per_node.select("u", F.col("root").alias("v")))
    return links.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) to (u, root): the smallest node that each linked node reaches.

    Large-star and small-star steps in turn, each a fold per node and a join: the first links the
    larger neighbours of a node to its smallest neighbour, the second links the smaller ones. They
    end after about log(n) rounds in stars around the smallest nodes. Steps are checkpointed, so a lost
    executor costs one step.
    """
    pairs = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    pairs = cut_lineage(pairs.distinct())
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = cut_lineage(_to_smallest(both, only_larger=True))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        pairs = cut_lineage(_to_smallest(down, only_larger=False))
        mark = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return pairs.withColumnRenamed("v", "root")
        seen = mark
