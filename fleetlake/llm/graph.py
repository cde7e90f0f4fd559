"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch


def _stars(edges: DataFrame) -> DataFrame:
    """Every node with its smallest neighbour or itself, ``node, least``."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select(
        F.col("u").alias("node"), F.least("u", "least").alias("least")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``edges`` (``u, v``, any order, repeats allowed).

    The component is its smallest node. Each round links every node's larger neighbours to
    its smallest one, then its smaller neighbours likewise; the rounds grow with the
    logarithm of the longest path. A hub's links meet only in an aggregation with partial
    sums and in a join that can be split. Rounds are cut by tables in the shared folder.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    scratch = Scratch(edges.sparkSession)
    edges = scratch.keep(edges, "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_stars(both).withColumnRenamed("node", "u"), "u")
        large = large.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = scratch.keep(large.where("u <> v").distinct(), "links")
        scratch.drop(edges)
        small = large.join(_stars(large).withColumnRenamed("node", "u"), "u")
        small = small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            _stars(large).select(F.col("node").alias("u"), F.col("least").alias("v"))
        )
        edges = scratch.keep(small.where("u <> v").distinct(), "links")
        scratch.drop(large)
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == mark:
            break
        mark = found
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
