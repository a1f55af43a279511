"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.common import written


def _state(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    ).first()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges(src, dst)``; component is the smallest node reachable.

    Each round every node hands its larger neighbours, then its smaller ones, to
    its smallest; rounds grow with the logarithm of a component's size. Minima are
    combined before they are shuffled, the joins split hot hubs, and each round is
    a written table. Links from a node to itself and nulls are left out; an empty
    table gives an empty table.
    """
    edges = (
        edges.where("src is not null and dst is not null and src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct()
    )
    edges = written(edges, name)
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(least.select("u", F.least("u", "m").alias("m")), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = written(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(
                F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                F.col("m").alias("v"),
            )
            .distinct()
        )
        edges, before = written(small, name), state
        state = _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
