"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _min_neighbour(sym: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours."""
    return sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component, for every
    node of ``edges`` (u, v).  Each round is written to the shared folder."""
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = None
    while True:
        # large star: neighbours above u hang on the smallest of u's neighbourhood
        sym = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (sym.join(_min_neighbour(sym), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: neighbours below u hang on the smallest of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        now = written(large.join(down, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                                     F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                      .select("e.u", "e.v").where("u <> v").distinct(), "cc")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
    labels = now.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
