"""Connected components of an edge table, by contraction rounds in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a bigint, b bigint) -> (node, root) for every node of an edge.

    Each round joins every node to the neighbour that comes first in a hashed
    order, and replaces both ends of every edge by what they were joined to;
    edges within a component vanish.  The hashed order keeps ascending chains
    short, so the number of rounds grows with the logarithm of the nodes.
    Parents are written to the shared folder before they are joined, so that
    both sides of each join are plain exchanges, which Spark splits where one
    root has many nodes.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    edges = cut(_tidy(edges.select("a", "b")), "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = cut(
            both.groupBy("a")
            .agg(F.min(rank("b")).alias("m"))
            .where(F.col("m") < rank("a"))
            .select(F.col("a").alias("child"), F.col("m.n").alias("parent")),
            "parents",
        )
        edges = cut(_tidy(_follow(_follow(edges, parents, "a"), parents, "b")), "edges")
        nodes = cut(_follow(nodes, parents, "root"), "roots")
    return nodes


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _follow(df: DataFrame, parents: DataFrame, name: str) -> DataFrame:
    out = df.join(parents, df[name] == parents["child"], "left")
    return out.withColumn(name, F.coalesce("parent", name)).drop("child", "parent")
