"""Connected components of an edge table by alternating star operations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import frames


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).where("u <> v")


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """Each linked node with the least node it reaches: columns node, component.

    Large and small star alternate until the edges no longer change; they then form stars
    around the least nodes.  Least neighbours are aggregated before they are joined back,
    so a node with very many links is never gathered in one place.  Every round is staged
    in the shared folder, and the round before it is removed."""
    edges = frames.staged(
        links.select(
            F.greatest(one, other).alias("u"), F.least(one, other).alias("v")
        ).where("u <> v").distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        after = frames.staged(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        frames.drop_staged(edges)
        edges, before = after, mark
        mark = _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and two hash sums, equal only for equal edge sets but for chance."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            F.sum(F.hash("u", "v").cast("bigint")),
        ).first()
    )
