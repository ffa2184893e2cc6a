"""Connected components of a link table by alternating stars; every round is written, nothing goes to the driver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.tables import joined, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of every node on the least of them: the greater ones (large) or the smaller ones and itself."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return joined(both.filter("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = joined(edges, least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: pairs (u, v) in any order. Gives (node, component) for every node in a link; the component is its least node."""
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = written(_star(written(_star(edges, large=True), "stars"), large=False), "stars")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()
