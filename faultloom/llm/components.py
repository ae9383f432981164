"""Connected components by alternating stars, as joins of a link table with itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultloom.llm.common import join_facts
from faultloom.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, n): the smallest node beside each node, and how many there are; combined before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    least = materialize(_least(edges.union(back)).select("u", F.least("u", "m").alias("m"), "n"), "least")
    return join_facts(back, least, "u", 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them. Here u > v throughout."""
    least = materialize(_least(edges), "least")
    rest = join_facts(edges, least, "u", n).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every linked node but the roots; a root is the smallest node of its component.

    Every round is written to the shared folder. The number of rounds grows with
    the logarithm of the longest chain; a node's links are never gathered, and a
    node that holds a great share of them is joined by broadcast.
    """
    one, two = F.col(a), F.col(b)
    edges = links.filter(one != two).select(F.greatest(one, two).alias("u"), F.least(one, two).alias("v"))
    edges = materialize(edges.distinct(), "edges")
    before = _state(edges)
    while before[0]:
        star = materialize(_large_star(edges, before[0]).distinct(), "stars")
        edges = materialize(_small_star(star, before[0]).distinct(), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
