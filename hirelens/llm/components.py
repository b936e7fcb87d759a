"""Connected components of a link table by alternating large-star and small-star steps (Kiveris et al. 2014).

Every step is an aggregation by vertex and a join back, so a vertex with very many links is combined before the shuffle
and split in the join; each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import stored


def _stars(links: DataFrame) -> bool:
    """Whether every vertex with a link down has one, to a vertex that has none: then the components are found."""
    seen = links.select(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        links.select(F.col("b").alias("v"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    by_vertex = seen.groupBy("v").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return by_vertex.agg(F.coalesce(F.max(F.when((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0)), 1)), F.lit(0))).first()[0] == 0


def _large_star(links: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each vertex on the smallest vertex around it; links lead down (a > b)."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang each vertex and its neighbours below on the smallest of them; links lead down."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    below = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return below.union(least.select("a", F.col("least").alias("b"))).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``links`` (a, b): root is the smallest vertex of its component; roots included."""
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "components")
    while not _stars(links):
        links = stored(_small_star(stored(_large_star(links), "components")), "components")
    return links.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("vertex"), F.col("b").alias("root"))).distinct()
