"""Connected components of a table of links, by alternating stars: every node comes to point at the least node it can reach.

A large-star step links each larger neighbour of a node to the least node nearby; a small-star step does the same for the
smaller neighbours. The steps keep the components, and end at stars. Each round is written to the shared folder. The least
neighbour per node is aggregated before the shuffle and written before it is joined, so the rows of a node with
very many links can be split over tasks. Only counts reach the driver: they tell when all links are stars, and how
many tasks a step needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tableshift.session import sized, work_folder


def _written(rows: DataFrame, most: int | None, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """The rows, written, and their ``counts`` (of rows where a condition holds) beside ``n``; ``most``: rows they can be made of."""
    seen, path = Observation(), work_folder(rows.sparkSession, "links")
    tasks = rows if most is None else sized(rows, most)
    tasks.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(name) for name, c in counts.items()]).write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), seen.get


def _least(links: DataFrame, most: int) -> tuple[DataFrame, dict[str, int]]:
    """(a, m): the least of each node and its neighbours. Counted: ``n`` nodes and those ``lower`` ones that have a smaller neighbour."""
    return _written(links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), most, lower=F.col("m") < F.col("a"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link to another node; ``component`` is the least node it can reach.

    Links count in both directions; repeated links, links of a node with itself and links with a null end add nothing.
    """
    known = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    # Every row of ``edges`` has a > b.
    edges, seen = _written(known.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), None)
    while seen["n"]:
        most = 2 * seen["n"]
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least, nodes = _least(both, most)
        # A link moves unless its smaller end has no smaller neighbour.
        marked = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"), (F.col("m") < F.col("a")).alias("moved"))
        large, after = _written(marked.groupBy("a", "b").agg(F.max("moved").alias("moved")), most, moved=F.col("moved"))
        if not after["moved"] and nodes["lower"] == seen["n"]:
            break  # every link is one of the only smaller neighbour, and that has none itself: stars
        large = large.drop("moved")
        least, nodes = _least(large, after["n"])
        if nodes["n"] == after["n"]:
            edges, seen = large, after  # one smaller neighbour each: a small-star step changes nothing
            continue
        small = large.join(least, "a").select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
        edges, seen = _written(small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).filter("a <> b").distinct(), most)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
