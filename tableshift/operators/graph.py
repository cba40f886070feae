"""Hierarchies: branch trees, dependency edges, role memberships. Rounds of joins, each round written to the shared folder."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.session import counted_step, cut_lineage, work_folder
from tableshift.sources.sides import union_all


def reach(seeds: DataFrame, edges: DataFrame, node: str, labels: Sequence[str] = ()) -> DataFrame:
    """Every (node, …labels) reachable from the seeds along (source, target) edges, seeds included, each once.

    Only pairs found in the last round move on, and every round removes pairs already known, so shared ancestors and
    loops cost nothing extra. It ends when a round finds nothing new, however deep that is.
    """
    columns = [node, *labels]
    spark = seeds.sparkSession
    edges = cut_lineage(edges)
    folder = work_folder(spark, "reach")
    frontier = cut_lineage(seeds.select(*columns).distinct(), f"{folder}/round=0")
    for number in count(1):
        found = spark.read.schema(frontier.schema).option("recursiveFileLookup", "true").parquet(folder)
        step = (edges.join(frontier.withColumnRenamed(node, "source"), "source")
                .select(F.col("target").alias(node), *labels).distinct())
        frontier, fresh = counted_step(step.join(found, columns, "left_anti"), f"{folder}/round={number}")
        if not fresh:
            return found


def lineage(tree: DataFrame, node: str, parent: str, separator: str = "/", with_path: bool = True) -> DataFrame:
    """(node, root, depth, path) of every node of a forest of (node, parent), root first in the path.

    Each round a node's known stretch of ancestors doubles, so a chain of a thousand levels takes ten rounds. A loop or a
    parent that does not exist raises; nothing is left out. A stretch longer than there are nodes meets itself: that is
    how a loop shows. Finished nodes stay in the folder they were written to. A path is as long as its branch is deep;
    without ``with_path`` it is null.
    """
    name = F.col(node).cast("string") if with_path else F.lit(None).cast("string")
    paths = tree.select(F.col(node).alias("node"), F.col(parent).alias("up"), F.col(node).alias("top"),
                        F.lit(0).cast("bigint").alias("depth"), name.alias("path"))
    paths, nodes = counted_step(paths)
    closed, newly_closed = [], None  # finished rows, in the folders of the rounds that finished them
    open_rows, reached = paths.filter(F.col("up").isNotNull()), 1
    while not open_rows.isEmpty():
        if reached > nodes:
            raise ValueError("a branch is its own ancestor: a loop")
        above = paths.select(F.col("node").alias("up"), F.col("up").alias("next_up"), F.col("top").alias("above_top"),
                             F.col("depth").alias("above_depth"), F.col("path").alias("above_path"),
                             F.lit(True).alias("known"))
        open_ = open_rows.join(above, "up", "left")
        grown = open_.select("node", F.col("next_up").alias("up"), F.col("above_top").alias("top"),
                             (F.col("depth") + F.col("above_depth") + 1).alias("depth"),
                             (F.concat_ws(separator, "above_path", "path") if with_path else F.col("path")).alias("path"), "known")
        grown = cut_lineage(grown)
        if not grown.filter(F.col("known").isNull()).isEmpty():
            raise ValueError("a branch names a parent that does not exist")
        grown = grown.drop("known")
        closed.append(paths.filter(F.col("up").isNull()) if reached == 1 else newly_closed)
        newly_closed, open_rows = grown.filter(F.col("up").isNull()), grown.filter(F.col("up").isNotNull())
        paths = union_all([*closed, grown])
        reached *= 2
    return paths.select("node", F.col("top").alias("root"), "depth", "path")


def teardown_waves(lineages: DataFrame) -> DataFrame:
    """(node, depth, remove_wave, rebuild_wave): deepest nodes go first, parents are rebuilt first; a wave runs in parallel."""
    deepest = lineages.select(F.max("depth")).scalar()
    return lineages.select("node", "depth", (deepest - F.col("depth")).alias("remove_wave"),
                           F.col("depth").alias("rebuild_wave"))
