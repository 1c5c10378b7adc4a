"""Connected components of a graph held as an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import HOT_ROWS, looked_up, new_dir, remove


def state_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(0xFFFFFFFF))).first())


def star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """One star step on `total` edges (u, v), u > v: links go to the least neighbour, those of larger nodes or of smaller ones.

    A hub is never gathered: its least neighbour comes from an aggregate with map-side combining, and the join that hands
    it out leaves the rows of hubs where they are.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        moved = looked_up(both.where("v > u"), least, ["u"], 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        moved = looked_up(edges, least, ["u"], total).select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """For edges (a, b) of longs, rows (node, root) for every node with an edge other than to itself: root is the least
    node of its component. Null ends, loops and repeated edges make no difference; no edge gives no row.

    Each round, or each step of one over many edges, is written to the shared folder, so lost executors cost a round at
    most, and old ones are removed.
    """
    spark = edges.sparkSession
    paths: list[str] = []

    def written(df: DataFrame) -> DataFrame:
        paths.append(new_dir(spark, "edges"))
        df.write.parquet(paths[-1])
        for old in paths[:-1]:
            remove(spark, old)
        del paths[:-1]
        return spark.read.schema("u long, v long").parquet(paths[-1])

    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = state_of(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        step = star(now, True, state[0])
        now = written(star(step if state[0] <= HOT_ROWS else written(step), False, state[0]))
        before, state = state, state_of(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
