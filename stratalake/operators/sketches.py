"""Distinct counts that are kept as sketches, beside the exact counts, and merged over graphs and runs.

A sketch (theta, of Spark's own functions) holds at most about 2^lg hashed items. Sketches of groups are made by one aggregate
that combines in the tasks, so a sketch per group and task is shuffled, in two steps, and no row. Those of several groups or runs merge into
the sketch of all of them, in which what they share counts once, and two of them tell how much they share; neither reads the rows again.

Up to 2^lg distinct items a count is exact. Beyond, its standard error is relative_error(lg) of it, and merging does not add to that.
Items are told apart by 64 bits of hash, which joins fewer than one in a million of 10^12 items. Estimates may differ between
runs within that error, as they depend on the order in which rows come.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .combined import TRIPLE, part_of

#: Items that a sketch holds, as a power of two: 2^14 are 128 KB to 256 KB, with a standard error of 0.8 percent.
LG = 14
#: What graphs are counted by, named as graph_counts() names it. Null subjects and predicates do not count, as there.
GRAPH = {"n_triples": TRIPLE, "n_subjects": ("s",), "n_predicates": ("p",)}

#: Tasks that merge the sketches of one group before the last one merges theirs.
FAN = 64


def relative_error(lg: int = LG) -> float:
    """The standard error of a count beyond 2^lg items, as a part of it."""
    return 1 / math.sqrt(2**lg - 1)


def item(columns: Sequence[str]) -> Column:
    """What stands for the values of some columns. A null in one of several is a value; a single column that is null is no item."""
    if len(columns) == 1:
        return F.when(F.col(columns[0]).isNotNull(), F.xxhash64(columns[0]))
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def sketched(df: DataFrame, keys: Sequence[str], counted: Mapping[str, Sequence[str]], lg: int = LG) -> DataFrame:
    """A row per group: the keys, n_rows, and for each name a sketch of the distinct values of its columns. A null key is a
    group of its own; a table without rows gives none.

    A group that all tasks have rows of has as many sketches as there are tasks. They are merged by FAN tasks first, each those of
    some of the tasks, so that no task reads them all.
    """
    some = df.withColumn("_fan", F.pmod(F.spark_partition_id(), F.lit(FAN))).groupBy(*keys, "_fan")
    parts = some.agg(F.count("*").alias("n_rows"), *[F.theta_sketch_agg(item(columns), lg).alias(name) for name, columns in counted.items()])
    found = parts.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), *[F.theta_union_agg(name, lg).alias(name) for name in counted])
    return found if keys else found.where("n_rows IS NOT NULL")


def graph_sketches(triples: DataFrame, lg: int = LG) -> DataFrame:
    """sketched() of each graph's triples, subjects and predicates."""
    return sketched(triples, ["graph"], GRAPH, lg)


def names_of(sketches: DataFrame) -> list[str]:
    return [c for c, t in sketches.dtypes if t == "binary"]


def merged(sketches: DataFrame, keys: Sequence[str] = (), lg: int = LG) -> DataFrame:
    """Fewer groups of more: the sketches of all rows with equal keys as one, their rows summed up. Give the same lg."""
    return sketches.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), *[F.theta_union_agg(c, lg).alias(c) for c in names_of(sketches)])


def estimated(sketches: DataFrame) -> DataFrame:
    """Each sketch as the number of distinct items that it stands for."""
    return sketches.withColumns({c: F.theta_sketch_estimate(c) for c in names_of(sketches)})


def shared(sketches: DataFrame, pairs: DataFrame, key: str = "graph") -> DataFrame:
    """For the given pairs (left, right) of keys, how many distinct items both have, by each name. The error is that of the count
    of both together, so a small share of large groups is less sure than their counts. Pairs with a key that is not there
    or null are left out; only the pairs that are given are compared."""
    side = lambda name: sketches.select(F.col(key).alias(name), F.struct(*names_of(sketches)).alias(f"_{name}"))
    both = pairs.select("left", "right").join(side("left"), "left").join(side("right"), "right")
    return both.select("left", "right", *[F.theta_sketch_estimate(F.theta_intersection(f"_left.{c}", f"_right.{c}")).alias(c) for c in names_of(sketches)])


def keep(sketches: DataFrame, path: str, key: str = "graph") -> None:
    """Writes sketches to a folder per key; those of keys that were kept before are replaced, others stay. So a run that
    is repeated counts once, and only groups that changed need a new sketch."""
    rows = sketches.withColumn("part", part_of(F.col(key).cast("string")))
    rows.hint("rebalance", "part").write.options(partitionOverwriteMode="dynamic").partitionBy("part").mode("overwrite").parquet(path)


def kept(spark: SparkSession, path: str) -> DataFrame:
    """All sketches that were kept under a path, a row per key."""
    return spark.read.parquet(path).drop("part")


def against_exact(estimates: DataFrame, exact: DataFrame, keys: Sequence[str], lg: int = LG, deviations: float = 4) -> DataFrame:
    """The exact counts, and for each `<name>_within`: whether the estimate is as near as so many standard errors (and exact up
    to 2^lg items). The names are the columns that both tables have besides the keys."""
    names = [c for c in exact.columns if c not in keys and c in estimates.columns]
    right = estimates.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_{c}") for c in names])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))
    within = {f"{c}_within": F.coalesce(F.abs(F.col(c) - F.col(f"_{c}")) <= F.when(F.col(c) <= 2**lg, 0).otherwise(deviations * relative_error(lg) * F.col(c)), F.lit(False)) for c in names}
    return exact.join(right, same, "left").select(*keys, *names, *[x.alias(n) for n, x in within.items()])
