"""Positions within long series, and blocks of positions with halos, so that no task sorts a whole series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..storage import stored

#: Rows of a key above which the registered queries cut it into blocks.
BLOCK_ROWS = 1_000_000
#: Parts that rows are ranged into at most (beyond it parts grow, and their sorts spill), and keys that are sent to all tasks.
MOST_PARTS, MOST_SENT = 20_000, 100_000


def split_long(df: DataFrame, keys: Sequence[str], block_rows: int | None) -> tuple[DataFrame, DataFrame | None, int]:
    """The rows of keys with at most block_rows rows, those of longer keys (None if there are none), and how many the latter are.

    Rows are counted per key, combined in the tasks. Long keys are at most one for each block_rows rows; they are sent to
    all tasks if they are few, so that no row is shuffled to be told apart.
    """
    if not block_rows:
        return df, None, 0
    sizes = stored(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > block_rows), "long")
    n = sizes.agg(F.sum("_n")).first()[0]
    if not n:
        return df, None, 0
    long = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    long = F.broadcast(long) if long.limit(MOST_SENT + 1).count() <= MOST_SENT else long
    on = [df[k].eqNullSafe(long[f"_k{i}"]) for i, k in enumerate(keys)]
    return df.join(long, on, "left_anti"), df.join(long, on, "left_semi"), n


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """left joined to right, whose key columns are named _k0, _k1, …; null keys are equal to each other."""
    on = [left[k].eqNullSafe(right[f"_k{i}"]) for i, k in enumerate(keys)]
    return left.join(right, on).drop(*[f"_k{i}" for i in range(len(keys))])


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], part_rows: int, rows: int) -> DataFrame:
    """df, which has so many rows, with pos (from 1) and n, its key's rows, without sorting a key in one task.

    Rows are range-partitioned by keys and full order into parts of about part_rows, whatever the gaps, ties or
    outliers in the order, and written with their part to the shared folder. They are numbered within (key, part), and a running
    sum over the parts, one row each, gives where each begins. Null keys and nulls in the order (which come first) count
    like any value.
    """
    parts = max(1, min(MOST_PARTS, -(-rows // part_rows)))
    cut = df.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id())
    cut = stored(cut, "ranges")
    counts = cut.groupBy(*keys, "_part").agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, "_part"])], F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"), F.sum("_c").over(whole).alias("n"))
    numbered = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
    return same(numbered, starts, [*keys, "_part"]).withColumn("pos", (F.col("_start") + F.col("_rn")).cast("bigint")).drop("_part", "_rn", "_start")


def in_blocks(df: DataFrame, halo: int, block_rows: int) -> DataFrame:
    """Rows with pos and n, each in its block and, as a copy (_own false), in those it is within `halo` rows of."""
    last = F.expr(f"(n - 1) DIV {block_rows}")
    block = lambda p: F.expr(f"CAST(({p}) DIV {block_rows} AS BIGINT)")
    each = F.sequence(F.greatest(block(f"pos - 1 - {halo}"), F.lit(0).cast("bigint")), F.least(block(f"pos - 1 + {halo}"), last))
    return df.withColumn("_block", F.explode(each)).withColumn("_own", F.col("_block") == block("pos - 1"))
