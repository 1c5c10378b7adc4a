"""Numbers that stay: rows that come later are numbered after those that a key already has, so that identifiers made of the
numbers, and the graphs that hold them, need no rewriting.

Under a path lie `rows`, the numbered rows in a folder per batch, and `ledger`, per batch and key the first number and how many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..storage import stored
from .blocks import same
from .series import is_small, with_sequence


def _read(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """A table without the batches that were cut off: those have rows and no finished ledger."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    done = fs.Path(f"{path}/ledger/batch=*/_SUCCESS")
    found = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(done)
    names = [s.getPath().getParent().getName() for s in found or []]
    return spark.read.option("basePath", f"{path}/{table}").parquet(*[f"{path}/{table}/{n}" for n in names]) if names else None


def numbered(spark: SparkSession, path: str) -> DataFrame | None:
    """All numbered rows with their batch; None before the first."""
    return _read(spark, path, "rows")


def append_numbered(df: DataFrame, path: str, batch: int, keys: Sequence[str], order: Sequence[str], ids: Sequence[str] = (), out: str = "seq", block_rows: int | None = None) -> DataFrame:
    """Numbers df's rows per key, in `order`, after the numbers that earlier batches gave, stores them as `batch`, and returns them.

    Numbers begin at 0 and have no holes. Rows whose `ids` an earlier batch holds are left out, as they have their numbers (give none
    to number every row). A batch that was finished is not made again: its stored rows are returned, so a repeated run gives no
    number twice; one that was cut off is. Null keys are a key, null ids equal each other, and rows that are equal in `ids` within
    the batch are each numbered. End `order` with a tie-break. What the ledger knows of the batch's keys is sent to all tasks if it is small; only rows of
    keys that the batch has are looked up. One run at a time may write.
    """
    spark, keys, path = df.sparkSession, list(keys), path.rstrip("/")
    ledger, rows = _read(spark, path, "ledger"), _read(spark, path, "rows")
    if ledger is not None and not ledger.where(F.col("batch") == batch).isEmpty():
        return rows.where(F.col("batch") == batch).drop("batch")
    names = df.columns
    if ids and rows is not None:
        have = rows.select(*[F.col(c).alias(f"_i{i}") for i, c in enumerate(ids)])
        on = [F.col(c).eqNullSafe(F.col(f"_i{i}")) for i, c in enumerate(ids)]
        df = df.join(have, on, "left_anti")
    df = with_sequence(stored(df, "batch"), keys, order, out="_new", block_rows=block_rows)
    if ledger is None:
        df = df.withColumn(out, F.col("_new"))
    else:
        mine = df.select(*keys).distinct()
        before = ledger.groupBy(*keys).agg(F.sum("count").alias("_before")).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_before")
        before = same(before.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], "_before"), mine.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]), keys)
        before = stored(before.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_before"), "before")
        on = [df[k].eqNullSafe(before[f"_k{i}"]) for i, k in enumerate(keys)]
        df = df.join(F.broadcast(before) if is_small(before) else before, on, "left").withColumn(out, F.col("_new") + F.coalesce("_before", F.lit(0)))
    df.select(*names, out).write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
    made = spark.read.parquet(f"{path}/rows/batch={batch}")
    made.groupBy(*keys).agg(F.min(out).alias("offset"), F.count("*").alias("count")).write.mode("overwrite").parquet(f"{path}/ledger/batch={batch}")
    return made
